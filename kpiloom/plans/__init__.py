from kpiloom.plans import calls, closures, completeness, extracts, prescriptions, progress, recency, slots, tickets

__all__ = [
    "calls",
    "closures",
    "completeness",
    "extracts",
    "prescriptions",
    "progress",
    "recency",
    "slots",
    "tickets",
]
