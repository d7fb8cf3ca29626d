from kpiloom.operators import aggregates, calendar, history, joins, lineage, rows

__all__ = ["aggregates", "calendar", "history", "joins", "lineage", "rows"]
