"""The reports bound to the driver tables, each with an equivalent SQL text.

The driver tables stand in for the report sources: a binding only picks and
derives columns, the work is done by `kpiloom.plans`.
"""

from kpiloom.bindings import admissions, calls, extracts, prescriptions, progress, schedule, text, tickets

MODULES = (progress, admissions, prescriptions, schedule, calls, tickets, extracts, text)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
