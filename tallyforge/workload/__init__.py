"""The registered queries: every operator run on the test tables, next to the same result in SQL."""

from importlib import import_module

MODULES = (
    "projections", "joins", "aggregates", "windows", "scalars", "features", "streams", "changes", "quality", "reports", "models", "scans",
)


def load_queries():
    """All queries by name."""
    for module in MODULES:
        import_module(f"tallyforge.workload.{module}")
    from tallyforge.workload.registry import QUERIES

    return QUERIES
