"""The catalogue: one entry per query, with its SQL counterpart where one exists."""

from importlib import import_module

MODULES = ("ingestion", "cleaning", "contracts", "windows", "joins", "aggregates", "scalars", "gold",
           "profiling", "kpis", "modelling", "horizons", "ordering", "streams", "questions")


def load_all():
    """All registered queries and their SQL counterparts."""
    from shelfline.plans import catalog

    for name in MODULES:
        import_module(f"shelfline.plans.{name}")
    return catalog.QUERIES, catalog.ORACLE
