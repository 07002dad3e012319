"""Named queries over the operators, each with the SQL it must agree with where SQL can say it."""

from importlib import import_module

MODULES = ["enrichment", "rollup_queries", "reliability", "records", "streams"]


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
