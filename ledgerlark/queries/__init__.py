"""Named queries by section; ``load`` registers all of them."""

from importlib import import_module

SECTIONS = ("forecasting", "scans", "predicates", "joining", "grouping", "windows", "scalars", "nesting", "cleaning", "rules", "duplicates", "telemetry", "warehouse")


def load() -> None:
    for section in SECTIONS:
        import_module(f"{__name__}.{section}")
