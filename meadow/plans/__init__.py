"""Query plans over the star-schema test tables, one module per operator family."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every queries_* module so that it fills the registry."""
    for info in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        if info.name.startswith("queries_"):
            importlib.import_module(f"{__name__}.{info.name}")
