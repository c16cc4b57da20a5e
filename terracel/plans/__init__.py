"""Registered queries over the given tables."""

import importlib
import pkgutil


def load_all():
    """Import every query module of this package and return the filled registry."""
    from . import registry

    for module in pkgutil.iter_modules(__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module.name}")
    return registry
