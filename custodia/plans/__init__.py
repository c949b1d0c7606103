"""Jobs bound to the test tables, one module per family."""

from __future__ import annotations

import importlib
import pkgutil

from custodia.plans import registry


def _load() -> None:
    for info in pkgutil.iter_modules(__path__):
        if info.name != "registry":
            importlib.import_module(f"{__name__}.{info.name}")


def all_queries() -> dict[str, registry.Job]:
    _load()
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return {name: registry.expand(text).strip() for name, text in registry.ORACLES.items()}
