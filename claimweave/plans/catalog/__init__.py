"""One module per operator family; importing them fills the registry."""

from __future__ import annotations

import importlib
import pkgutil

from ..registry import REGISTRY, Entry


def load_all() -> dict[str, Entry]:
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return dict(sorted(REGISTRY.items()))
