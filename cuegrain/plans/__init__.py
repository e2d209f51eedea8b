"""Query plans and their SQL twins."""

import importlib

from ..registry import Registry

_MODULES = ["incremental", "text", "timeline", "signals", "pipeline", "composed", "stages"]


def all_registries() -> list[Registry]:
    """The registries of the core."""
    return [importlib.import_module(f".{name}", __name__).REGISTRY for name in _MODULES]
