"""Registered queries over the test tables, each with its SQL twin."""

import importlib

MODULES = ["decoding", "relating", "changing", "reporting", "capturing"]


def load() -> dict:
    from .registry import REGISTRY

    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return REGISTRY
