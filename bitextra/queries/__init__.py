"""Registered queries: every operator applied to whole test tables, with its SQL twin."""

from __future__ import annotations

from importlib import import_module

MODULES = ("cleaning", "preparing", "augmenting", "profiling", "splitting", "sampling", "scoring", "encoding", "mining", "loading")


def load_all():
    for m in MODULES:
        import_module(f"{__name__}.{m}")
    from .base import REGISTERED

    return REGISTERED
