"""What a Python worker keeps between its tasks.

Spark reuses its Python workers, so a table built by one task serves the next
ones. A worker keeps one such thing at a time: when a task of another operator
needs its own, or none, the memory of the one before is given back.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

_kept: dict[Hashable, object] = {}


def keep(key: Hashable, build: Callable[[], object]):
    """The kept thing of this name, built where the worker doesn't have it."""
    if key not in _kept:
        drop()
        _kept[key] = build()
    return _kept[key]


def drop() -> None:
    """Keep nothing any more."""
    if _kept:
        _kept.clear()
    trim()


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
