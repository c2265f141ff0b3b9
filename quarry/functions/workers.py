"""Values that live as long as a Python worker."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


def per_worker(name: str, make: Callable[[], T]) -> T:
    """A value made once in each worker process, for all its tasks. The package's functions travel to
    the workers by value, so a module variable would start anew with every task."""
    held = sys.__dict__.setdefault("_quarry_per_worker", {})
    if name not in held:
        held[name] = make()
    return held[name]
