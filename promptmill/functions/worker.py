"""State that a Python worker keeps between tasks, such as a loaded model."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from typing import Any


def once_per_worker(key: Hashable, build: Callable[[], Any], alone: bool = False) -> Any:
    """``build()``, called once per worker process for each key.

    With ``alone`` at most one such state is kept at a time: building another one drops it.  That
    bounds the memory of a worker that serves one large operator after the other.

    The store hangs on the interpreter, not on this module: functions of this package travel by
    value, so a module variable would be a fresh copy in every task.
    """
    store = sys.__dict__.setdefault("_promptmill_worker_store", {})
    if key not in store:
        if alone:
            for other in [k for k, (_, is_alone) in store.items() if is_alone]:
                del store[other]
        store[key] = build(), alone
    return store[key][0]
