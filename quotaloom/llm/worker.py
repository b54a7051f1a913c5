"""What a Python worker keeps between tasks: one object at a time, so that stages do not add up in memory."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_kept: dict[Any, Any] = {}


def keep(key: Any, make: Callable[[], Any]) -> Any:
    """The object under ``key``, made if it is not the one at hand; whatever was kept before goes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]
