"""Bounded memos of what a task has computed for a key."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakSet

_alive: WeakSet[Memo] = WeakSet()


def forget() -> None:
    """Empty all memos; Python workers outlive their tasks and share an executor's memory."""
    for memo in _alive:
        memo.young, memo.old = {}, {}


class Memo:
    """Values by key within one task, in two generations of bounded size.

    ``compute`` gets the unknown keys of a call at once. When the young generation is
    full it becomes the old one, so keys in use stay and memory does not grow.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 80_000):
        self.compute, self.limit = compute, limit
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        _alive.add(self)

    def get(self, keys: list[str]) -> list:
        found = list(map(self.young.get, keys))
        missing = [i for i, value in enumerate(found) if value is None]
        unknown = []
        for i in missing:
            value = self.old.get(keys[i])
            if value is None:
                unknown.append(i)
            else:
                found[i] = self.young[keys[i]] = value
        for start in range(0, len(unknown), 20_000):
            part = unknown[start : start + 20_000]
            names = [keys[i] for i in part]
            for i, name, value in zip(part, names, self.compute(names), strict=True):
                found[i] = self.young[name] = value
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        return found
