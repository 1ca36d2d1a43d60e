"""A bounded cache for values that cost much to compute."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """``memo[key]`` computes a missing value and keeps it.

    Two generations bound the memory: when the young one is full, it becomes the old one,
    and what is asked for again moves back. Nothing but speed depends on what is kept.
    """

    def __init__(self, compute: Callable, limit: int) -> None:
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key) if key in self.old else self.compute(key)
        self.put(key, value)
        return value

    def put_all(self, values: dict) -> None:
        """Keep many computed values; more than the limit at once make a generation."""
        if len(self) + len(values) > self.limit:
            self.old = dict(self)
            self.clear()
        self.update(values)

    def put(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
