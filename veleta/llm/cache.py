"""A bounded memo for the pieces of text that a Python worker meets again and again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any


class Memo(dict):
    """memo[key] computes and keeps function(key) of a text or bytes.

    Two generations of at most `most` entries each; a key of more than
    `longest` characters is computed anew each time, so that the memo is bounded
    in bytes too.
    """

    def __init__(self, function: Callable[[Sequence], Any], most: int = 100_000, longest: int = 64):
        super().__init__()
        self.function, self.most, self.longest, self.older = function, most, longest, {}

    def __missing__(self, key: Sequence) -> Any:
        if len(key) > self.longest:
            return self.function(key)
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        self.put(key, found)
        return found

    def put(self, key: Sequence, value: Any) -> None:
        """Keep a value that is known already, unless its key is too long."""
        if len(key) > self.longest:
            return
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def lacks(self, key: Sequence) -> bool:
        """Whether a key that is kept at all is not there yet."""
        return key not in self and key not in self.older and len(key) <= self.longest

    def known(self, keys: Iterable[Sequence]) -> tuple[dict[Sequence, Any], list[Sequence]]:
        """What is known of the keys, and the keys of which nothing is."""
        found, new, older = {}, [], self.older
        for key in keys:
            value = self.get(key)
            if value is None:
                value = older.get(key)
                if value is None:
                    new.append(key)
                    continue
                self.put(key, value)
            found[key] = value
        return found, new
