"""What a Python worker remembers, bounded by bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

#: Bytes that an entry takes beside its key and value.
ENTRY = 200


class ByteMemo:
    """Values of byte-string keys, solved many at a time.

    Entries of at most ``limit`` bytes together are kept; when new ones do not fit, all
    go and it begins anew (what is frequent is back with the next call). A key of
    more than ``limit // 1000`` bytes is solved each time it comes.
    """

    def __init__(self, solve: Callable[[list[bytes]], Iterable], limit: int = 128 << 20, weight: Callable[[object], int] = len):
        self.solve, self.limit, self.weight = solve, limit, weight
        self.known: dict = {}
        self.used = 0

    def values(self, keys: list[bytes]) -> list:
        """The value of each key."""
        found = list(map(self.known.get, keys))
        missing = [i for i, value in enumerate(found) if value is None]
        if missing:
            new = list(dict.fromkeys([keys[i] for i in missing]))
            solved = dict(zip(new, self.solve(new), strict=True))
            for i in missing:
                found[i] = solved[keys[i]]
            self._keep(solved)
        return found

    def _keep(self, solved: dict) -> None:
        longest = self.limit // 1000
        if max(map(len, solved)) > longest:
            solved = {k: v for k, v in solved.items() if len(k) <= longest}
        size = sum(map(len, solved)) + sum(map(self.weight, solved.values())) + ENTRY * len(solved)
        if self.used + size > self.limit:
            self.known, self.used = {}, 0
        if size <= self.limit:
            self.known.update(solved)
            self.used += size


def by_bytes(keys: list[bytes], limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The keys in order, in lists of at most ``limit`` bytes (a longer key alone)."""
    some, size = [], 0
    for key in keys:
        if some and size + len(key) > limit:
            yield some
            some, size = [], 0
        some.append(key)
        size += len(key)
    if some:
        yield some
