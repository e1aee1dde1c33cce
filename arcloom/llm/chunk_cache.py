"""A bounded memory of encoded chunks, shared by the token encoders."""

from __future__ import annotations

from collections.abc import Callable


class ChunkCache:
    """Values of chunks by a function that takes many new chunks at once.

    Two generations bound the memory: when the young one holds ``most`` chunks it becomes the old one, and a
    chunk found in the old one moves up. What is forgotten is computed again, so results don't depend on it.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]], most: int) -> None:
        self.compute, self.most = compute, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def lookup(self, chunks: list[str]) -> list[bytes]:
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, chunks))
        gaps = [i for i, v in enumerate(found) if v is None]
        if gaps:
            new = []
            for c in {chunks[i] for i in gaps}:
                if c in old:
                    young[c] = old[c]
                else:
                    new.append(c)
            if new:
                young.update(zip(new, self.compute(new), strict=True))
            for i in gaps:
                found[i] = young[chunks[i]]
        return found
