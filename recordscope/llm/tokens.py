"""Words of many texts at the speed of the interpreter's own splitting, in pieces of bounded size."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

#: Bytes that are split at a time; words and what is kept of them are some ten times as large.
SLICE = 1 << 20
#: Distinct words whose hashes a task remembers.
CACHE = 1 << 17


#: A byte that no UTF-8 text holds; as a word it stands for a break and alone has the hash 0.
BREAK = b"\xff"


class WordHashes(dict):
    """Word -> 64 bits of its cryptographic digest, so that no rule makes words of equal hashes. Forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = 0 if word == BREAK else int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") or 1
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_SPACE = re.compile(rb"[ \t-\r]")


def slices(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """``data`` in slices of about ``size`` bytes, cut at white space, which goes with none of them; a longer word stays whole."""
    at = 0
    while len(data) - at > size:
        cut = _SPACE.search(data, at + size)
        if cut is None:
            break
        yield data[at : cut.start()]
        at = cut.end()
    yield data[at:]
