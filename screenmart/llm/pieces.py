"""Splitting texts into the pieces that byte-level BPE merges within, for many texts at once."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

import numpy as np
import regex

from screenmart.llm.common import distinct_spans, ranges, same_spans

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Code points with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    out = np.zeros(0x110000, dtype=np.uint8)
    at = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, text):
            out[at[found.start() : found.end()]] = kind
    out[WHITE_SPACE] = SPACE
    return out


def split(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined text, its code points, starts and ends of the pieces, and each text's number of pieces.

    The same pieces as matches of the usual pattern: contractions; letters, numbers or other
    characters, each with at most one blank before; white space, of which the last
    character before something else stands alone unless it is that blank.
    """
    joined = "".join(texts)
    units = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(units)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.zeros(n + 1, dtype=bool)
    first[np.cumsum(lengths)] = True
    first[0] = True
    kind = _classes()[units]
    begin = first.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    # White space that something follows in the same text.
    end = np.flatnonzero(begin[1:n] & ~first[1:n] & (kind[: n - 1] == SPACE)) + 1 if n else np.zeros(0, np.int64)
    begin[end - 1] = True
    begin[end[units[end - 1] == 32]] = False
    # Contractions start where an apostrophe starts a piece.
    at = np.flatnonzero((units == 39) & begin[:n])
    at = at[~first[at + 1]]
    one = units[at + 1]
    two = np.where(~first[np.minimum(at + 2, n)], units[np.minimum(at + 2, n - 1)], 0) if n else one
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), dtype=bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    begin[at[short | long] + 1] = False
    begin[at[short] + 2] = True
    begin[at[long] + 3] = True
    edges = np.flatnonzero(begin)
    starts, ends = edges[:-1], edges[1:]
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    return joined, units, starts, ends, np.diff(bounds)


@functools.lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point its lower-case letter, or 32 for all that is no letter."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in np.flatnonzero(_classes() == LETTER).tolist():
        low = chr(c).lower()
        out[c] = ord(low) if len(low) == 1 else c
    return out


def letter_words(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like ``split``: the runs of letters, in lower case."""
    units = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    units = _folded()[units]
    inside = np.zeros(len(units) + 2, dtype=np.int8)
    inside[1:-1] = units != 32
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
    return units.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), units, starts, ends, counts


class Encoded:
    """Token ids of pieces met so far, found by hash and by content. Forgets all when full: a speed-up, not a limit.

    Full is ``most`` pieces, or 16 code points for each of them: some long pieces take the room of many.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        split: Callable[[list[str]], tuple] = split,
        most: int = 2_500_000,
    ):
        self.encode, self.split, self.most = encode, split, most
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        # Of each piece, in order of hash: its ids and its code points.
        self.at, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.spelt, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.ids, self.units = Growing(np.int32), Growing(np.uint32)

    def _add(self, places: np.ndarray, hashes: np.ndarray, at: np.ndarray, sizes: np.ndarray, spelt: np.ndarray, lengths: np.ndarray) -> None:
        self.at, self.size = np.insert(self.at, places, at), np.insert(self.size, places, sizes)
        self.spelt, self.length = np.insert(self.spelt, places, spelt), np.insert(self.length, places, lengths)
        self.hashes = np.insert(self.hashes, places, hashes)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's number of them."""
        joined, units, starts, ends, counts = self.split(texts)
        hashes, where, back = distinct_spans(units, starts, ends)
        if len(self.hashes) + len(hashes) > self.most or self.units.used > 16 * self.most:
            self.forget()
        begin, length = starts[where], ends[where] - starts[where]
        place = np.searchsorted(self.hashes, hashes)
        met = np.flatnonzero(place < len(self.hashes))
        met = met[self.hashes[place[met]] == hashes[met]]
        alike = met[self.length[place[met]] == length[met]]
        alike = alike[same_spans(units, begin[alike], length[alike], self.units.values, self.spelt[place[alike]])]
        at, sizes = np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        at[alike], sizes[alike] = self.at[place[alike]], self.size[place[alike]]
        new = np.ones(len(hashes), dtype=bool)
        new[alike] = False
        if new.any():
            spans = zip(begin[new].tolist(), ends[where[new]].tolist(), strict=True)
            lists = self.encode([joined[s:e] for s, e in spans])
            sizes[new] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            flat = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int32, count=int(sizes[new].sum()))
            at[new] = self.ids.add(flat) + np.cumsum(sizes[new]) - sizes[new]
            # One piece is remembered for each hash; another of the same hash is encoded whenever it comes.
            first = new.copy()
            first[met] = False
            first[1:] &= hashes[1:] != hashes[:-1]
            spelt = self.units.add(units[ranges(begin[first], length[first])]) + np.cumsum(length[first]) - length[first]
            self._add(place[first], hashes[first], at[first], sizes[first], spelt, length[first])
        sizes_of, at_of = sizes[back], at[back]
        ids = self.ids.values[ranges(at_of, sizes_of)]
        before = np.concatenate(([0], np.cumsum(sizes_of)))
        last = np.cumsum(counts)
        return ids, before[last] - before[last - counts]


class Growing:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.values, self.used = np.zeros(1 << 16, dtype=dtype), 0

    def add(self, more: np.ndarray) -> int:
        """Appends and returns where the added values begin."""
        begin, self.used = self.used, self.used + len(more)
        if self.used > len(self.values):
            room = max(self.used - len(self.values), len(self.values) >> 1)
            self.values = np.concatenate([self.values, np.zeros(room, dtype=self.values.dtype)])
        self.values[begin : self.used] = more
        return begin
