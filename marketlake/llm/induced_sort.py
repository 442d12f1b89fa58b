"""External induced sorting of the suffixes of one shard, with common-prefix values.

The suffixes that start a descent's end (S* suffixes) are sorted first; all others follow from them: a scan in order
puts the predecessor of each suffix into the queue of its first symbol. A queue is popped symbol by symbol, and what
is pushed never comes before what was popped, so the priority queue is a row of buckets, kept in files beyond a bound
of memory. A tuple in a queue is a position and the length of the prefix that it shares with the tuple before it in
the queue; the scan derives it as one more than the least shared length between the two suffixes they came from.

The S* suffixes are sorted by the same scan over their substrings, whose equal ones get equal names; where names repeat,
the string of names is sorted by doubling up to ``depth``. Shared lengths are exact up to ``depth``, and suffixes that
agree on ``depth`` symbols come in any order.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

_FULL = np.int32(1 << 30)


class BucketQueue:
    """A priority queue of (position, shared length) by symbol; beyond ``limit`` bytes the buckets go to files."""

    def __init__(self, folder: str, name: str, limit: int = 64 << 20):
        self.path, self.limit, self.held = os.path.join(folder, name), limit, 0
        self.blocks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        self.sizes: dict[int, int] = defaultdict(int)

    def push(self, symbol: int, pos: np.ndarray, shared: np.ndarray) -> None:
        self.blocks[symbol].append((pos, shared))
        self.held += 12 * len(pos)
        if self.held > self.limit:
            for s, blocks in self.blocks.items():
                with open(f"{self.path}-{s}.pos", "ab") as a, open(f"{self.path}-{s}.len", "ab") as b:
                    for p, n in blocks:
                        p.astype(np.int64).tofile(a)
                        n.astype(np.int32).tofile(b)
                        self.sizes[s] += len(p)
            self.blocks.clear()
            self.held = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of the symbol, in the order of their arrival."""
        blocks = self.blocks.pop(symbol, [])
        self.held -= sum(12 * len(p) for p, _ in blocks)
        if self.sizes.pop(symbol, 0):
            paths = f"{self.path}-{symbol}.pos", f"{self.path}-{symbol}.len"
            blocks.insert(0, (np.fromfile(paths[0], np.int64), np.fromfile(paths[1], np.int32)))
            for path in paths:
                os.remove(path)
        if not blocks:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        return np.concatenate([p for p, _ in blocks]), np.concatenate([n for _, n in blocks])


class Sorter:
    """``x``: symbols (unsigned 16-bit) that end with a single 0, the only one; at least three more entries follow it."""

    def __init__(self, x: np.ndarray, n: int, depth: int, folder: str):
        self.x, self.n, self.depth, self.folder = x, n, depth, folder
        here, after = x[: n - 1], x[1:n]
        places = np.arange(n - 1)
        turn = np.minimum.accumulate(np.where(here != after, places, n)[::-1])[::-1]  # next place where the symbol changes
        self.rising = np.ones(n, bool)
        self.rising[:-1] = x[turn + 1] > x[turn]
        self.symbols = np.flatnonzero(np.bincount(x[:n]))
        starts = np.flatnonzero(self.rising[1:] & ~self.rising[:-1]) + 1
        self.stars = starts.astype(np.int64)
        self.is_star = np.zeros(n, bool)
        self.is_star[starts] = True

    def _run(self, pos: int) -> int:
        """How often the symbol at ``pos`` is repeated from there, up to the depth."""
        part = self.x[pos : pos + self.depth + 1]
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else self.depth

    def _meet(self, a: np.ndarray, b: np.ndarray) -> int:
        """Shared length of the last of ``a`` and the first of ``b``, which start with the same symbol but differ in type."""
        return min(self._run(int(a[-1])), self._run(int(b[0]))) if len(a) and len(b) else 0

    def _scan(self, pos: np.ndarray, shared: np.ndarray, rising: bool, since: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(symbol, positions, shared lengths) of the predecessors of one type; ``since``: least length since a symbol's last."""
        if not len(pos):
            return
        before = pos - 1
        index = np.flatnonzero((before >= 0) & (self.rising[before] == rising))
        symbols = self.x[before[index]].astype(np.int64)
        order = np.argsort(symbols, kind="stable")
        index, symbols = index[order], symbols[order]
        padded = np.append(shared, _FULL)
        least = padded.min()
        if not len(index):
            np.minimum(since, least, out=since)
            return
        first = np.concatenate([[True], symbols[1:] != symbols[:-1]])
        low = np.concatenate([[0], index[:-1] + 1])
        low[first] = 0
        between = np.minimum.reduceat(padded, np.stack([low, index + 1], 1).ravel())[::2]
        between[first] = np.minimum(between[first], since[symbols[first]])
        lengths = np.minimum(between + 1, _FULL).astype(np.int32)
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(index))
        rest = np.minimum.accumulate(padded[::-1])[::-1]
        np.minimum(since, least, out=since)
        since[symbols[starts]] = rest[index[ends - 1] + 1]
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            yield int(symbols[a]), before[index[a:b]], lengths[a:b]

    def _bucket(self, symbol: int, queue: BucketQueue, rising: bool, since: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pop a bucket, with what its own scan adds to it."""
        parts = [queue.pop(symbol)]
        while len(parts[-1][0]):
            more = (np.empty(0, np.int64), np.empty(0, np.int32))
            for s, pos, shared in self._scan(*parts[-1], rising, since):
                if s == symbol:
                    more = pos, shared
                else:
                    queue.push(s, pos, shared)
            parts.append(more)
        return np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])

    def induce(self, stars: np.ndarray, shared: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From sorted S* positions to (positions, shared lengths with the one before) of all suffixes, in descending order."""
        size = int(self.x[: self.n].max()) + 1
        falling, rising, done = (BucketQueue(self.folder, name) for name in ("falling", "rising", "done"))
        at = self.x[stars]
        cuts = np.searchsorted(at, np.arange(size + 1))
        since = np.full(size, -1, np.int32)
        for c in self.symbols.tolist():
            pos, lengths = self._bucket(c, falling, False, since)
            done.push(c, pos, lengths)
            own, own_lengths = stars[cuts[c] : cuts[c + 1]], shared[cuts[c] : cuts[c + 1]].copy()
            if len(own):
                own_lengths[0] = self._meet(pos, own)
            for s, p, n in self._scan(own, own_lengths, False, since):
                falling.push(s, p, n)
        since = np.full(size, -1, np.int32)
        for c in reversed(self.symbols.tolist()):
            pos, lengths = self._bucket(c, rising, True, since)
            low, low_lengths = done.pop(c)
            low = low[::-1]
            turned = np.empty_like(low_lengths)
            turned[1:] = low_lengths[:0:-1]
            if len(low):
                turned[0] = self._meet(pos, low)
            yield np.concatenate([pos, low]), np.concatenate([lengths, turned])
            for s, p, n in self._scan(low, turned, True, since):
                rising.push(s, p, n)

    def _shared(self, order: np.ndarray) -> np.ndarray:
        """Length, up to the depth, that each suffix shares with the one before it in ``order``."""
        out = np.zeros(len(order), np.int32)
        words = np.ndarray((self.n,), "<u8", np.ascontiguousarray(self.x).data, strides=(2,))
        active = np.arange(1, len(order))
        for step in range(0, self.depth, 4):
            if not len(active):
                return out
            differ = words[np.minimum(order[active] + step, self.n - 1)] ^ words[np.minimum(order[active - 1] + step, self.n - 1)]
            same = differ == 0
            ended = active[~same]
            low = differ[~same]
            out[ended] = step + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) // 16)
            active = active[same]
        out[active] = self.depth
        return np.minimum(out, self.depth)

    def _sorted_stars(self) -> np.ndarray:
        stars = self.stars
        if len(stars) < 2:
            return stars
        by_symbol = stars[np.argsort(self.x[stars], kind="stable")]
        order, classes, count = [], [], 0
        for pos, shared in self.induce(by_symbol, np.full(len(by_symbol), _FULL, np.int32)):
            own = count + np.cumsum(shared < _FULL)
            count = int(own[-1]) if len(own) else count
            keep = self.is_star[pos]
            order.append(pos[keep])
            classes.append(own[keep])
        # The last suffix has no successor to be induced from; it is the smallest.
        ranked = np.append(np.concatenate(order), self.n - 1)[::-1]
        new = np.append(np.concatenate(classes), count + 1)[::-1]
        names = np.concatenate([[0], np.cumsum(new[1:] != new[:-1])])
        if names[-1] + 1 == len(names):
            return ranked
        string = np.empty(len(stars), np.int64)
        string[np.searchsorted(stars, ranked)] = names
        return stars[_doubled(string, self.depth)]

    def groups(self) -> Iterator[np.ndarray]:
        """Positions whose first ``depth`` symbols also start at another position."""
        stars = self._sorted_stars()
        for pos, shared in self.induce(stars, self._shared(stars)):
            if not len(pos):
                continue
            joined = shared >= self.depth
            joined[0] = False
            yield pos[joined | np.append(joined[1:], False)]


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` by up to ``depth`` names; the last name is the only smallest."""
    rank, step = names, 1
    while True:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 2) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(len(rank), np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank, step = new, 2 * step
        if step >= min(depth, len(rank)) or rank.max() + 1 == len(rank):
            return order
