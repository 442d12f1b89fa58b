"""Rolling hashes and minimizers of sequences, in NumPy, for one document at a time.

Every window of ``length`` values has a smallest gram (``gram`` values, by hash). A *run* is a longest stretch of
consecutive windows with the same smallest hash, its key. Equal windows have equal keys wherever they stand, so keys
can part the windows of a corpus into groups that need not know of each other, and there are far fewer runs than
windows. Long sequences are cut into chunks, which only adds ends of runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads them."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


#: A number for each byte value.
BYTES = mix(mix(np.arange(1, 257, dtype=np.uint64) * _BASE))


def _power(n: int, name: str) -> np.ndarray:
    got = _POWERS.get(name)
    if got is None or len(got) < n:
        base = np.full(max(n, 1024), _BASE if name == "up" else _INVERSE, np.uint64)
        base[0] = 1
        _POWERS[name] = got = np.cumprod(base)
    return got[:n]


def prefixes(values: np.ndarray) -> np.ndarray:
    """Sums from which ``spans`` gives the hash of any stretch."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(len(values), "up"), out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each stretch; it depends on the values alone, not on where they stand."""
    return mix((sums[ends] - sums[starts]) * _power(len(sums), "down")[starts])


def grams(sums: np.ndarray, gram: int) -> np.ndarray:
    n = len(sums) - gram
    return mix((sums[gram:] - sums[:-gram]) * _power(n, "down"))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: running minima from both ends of blocks of that width."""
    if width == 1:
        return x
    n = len(x)
    pad = np.full(-n % width, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
    blocks = np.concatenate([x, pad]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


_PLACE = np.uint64((1 << 18) - 1)


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes where its smallest stands, the leftmost of equal ones (by 46 bits)."""
    at = np.arange(len(hashes), dtype=np.uint64)
    return (sliding_min((hashes & ~_PLACE) | at, width) & _PLACE).astype(np.int64)


def runs(values: np.ndarray, length: int, gram: int, numbers: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (key, first window, windows, digest of the covered stretch, key at several places), chunk by chunk.

    ``numbers`` maps small values (bytes) to 64-bit ones. Only a run with its key at several places can hold two equal
    windows, as equal windows have their key at the same distance.
    """
    for low in range(0, len(values) - length + 1, CHUNK):
        part = values[low : low + CHUNK + length - 1]
        sums = prefixes(part if numbers is None else numbers[part])
        hashes = grams(sums, gram)
        at = smallest(hashes, length - gram + 1)
        moves = np.flatnonzero(at[1:] != at[:-1]) + 1
        ends_run = hashes[at[moves]] != hashes[at[moves - 1]]
        starts = np.concatenate([[0], moves[ends_run]])
        ends = np.append(starts[1:], len(at))
        several = np.zeros(len(starts), bool)
        several[np.searchsorted(starts, moves[~ends_run], "right") - 1] = True
        yield hashes[at[starts]], starts + low, ends - starts, spans(sums, starts, ends + (length - 1)), several


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places the half-open stretches cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0
