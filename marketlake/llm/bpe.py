"""Byte-level BPE by merge ranks, with a hierarchical-bitmap rank queue.

A text is cut by the pattern; each piece is merged on its own: the pair of neighbouring tokens whose joined bytes have
the lowest rank goes first, the leftmost among equal ones. The queue holds, for each rank, the positions of such pairs
in the linked list of tokens; a bitmap in two levels tells by find-first-set which rank comes next, and an entry
whose pair has changed meanwhile is skipped when it comes up. So a piece of n bytes takes about n log n steps however
long it is.

Many short pieces share one linked list and one queue (``merge_all``): a bucket is then worked off with array
operations. Pieces do not touch, so each is merged as if it were alone, as long as no merge makes a pair of a lower rank
than its own; a piece in which one does is merged again by itself.

Defined results: a null text is empty and gives no ids; every row is encoded on its own, so repeated rows, ties and
further columns do not matter; decoding gives the UTF-8 bytes of the text back.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from marketlake.llm.common import Remembered, Runs, offsets, regrouped, slices

#: Bytes of text whose runs are cut together, of new pieces that are merged together, and of the memory for pieces.
SLICE = 4 << 20
PART = 1 << 20
CACHE = 24 << 20
#: Runs that are cut by the pattern in one text.
JOINED = 4096


def read_ranks(path: str) -> bytes:
    """The rank file as it is; it is small and goes to the executors with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class RankQueue:
    """The two-level bitmap: ``leaf`` has a bit for each rank with a bucket, the summary a bit for each leaf in use.

    ``Encoder.merge`` runs push and pop in line, as they are its inner loop.
    """

    def __init__(self, n_ranks: int):
        self.shift = max(1, (n_ranks.bit_length() + 1) // 2)
        self.mask = (1 << self.shift) - 1
        self.leaf = [0] * ((n_ranks >> self.shift) + 1)
        self.bit = [1 << i for i in range(max(self.mask + 1, len(self.leaf)))]


class Encoder:
    """Ranks, pattern and caches of one worker."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.ranks.values()}
        self.queue = RankQueue(max(self.ranks.values(), default=0) + 1)
        self.find = regex.compile(pattern).findall
        self.pieces = Remembered(CACHE)
        self.keys, self.made = self._pairs()
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tokens that make a token: sorted keys, and the rank of each."""
        get, keys, made = self.ranks.get, array("q"), array("i")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(rank)
        keys, made = np.array(keys, np.int64), np.array(made, np.int32)
        order = np.argsort(keys)
        return keys[order], made[order]

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, -1 for none; tokens below 0 are none."""
        keys = a.astype(np.int64) << 32 | b.astype(np.int64) & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], -1) if len(self.keys) else np.full(len(keys), -1, np.int32)

    def merge_all(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of each piece."""
        out: dict[str, bytes] = {}
        part, size = [], 0
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                out[piece] = self.packed[whole]
                continue
            if part and size + len(raw) > PART:
                self._merge_part(part, size, out)
                part, size = [], 0
            part.append((piece, raw))
            size += len(raw)
        self._merge_part(part, size, out)
        return out

    def _merge_part(self, part: list[tuple[str, bytes]], size: int, out: dict[str, bytes]) -> None:
        if size < 1 << 17 or self.single.min() < 0:  # few pieces are sooner done one by one
            out.update((piece, self.merge(raw)) for piece, raw in part)
            return
        for (piece, raw), ids in zip(part, self._merge_together([raw for _, raw in part]), strict=True):
            out[piece] = self.merge(raw) if ids is None else ids

    def _merge_together(self, pieces: list[bytes]) -> list[bytes | None]:
        """The ids of each piece, None for one that must be merged by itself."""
        shift, mask, leaf, bit = self.queue.shift, self.queue.mask, self.queue.leaf, self.queue.bit
        ends = np.cumsum([len(p) for p in pieces])
        n = int(ends[-1])
        starts = np.concatenate([[0], ends[:-1]])
        # One more place, n, stands for "none".
        token = np.append(self.single[np.frombuffer(b"".join(pieces), np.uint8)], np.int32(-1))
        after = np.arange(1, n + 2, dtype=np.int32)
        after[ends - 1] = n
        after[n] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[starts] = n
        live = np.ones(n, bool)
        now = np.full(n + 1, -1, np.int32)
        for low in range(0, n, 1 << 18):  # in parts, as the keys take several times the space of the tokens
            high = min(n, low + (1 << 18))
            now[low:high] = self._ranks_of(token[low:high], token[after[low:high]])
        first = np.flatnonzero(now >= 0).astype(np.int32)
        first = first[np.argsort(now[first], kind="stable")]
        cuts = np.flatnonzero(np.diff(now[first], prepend=-1))
        buckets: dict[int, list] = {int(now[p[0]]): [p] for p in np.split(first, cuts[1:])} if len(first) else {}
        late: dict[int, list[int]] = {}
        summary = 0
        for rank in buckets:
            leaf[rank >> shift] |= bit[rank & mask]
            summary |= bit[rank >> shift]
        odd: set[int] = set()
        while summary:
            top = (summary & -summary).bit_length() - 1
            word = leaf[top]
            low = word & -word
            rank = (top << shift) + low.bit_length() - 1
            leaf[top] = word = word ^ low
            if not word:
                summary ^= bit[top]
            at = np.unique(np.concatenate([*buckets.pop(rank, []), np.array(late.pop(rank, []), np.int64)]))
            at = at[now[at] == rank]  # the others are stale
            if len(at) > 1:
                # Where pairs overlap (x x x), every other one of the run is merged, from the left.
                place = np.arange(len(at))
                begins = np.concatenate([[True], after[at[:-1]] != at[1:]])
                at = at[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            end = after[gone]
            token[at] = rank
            after[at] = end
            before[end] = at
            live[gone] = False
            now[gone] = -1
            left = before[at]
            where = np.concatenate([at, left[left < n]])
            new = self._ranks_of(token[where], token[after[where]])
            now[where] = new
            made = new >= 0
            for place, rank_of in zip(where[made].tolist(), new[made].tolist(), strict=True):
                if rank_of < rank:
                    odd.add(int(np.searchsorted(ends, place, "right")))
                if rank_of in late:
                    late[rank_of].append(place)
                else:
                    late[rank_of] = [place]
                    leaf[rank_of >> shift] |= bit[rank_of & mask]
                    summary |= bit[rank_of >> shift]
        ids = token[:-1][live].astype("<u4").tobytes()
        to = (4 * np.cumsum(np.add.reduceat(live, starts, dtype=np.int64))).tolist()
        return [None if k in odd else ids[a:b] for k, (a, b) in enumerate(zip([0, *to[:-1]], to, strict=True))]

    def merge(self, piece: bytes) -> bytes:
        """The ids of one piece, as ``encode`` gives them."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return self.packed[whole]
        shift, mask, leaf, bit = self.queue.shift, self.queue.mask, self.queue.leaf, self.queue.bit
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        now = [get(piece[i : i + 2]) for i in range(n - 1)]  # the rank of the pair that starts here, None for no pair
        now.append(None)
        buckets: dict[int, list[int]] = {}
        summary = 0
        for i, rank in enumerate(now):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    leaf[rank >> shift] |= bit[rank & mask]
                    summary |= bit[rank >> shift]
        while summary:
            # Find-first-set: the lowest leaf in use, the lowest rank in it, the leftmost position of that rank.
            top = (summary & -summary).bit_length() - 1
            word = leaf[top]
            low = word & -word
            rank = (top << shift) + low.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                (i,) = bucket
                del buckets[rank]
                leaf[top] = word = word ^ low
                if not word:
                    summary ^= bit[top]
            if now[i] != rank:
                continue  # stale: the pair has grown or is gone
            j = after[i]
            end = after[j]
            after[i] = end
            now[j] = None
            before[end] = i
            if i:
                left = before[i]
                now[left] = new = get(piece[left:end])
                if new is not None:
                    if new in buckets:
                        heappush(buckets[new], left)
                    else:
                        buckets[new] = [left]
                        leaf[new >> shift] |= bit[new & mask]
                        summary |= bit[new >> shift]
            now[i] = new = get(piece[i : after[end]]) if end < n else None
            if new is not None:
                if new in buckets:
                    heappush(buckets[new], i)
                else:
                    buckets[new] = [i]
                    leaf[new >> shift] |= bit[new & mask]
                    summary |= bit[new >> shift]
        out, i = [], 0
        while i < n:
            out.append(self.packed[self.ranks[piece[i : after[i]]]])
            i = after[i]
        return b"".join(out)

    def _cut(self, texts: Iterable[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and the number of those of each."""
        parts, held, counts = [], [], []
        for text in texts:
            found = self.find(text)
            counts.append(len(found))
            held += found
            if len(held) > 1 << 16:
                parts.append(pa.array(held, pa.string()))
                held = []
        return pa.concat_arrays([*parts, pa.array(held, pa.string())]), np.array(counts, np.int64)

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and where those of each start."""
        ids = list(map(self.merge_all(pieces).__getitem__, pieces))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes

    def encode_all(self, texts: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each text as little-endian unsigned 32-bit integers, none for a null.

        A blank between two other characters always starts a piece, so what follows it up to the next one is a run that
        can be cut on its own: each distinct run is cut once, and of the distinct pieces only those are merged, together,
        that the worker does not remember. What is then put together are ranges of ids.
        """
        runs = Runs(pc.fill_null(texts, ""))
        pieces, counts = self._cut(runs.heads.to_pylist())
        parts, units = [pieces], [np.cumsum(counts) - counts]
        for n, joined in runs.joined(JOINED):
            found, _ = self._cut([joined])
            starts = np.flatnonzero(pc.starts_with(found, " ").to_numpy(zero_copy_only=False))
            if len(starts) != n:
                raise ValueError("the pattern does not part texts at blanks")
            units.append(sum(map(len, parts)) + starts)
            parts.append(found)
        cut = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
        places = self.pieces.places(cut.dictionary, self._new)
        made = self.pieces.take(places[cut.indices.to_numpy()])
        return runs.whole(regrouped(made, np.append(np.concatenate(units), len(made))))

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].as_py()


class Decoder:
    """The token of each id; nothing of the encoder is held."""

    def __init__(self, ranks: bytes):
        tokens = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, ranks.splitlines())}
        self.tokens = pa.array([tokens.get(rank) for rank in range(max(tokens, default=-1) + 1)], pa.large_binary())

    def decode_all(self, ids: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The bytes that each text's ids stand for."""
        edges = offsets(ids)
        numbers = np.frombuffer(ids.buffers()[2] or b"", "<u4", (edges[-1] - edges[0]) // 4, edges[0])
        made = self.tokens.take(pa.array(numbers))
        if made.null_count:
            raise KeyError("an id without a token")
        return regrouped(made, (edges - edges[0]) // 4)

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all(pa.array([ids], pa.large_binary()))[0].as_py()


_ENCODERS: dict[tuple[bytes, str], Encoder] = {}
_DECODERS: dict[bytes, Decoder] = {}


def encoder(ranks: bytes, pattern: str) -> Encoder:
    """The worker's encoder; made once for each vocabulary and pattern."""
    key = (ranks, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", to: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids as a binary column (little-endian unsigned 32-bit); replaces a column of that name.

    ``decoded`` names a further column for the bytes that these ids stand for, made in the same pass.
    """
    new = [to] if decoded is None else [to, decoded]
    schema = StructType([f for f in docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new]).schema.fields])
    for name in new:
        schema = schema.add(name, BinaryType())
    return docs.mapInArrow(_encoder(docs.sparkSession, ranks, pattern, text, schema.names, decoded is not None), schema)


def decode(docs: DataFrame, ranks: bytes, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for."""
    return docs.withColumn(to, _decode(docs.sparkSession, ranks)(F.col(ids)))


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def _decoder(ranks: bytes) -> Decoder:
    if ranks not in _DECODERS:
        _DECODERS[ranks] = Decoder(ranks)
    return _DECODERS[ranks]


def _encoder(spark: SparkSession, ranks: bytes, pattern: str, text: str, names: list[str], back: bool):
    shared = spark.sparkContext.broadcast(ranks)
    kept = names[: len(names) - 1 - back]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tokens = encoder(shared.value, pattern), _decoder(shared.value) if back else None
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for low, high in slices(column, SLICE):
                rows = batch.slice(low, high - low)
                ids = own.encode_all(column.slice(low, high - low))
                new = [ids, tokens.decode_all(ids)] if back else [ids]
                columns = [rows.column(batch.schema.names.index(c)) for c in kept] + [c.cast(pa.binary()) for c in new]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                del rows, ids, new, columns
                pa.default_memory_pool().release_unused()  # or the worker keeps it, idle or in the next stage

    return run


def _decode(spark: SparkSession, ranks: bytes):
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf(BinaryType())
    def run(ids: pd.Series) -> pd.Series:
        own = _decoder(shared.value)
        return pd.Series([own.decode(x or b"") for x in ids], dtype=object)

    return run
