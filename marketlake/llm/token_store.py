"""Token ids in files of patched frame-of-reference blocks.

The ids of the documents, in ascending order of doc_id and each closed by an end id, are cut into segments of whole
documents, and a segment into blocks of BLOCK ids. A block keeps its least id, a width in bits, the ids minus the least
packed at that width, and a list of exceptions for the ids that need more; the width is the one that holds PERCENTILE
per cent of the block. A segment starts with a header and the index of its block starts, so any id can be read without
the blocks before it.

Segment, all numbers little-endian: magic ``PFB1``; unsigned 32-bit numbers of ids, blocks and documents; for each
document its number of ids (unsigned 64-bit); for each block its start, in bytes from the first block (unsigned
64-bit), and one more for the end; the blocks. Block: least id (32 bits), width (8 bits), number of exceptions (16 bits),
packed ids (least significant bit first, filled up to a byte), positions of the exceptions (16 bits each), the bits of
their values above the width (32 bits each).

A shard is a Parquet file whose rows are segments, so that Spark commits whole files and no half-written one is ever
read. A document is never parted between segments; one task holds one document and one segment at a time.

Defined results: a null or empty text is the end id alone; a null doc_id comes first; rows with equal ids are ordered
by their text; an empty table gives no segment.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.llm.common import Remembered, binaries, offsets, regrouped, slices, tasks
from marketlake.session import scratch_path

BLOCK = 1024
PERCENTILE = 95
SEGMENT = 1 << 18
#: Bytes of the memory for units, and of the texts whose units are taken together.
CACHE = 64 << 20
PART = 16 << 20
#: Bytes that are searched for the starts of units at a time.
SCAN = 1 << 20
#: Bytes of the units that the library gets in one text, and of the texts in one call, as a token takes some 100 bytes there.
JOINED = 16 << 10
CALL = 1 << 20
_BLANK = "\u0120"  # how the byte-level alphabet writes a blank
_MAGIC = b"PFB1"
_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("odd", "<u2")])


def _lanes(width: int) -> Iterator[tuple[int, int, int]]:
    """For each of 64 ids of ``width`` bits: its place, and the 64-bit word and the bit where it starts."""
    return ((j, j * width >> 6, j * width & 63) for j in range(64))


def _pack(ids: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each id, in bytes row by row; a row holds a multiple of 64 ids."""
    lanes = np.ascontiguousarray((ids.astype(np.uint64) & np.uint64((1 << width) - 1)).reshape(-1, 64).T)
    words = np.zeros((width + 1, lanes.shape[1]), np.uint64)
    for j, word, bit in _lanes(width):
        words[word] |= lanes[j] << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - bit)
    return np.ascontiguousarray(words[:width].T, "<u8").view(np.uint8).reshape(len(ids), -1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes, each of a multiple of 64 ids, to rows of ids."""
    words = np.ascontiguousarray(packed.reshape(-1, 8 * width).view("<u8").T.astype(np.uint64))
    lanes, low = np.empty((64, words.shape[1]), np.uint32), np.uint64((1 << width) - 1)
    for j, word, bit in _lanes(width):
        value = words[word] >> np.uint64(bit)
        if bit + width > 64:
            value |= words[word + 1] << np.uint64(64 - bit)
        lanes[j] = value & low
    return lanes.T.reshape(len(packed), -1)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of equal size, one for each row; those of one width are packed together."""
    n, count = ids.shape
    least = ids.min(axis=1)
    rest = ids - least[:, None]
    at = (count * PERCENTILE + 99) // 100 - 1
    widths = np.array([x.bit_length() for x in np.partition(rest, at, axis=1)[:, at].tolist()])
    packed: list = [b""] * n
    for width in {*widths.tolist()} - {0}:
        some = np.flatnonzero(widths == width)
        filled = np.pad(rest[some], ((0, 0), (0, -count % 64)))
        for i, row in zip(some.tolist(), _pack(filled, width), strict=True):
            packed[i] = row[: (count * width + 7) // 8].tobytes()
    most = ((1 << widths) - 1).astype(np.uint32)  # what the width of each block holds
    odd = np.flatnonzero(rest > most[:, None])
    rows, edges = odd // count, np.searchsorted(odd, np.arange(n + 1) * count)
    values, places = (rest.ravel()[odd] >> widths[rows]).astype("<u4").tobytes(), (odd % count).astype("<u2").tobytes()
    heads = np.zeros(n, _HEAD)
    heads["least"], heads["width"], heads["odd"] = least, widths, np.diff(edges)
    heads, edges = heads.tobytes(), edges.tolist()
    return [
        heads[_HEAD.itemsize * i : _HEAD.itemsize * (i + 1)] + packed[i] + places[2 * a : 2 * b] + values[4 * a : 4 * b]
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]


def unpack_blocks(blocks: list[memoryview], n: int) -> np.ndarray:
    """Blocks of ``n`` ids each to rows of ids; those of one width are unpacked together."""
    out = np.zeros((len(blocks), n), np.uint32)
    heads = np.frombuffer(b"".join(b[: _HEAD.itemsize] for b in blocks), _HEAD)
    widths = heads["width"].astype(np.int64)
    sizes = (n * widths + 7) // 8 + _HEAD.itemsize  # up to the exceptions
    for width in {*widths.tolist()} - {0}:
        some = np.flatnonzero(widths == width)
        size, filled = int(sizes[some[0]]), bytes(-(-n // 64) * 8 * width - (n * width + 7) // 8)
        packed = np.frombuffer(b"".join(x for i in some.tolist() for x in (blocks[i][_HEAD.itemsize : size], filled)), np.uint8)
        out[some] = _unpack(packed.reshape(len(some), -1), width)[:, :n]
    counts = heads["odd"].astype(np.int64)
    ends = list(zip(blocks, sizes.tolist(), (sizes + 2 * counts).tolist(), strict=True))
    places = np.frombuffer(b"".join(b[low:high] for b, low, high in ends), "<u2")
    values = np.frombuffer(b"".join(b[high:] for b, _, high in ends), "<u4")
    rows = np.repeat(np.arange(len(blocks)), counts)
    out[rows, places] |= values << widths[rows].astype(np.uint32)
    return out + heads["least"][:, None]


def pack_block(ids: np.ndarray) -> bytes:
    return pack_blocks(ids[None, :])[0]


def unpack_block(data: bytes, n: int) -> np.ndarray:
    return unpack_blocks([memoryview(data)], n)[0]


def write_segment(documents: list[np.ndarray]) -> bytes:
    ids = np.concatenate(documents)
    whole = len(ids) // BLOCK * BLOCK
    blocks = pack_blocks(ids[:whole].reshape(-1, BLOCK)) if whole else []
    if whole < len(ids):
        blocks.append(pack_block(ids[whole:]))
    starts = np.cumsum([0, *map(len, blocks)])
    head = _MAGIC + np.array([len(ids), len(blocks), len(documents)], "<u4").tobytes()
    return head + np.array([len(d) for d in documents], "<u8").tobytes() + starts.astype("<u8").tobytes() + b"".join(blocks)


class Segment:
    """Reads a segment; ``ids(a, b)`` unpacks the blocks it needs only."""

    def __init__(self, data: bytes | memoryview):
        if data[:4] != _MAGIC:
            raise ValueError("not a segment")
        self.n, self.n_blocks, n_docs = (int(x) for x in np.frombuffer(data, "<u4", 3, 4))
        self.lengths = np.frombuffer(data, "<u8", n_docs, 16).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", self.n_blocks + 1, 16 + 8 * n_docs).astype(np.int64)
        self.data, self.base = memoryview(data), 16 + 8 * n_docs + 8 * (self.n_blocks + 1)

    def ids(self, a: int, b: int) -> np.ndarray:
        first, last = a // BLOCK, (b - 1) // BLOCK
        blocks = [self.data[self.base + self.starts[k] : self.base + self.starts[k + 1]] for k in range(first, last + 1)]
        short = self.n - last * BLOCK < BLOCK  # the segment's last block
        parts = [unpack_blocks(blocks[: len(blocks) - short], BLOCK).ravel()] if len(blocks) > short else []
        if short:
            parts.append(unpack_block(blocks[-1], self.n - last * BLOCK))
        return np.concatenate(parts)[a - first * BLOCK : b - first * BLOCK]

    def documents(self) -> Iterator[np.ndarray]:
        ids, at = self.ids(0, self.n), 0
        for n in self.lengths:
            yield ids[at : at + n]
            at += n


def _table(**kinds: list[tuple[int, int]]) -> tuple[bytes, list[int]]:
    """A table of all bytes with a bit for each kind, set for bytes in its ranges (ends included), and the bits."""
    bits = [1 << k for k in range(len(kinds))]
    return bytes(sum(bit for bit, r in zip(bits, kinds.values(), strict=True) if any(a <= x <= b for a, b in r)) for x in range(256)), bits


_KINDS, (_WHITE, _FIRST, _SECOND, _LAST, _BEFORE, _LETTER, _POINT) = _table(
    white=[(0x09, 0x0D), (0x1C, 0x20)],
    # The first two bytes of white space outside ASCII, and its last two; each by itself, so more is taken for it.
    first=[(0xC2, 0xC2), (0xE1, 0xE3)],
    second=[(0x80, 0x81), (0x85, 0x85), (0x9A, 0x9A), (0xA0, 0xA0)],
    last=[(0x80, 0xBF)],
    before=[(0x80, 0x81), (0x9A, 0x9A), (0xA0, 0xA0), (0xC2, 0xC2)],
    letter=[(0x41, 0x5A), (0x61, 0x7A)],
    # ASCII punctuation without the apostrophe, which may be in one pre-token with letters.
    point=[(0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)],
)
#: A blank and no other white space: such units are in one text what they are alone.
_SPACED = r"^ [^\s\x0b\x1c-\x1f\x{85}\p{Z}]+$"


def _starts(text: np.ndarray) -> np.ndarray:
    """For each byte of some texts, whether a unit starts there wherever it stands; the first of a text always does."""
    n = len(text)
    data = np.zeros(n + 4, np.uint8)  # two more on either side; beside the ends of texts a cut is right whatever stands there
    data[2:-2] = text
    kinds = np.frombuffer(data.tobytes().translate(_KINDS), np.uint8)
    # Of each byte: the kinds of the two bytes before it, its own, and of the two after it.
    k2, k1, own, k3, k4 = (kinds[i : n + i] for i in range(5))
    b2, b1, byte = (data[i : n + i] for i in range(3))

    feed = byte == 0x0A
    gap = (byte == 0x20) | feed
    gap &= (k1 | k3) & _WHITE == 0
    gap &= (k1 & _LAST == 0) | (k2 & _BEFORE == 0)
    gap &= (k3 & _FIRST == 0) | (k4 & _SECOND == 0)
    letter = (b2 == 0xC3) & (k1 & _LAST != 0) & (b1 != 0x97) & (b1 != 0xB7)
    letter |= k1 & _LETTER != 0
    starts = gap | (letter & (own & _POINT != 0))
    starts[1:] |= gap[:-1] & feed[:-1]
    return starts


def _units(texts: pa.Array, special: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Texts without nulls, cut where byte-level pre-tokens always end, and the number of the first unit of each text.

    A unit starts with a blank, or with a line feed that is a unit of its own, if neither has white space beside it; and
    with ASCII punctuation (no apostrophe) behind a letter of ASCII or Latin-1. Where the bytes beside a cut might be
    white space there is none. A text that holds a ``special`` token, which may have any of these inside, is one unit.
    """
    whole = np.zeros(len(texts), bool)
    for token in special:
        whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
    texts = texts.cast(pa.large_string())
    edges, data = offsets(texts), texts.buffers()[2] or pa.py_buffer(b"")
    cuts = []
    for low, high in slices(texts, SCAN):
        a, b = edges[low], edges[high]
        starts = _starts(np.frombuffer(data, np.uint8, b - a, a))
        for i in low + np.flatnonzero(whole[low:high]):
            starts[edges[i] - a : edges[i + 1] - a] = False
        firsts = edges[low:high]
        starts[firsts[firsts < b] - a] = True
        cuts.append(np.flatnonzero(starts) + a)
    cuts = np.concatenate([*cuts, edges[-1:]])
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data), np.searchsorted(cuts, edges)


class Tokens:
    """The library's tokenizer with a memory, bounded by bytes, for the units that ``_units`` cuts texts into.

    A text's ids are those of its units. The units of some texts are taken together and each distinct one is looked up
    once. The library gets those that are new and start with their only white space, a blank, joined; a token that starts
    with a blank starts the next unit. All others are encoded alone.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core; threads for a few runs cost more than they save
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.starts_run = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.starts_run[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(_BLANK)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.units = Remembered(CACHE)

    @property
    def numbers(self) -> dict[str, int]:
        """The place of each unit remembered that starts with a blank, by what follows the blank."""
        return {unit[1:]: i for i, unit in enumerate(self.units.strings.to_pylist()) if unit.startswith(" ")}

    @property
    def held(self) -> int:
        return self.units.strings.nbytes + self.units.ids.nbytes + self.units.edges.nbytes

    def _library(self, texts: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for low, high in slices(texts, CALL):
            found = self.tokenizer.encode_batch_fast(texts.slice(low, high - low).to_pylist(), add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in found]
        return out

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order; none for a null or empty one."""
        total = pc.sum(pc.binary_length(texts)).as_py() or 0
        for low, high in slices(texts, max(1, -(-total // max(1, -(-total // PART))))):  # of equal sizes
            ids = self._part(pc.fill_null(texts.slice(low, high - low), ""))
            edges, data = offsets(ids) // 4, np.frombuffer(ids.buffers()[2] or b"", "<u4")
            yield from map(data.__getitem__, map(slice, edges[:-1].tolist(), edges[1:].tolist()))
            del ids, data
            pa.default_memory_pool().release_unused()

    def _part(self, texts: pa.Array) -> pa.LargeBinaryArray:
        units, first = _units(texts, self.special)
        units = units.dictionary_encode()
        made = self.units.take(self.units.places(units.dictionary, self._new))
        return regrouped(made.take(units.indices), first)

    def _new(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and where those of each start."""
        strings = pa.array(units, pa.large_string())
        alone = pc.invert(pc.match_substring_regex(strings, _SPACED))
        for token in self.special:
            alone = pc.or_(alone, pc.match_substring(strings, token))
        spaced, others = strings.filter(pc.invert(alone)), strings.filter(alone)
        alone = alone.to_numpy(zero_copy_only=False)
        joined = regrouped(spaced, np.array([0, *(high for _, high in slices(spaced, JOINED))])).cast(pa.large_string())
        ids = np.concatenate([np.empty(0, np.uint32), *self._library(joined)])
        starts = np.flatnonzero(self.starts_run[ids])
        if len(starts) != len(spaced):
            raise ValueError("the tokenizer does not part runs at blanks")
        odd = self._library(others)
        ends = len(ids) + np.cumsum([0, *map(len, odd)])
        both = binaries(np.concatenate([ids, *odd]), 4 * np.concatenate([starts, ends]))
        order = np.empty(len(units), np.int64)
        order[~alone], order[alone] = np.arange(len(spaced)), np.arange(len(spaced), len(units))
        both = both.take(pa.array(order))
        edges = offsets(both) // 4
        return np.frombuffer(both.buffers()[2] or b"", "<u4", edges[-1]), edges[:-1]


_TOKENS: dict[str, Tokens] = {}


def tokenizer(model: str) -> Tokens:
    """The worker's tokenizer, made once for each model: a name of this module, as what a task brings along goes with it."""
    if model not in _TOKENS:
        _TOKENS[model] = Tokens(model)
    return _TOKENS[model]


def read_model(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _writer(spark: SparkSession, model: str, end_id: int):
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(shared.value)
        shard, seq, start, size = TaskContext.get().partitionId(), 0, 0, 0
        names: list = []
        parts: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            row = [shard, seq, start, size, names, write_segment(parts)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES, strict=True)], names=_NAMES)

        end = np.array([end_id], "<u4")
        for batch in batches:
            for doc, encoded in zip(batch.column(0), tokens.encode(batch.column(1)), strict=True):
                ids = np.concatenate([encoded, end])
                names.append(doc.as_py())
                parts.append(ids)
                size += len(ids)
                if size >= SEGMENT:
                    yield segment()
                    seq, start, size, names, parts = seq + 1, start + size, 0, [], []
        if parts:
            yield segment()

    return run


_NAMES = ["shard", "seq", "shard_start", "n_ids", "doc_ids", "data"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]


def write(docs: DataFrame, model: str, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode with the tokenizer ``model`` (its JSON) and write shards to ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    # One shuffle: ranges of doc_id are the shards, in order.
    rows = rows.repartitionByRange(tasks(spark), "doc").sortWithinPartitions("doc", "text")
    rows.mapInArrow(_writer(spark, model, end_id), "shard int, seq int, shard_start long, n_ids long, doc_ids array<long>, data binary").write.parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, start, names, data in zip(*(batch.column(i) for i in range(4)), strict=True):
            segment, docs = Segment(memoryview(data.as_buffer())), names.values
            ids = memoryview(segment.ids(0, segment.n).astype("<u4", copy=False)).cast("B")
            edges = np.cumsum([0, *segment.lengths])
            sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            cols = [pa.array([shard.as_py()] * len(docs), pa.int32()), docs, *(pa.array(x, pa.int64()) for x in (edges[:-1] + start.as_py(), segment.lengths, sums))]
            yield pa.RecordBatch.from_arrays(cols, names=["shard", "doc_id", "own_start", "n_tokens", "ids_crc32"])


def shard_starts(segments: DataFrame) -> DataFrame:
    """Ids before each shard; one row per shard, so the window is small."""
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the shards under ``path``: doc_id, start (ids before it), n_tokens, ids_crc32."""
    segments = spark.read.schema("shard int, seq int, shard_start long, n_ids long, doc_ids array<long>, data binary").parquet(path)
    rows = segments.select("shard", "shard_start", "doc_ids", "data").mapInArrow(_reader, "shard int, doc_id long, own_start long, n_tokens long, ids_crc32 long")
    starts = F.broadcast(shard_starts(segments))  # one row per shard: as many as shuffle partitions
    rows = rows.join(starts, "shard")
    return rows.select("doc_id", (F.col("own_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, model, path, doc_id, text, end_id)
    return read(docs.sparkSession, path)
