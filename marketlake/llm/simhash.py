"""SimHash near-duplicates through an inverted index of fingerprint bytes with count filtering.

A fingerprint has eight bytes. Two that differ in at most four bits share at least four bytes at the same position, and
any four positions hold one of TRIPLES. So the index is keyed by three positional bytes: every linked pair meets in a
posting. Within a posting the bytes that a pair shares by position are tallied, pairs with four or more are kept and
their differing bits counted. A posting hands on one edge per fingerprint to the smallest of its local group, never all
pairs. Equal fingerprints are one entry from the start. A posting longer than LONGEST is cut by a fourth shared byte,
and one that is still longer by one of five blocks of the other 32 bits, of which four differing bits leave one equal.

``drop_similar`` keeps one document of those that are alike in their five-word shingles. The fingerprints of these
shingles go through the index above first; a member of a group is then checked with the group's first. Four bits are
strict, so a second index follows over the bytes of a longer print for what they miss: a text's sketch is the least
shingle hash of each of BINS bins, one byte each; a bin without a shingle borrows the byte of another one, so short texts
have a byte everywhere. This index is keyed by BANDS groups of ROWS bytes: a pair of similarity j shares a key with a
probability of 1 - (1 - j^ROWS)^BANDS, 0.9999 at 0.8, and shared bytes are tallied by position against the least number
that goes with SIMILAR. Both find candidates only; a link is a pair whose shingle sets are SIMILAR.

Defined results: a null or empty text has fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; repeated rows and null ids are rows like others, an id is the smallest of those that are not
null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructType

from marketlake.llm.common import tasks
from marketlake.llm.components import components
from marketlake.session import stage

BITS = 4
SHARED = 8 - BITS
LONGEST = 4096
BINS = 128
SIMILAR = 0.8
ROWS = 5
BANDS = BINS // ROWS
#: Shingles of the sets that a task holds at once when it compares those of a posting: a tile has two parts of this size.
TILE = 1 << 18
#: Bits of the filter that keeps texts out of a shuffle; it goes to all tasks, as 4 MB at most.
MARKS = 1 << 25


def _triples() -> list[tuple[int, ...]]:
    """Sets of three positions of which any four positions hold one: three parts, two from a part and one from the next."""
    part = [0, 0, 0, 1, 1, 1, 2, 2]

    def wanted(t: tuple[int, ...]) -> bool:
        kinds = sorted(part[i] for i in t)
        return kinds[0] == kinds[2] or any(kinds.count(p) == 2 and kinds.count((p + 1) % 3) == 1 for p in range(3))

    return [t for t in combinations(range(8), 3) if wanted(t)]


TRIPLES = _triples()
#: The five blocks of 32 bits: first bit and number of bits.
BLOCKS = [(0, 7), (7, 7), (14, 6), (20, 6), (26, 6)]


def shingles(text: str | None, width: int) -> list[int]:
    """The hashes of a text's shingles, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return []
    if len(words) < width:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-width]])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)]


def simhash(text: str | None, width: int) -> int:
    """The fingerprint of a text as a signed 64-bit number."""
    return _simhash_of(shingles(text, width))


def _simhash_of(hashes: list[int]) -> int:
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 14):
        block = np.array(hashes[low : low + (1 << 14)], "<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def sketch(text: str | None, width: int) -> bytes:
    """One byte for the least shingle hash of each bin, zero for an empty bin."""
    return _sketch_of(np.array(shingles(text, width), np.uint64))


def _sketch_of(hashes: np.ndarray) -> bytes:
    none = np.iinfo(np.uint64).max
    least = np.full(BINS, none, np.uint64)
    np.minimum.at(least, (hashes % np.uint64(BINS)).astype(np.int64), hashes // np.uint64(BINS))
    return np.where(least == none, 0, 1 + least % np.uint64(255)).astype(np.uint8).tobytes()


def alike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of a sketch with each row of ``many``; sketches of no shingles are alike."""
    some = ((one | many) != 0).sum(axis=1)
    same = ((one == many) & (one != 0)).sum(axis=1)
    return np.where(some == 0, 1.0, same / np.maximum(some, 1))


def fingerprint(text: str, width: int) -> Column:
    @F.pandas_udf(LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, width) for t in texts], dtype="int64")

    return run(F.col(text))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    return np.unique(np.array(shingles(text, width), np.uint64))


def _shingle_print(text: str, width: int) -> Column:
    """(hash of the shingle set, its size, fingerprint of the shingles, sketch of the set)."""

    @F.pandas_udf(StructType().add("node", "long").add("size", "long").add("fp", "long").add("sketch", "binary"))
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            hashes = shingles(t, width)
            own = np.unique(np.array(hashes, np.uint64))
            rows.append((xxhash.xxh64_intdigest(own.tobytes(), 7), len(own), _simhash_of(hashes), _sketch_of(own)))
        nodes, sizes, fps, sketches = zip(*rows, strict=True) if rows else ((), (), (), ())
        nodes = np.array(nodes, np.uint64).view(np.int64)
        return pd.DataFrame({"node": nodes, "size": np.array(sizes, np.int64), "fp": np.array(fps, np.int64), "sketch": pd.Series(sketches, dtype=object)})

    return run(F.col(text))


#: For each bin the order in which it looks for a bin with a shingle, itself first.
LENDERS = np.array([[i, *np.random.default_rng(i).permutation(np.delete(np.arange(BINS), i))] for i in range(BINS)])


def _filled(sketches: np.ndarray) -> np.ndarray:
    """Sketches whose empty bins have borrowed a byte."""
    full = sketches.copy()
    for i in np.flatnonzero((sketches == 0).any(axis=1) & (sketches != 0).any(axis=1)):
        lent = sketches[i][LENDERS]
        full[i] = lent[np.arange(BINS), (lent != 0).argmax(axis=1)]
    return full


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """Rows of sketches to rows of BANDS keys, each of them the band's number and its bytes."""
    full = _filled(sketches)
    parts = full[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.int64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.int64), parts.shape[:2])
    for r in range(ROWS):
        keys = (keys << 8) + parts[:, :, r]
    return keys


def _rows_of(sketches: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, BINS)


@F.pandas_udf(ArrayType(LongType()))
def _bands(sketches: pd.Series) -> pd.Series:
    return pd.Series(list(band_keys(_rows_of(sketches))), dtype=object)


def shares_enough(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether so many bytes are equal by position that SIMILAR is within four standard errors."""
    some = ((one | many) != 0).sum(axis=1)
    same = ((one == many) & (one != 0)).sum(axis=1)
    return same >= SIMILAR * some - 4 * np.sqrt(SIMILAR * (1 - SIMILAR) * some)


@F.pandas_udf(BooleanType())
def _maybe_alike(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(shares_enough(_rows_of(a), _rows_of(b)))


@F.pandas_udf(BooleanType())
def _alike_sets(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether the Jaccard similarity of two shingle sets is SIMILAR or more."""

    def alike_pair(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        either = len(x) + len(y) - both
        return both / either >= SIMILAR if either else True

    return pd.Series([alike_pair(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _byte(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255))


def _packed(fp: Column, positions) -> Column:
    out = F.lit(0).cast("long")
    for i in positions:
        out = F.shiftleft(out, 8) + _byte(fp, i)
    return out


def _postings(fps: DataFrame) -> DataFrame:
    """``fps`` with a key ``k`` for each triple, which holds the triple's number and its bytes."""
    fp = F.col("fp")
    keys = [F.lit(t << 24).cast("long") + _packed(fp, triple) for t, triple in enumerate(TRIPLES)]
    return fps.select(F.explode(F.array(*keys)).alias("k"), *fps.columns)


def _by_fourth(postings: DataFrame) -> DataFrame:
    """Long postings cut by a fourth position: the same pairs with four shared bytes meet."""
    parts = []
    for t, triple in enumerate(TRIPLES):
        rest = [i for i in range(8) if i not in triple]
        keys = F.array(*[F.struct(F.lit(i).alias("p"), _byte(F.col("fp"), i).alias("y")) for i in rest])
        parts.append(F.when(F.shiftright("k", 24) == t, keys))
    rows = postings.withColumn("z", F.explode(F.coalesce(*parts)))
    return rows.select((F.col("k") * 2048 + F.col("z.p") * 256 + F.col("z.y")).alias("k"), *postings.columns[1:])


def _by_block(postings: DataFrame) -> DataFrame:
    """Still long ones cut by blocks of the four bytes that the key does not fix."""
    rows = []
    for t, triple in enumerate(TRIPLES):
        for p in [i for i in range(8) if i not in triple]:
            rest = _packed(F.col("fp"), [i for i in range(8) if i not in triple and i != p])
            cut = [F.struct(F.lit(n).alias("p"), F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << w) - 1)).alias("y")) for n, (a, w) in enumerate(BLOCKS)]
            same = (F.shiftright("k", 35) == t) & (F.shiftright("k", 8).bitwiseAND(F.lit(7)) == p)
            rows.append(F.when(same, F.array(*cut)))
    out = postings.withColumn("z", F.explode(F.coalesce(*rows)))
    return out.select((F.col("k") * 1024 + F.col("z.p") * 128 + F.col("z.y")).alias("k"), *postings.columns[1:])


def local_edges(fps: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, first member) of the groups that the links among these entries make."""
    edges, rest, left = [], np.arange(len(fps)), fps
    while len(rest) > 1:
        root, queue, rest, left = rest[0], [rest[0]], rest[1:], left[1:]
        while queue and len(rest):
            at = queue.pop()
            x = left ^ fps[at]
            tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # shared bytes by position
            near = tally >= SHARED
            near[near] = np.bitwise_count(x[near].view(np.uint64)) <= BITS
            if near.any():
                found, rest, left = rest[near], rest[~near], left[~near]
                queue += found.tolist()
                edges += [(int(f), int(nodes[root])) for f in nodes[found]]
    return edges


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings, each in one piece and in order of their key, to edges; the open posting is carried over batches."""
    held_k, held = None, []

    def flush() -> list[tuple[int, int]]:
        return local_edges(*[np.concatenate(c) for c in zip(*held, strict=True)]) if held else []

    for batch in batches:
        k, *cols = (batch.column(i).to_numpy() for i in range(3))
        if not len(k):
            continue
        cuts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        edges = []
        for a, b in zip(cuts, np.append(cuts[1:], len(k)), strict=True):
            if k[a] != held_k:
                edges += flush()
                held_k, held = k[a], []
            held.append([c[a:b] for c in cols])
        yield _edge_batch(edges)
    yield _edge_batch(flush())


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _compare(postings: DataFrame) -> DataFrame:
    n = tasks(postings.sparkSession)
    return postings.repartition(n, "k").sortWithinPartitions("k").mapInArrow(_links, "a long, b long")


def link(fps: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Distinct fingerprints ``fp`` to (fp, root), for those that are linked with another."""
    return link_entries(fps.select("fp", F.col("fp").alias("node")), longest).withColumnRenamed("node", "fp")


def link_entries(fps: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Entries (fp, node) to (node, root), for those that are linked with another."""
    edges = None
    postings = _postings(fps)
    for finer in (_by_fourth, _by_block, None):
        sizes = postings.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        counts = stage(sizes.where("n > 1"), "postings")
        rows = postings.join(counts, "k")
        few = rows.where(F.col("n") <= longest) if finer else rows
        found = stage(_compare(few.select(*postings.columns)), "links")
        edges = found if edges is None else edges.unionByName(found)
        if finer is None or counts.where(F.col("n") > longest).isEmpty():
            break
        long = postings.join(counts.where(F.col("n") > longest), "k").select(*postings.columns)
        postings = stage(finer(long), "postings")
    return components(edges)


def cluster(prints: DataFrame) -> DataFrame:
    """``prints`` (id, fp) to one row per fingerprint: fp, ``group`` (a fingerprint), ``component`` (smallest id)."""
    own = stage(prints.groupBy("fp").agg(F.min("id").alias("low")), "fingerprints")
    roots = own.join(link(own.select("fp")), "fp", "left").withColumn("group", F.coalesce("root", "fp"))
    roots = stage(roots.select("fp", "group", "low"), "groups")
    return roots.select("fp", "group").join(roots.groupBy("group").agg(F.min("low").alias("component")), "group")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stage(docs.select(F.col(doc_id).alias("id"), fingerprint(text, width).alias("fp")), "prints")
    rows = prints.join(cluster(prints), "fp")
    return rows.select(F.col("id").alias("doc_id"), as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """The document with the smallest id of each group, with its own columns."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    marked = stage(docs.withColumn("__fp", fingerprint(text, width)), "marked")
    groups = cluster(marked.select(F.col(doc_id).alias("id"), F.col("__fp").alias("fp")))
    groups = groups.select(F.col("fp").alias("__fp"), F.col("group").alias("__group"), F.col("component").alias("__low"))
    kept = marked.join(groups, "__fp").where(F.col(doc_id).eqNullSafe(F.col("__low")))
    return kept.dropDuplicates(["__group"]).select(*own)


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _marked_in(rows: DataFrame, some: DataFrame, by: str, flag: str) -> DataFrame:
    """``rows`` with a ``flag`` that is true where ``by`` is a value of ``some``, and for few others (a hash of MARKS bits).

    Long rows without it need no shuffle to be told apart; those with it are joined as usual.
    """
    spot = F.pmod(F.xxhash64(by), F.lit(MARKS))
    bit = F.bitmap_bit_position(spot)
    marks = some.groupBy(F.bitmap_bucket_number(spot).alias("__bucket")).agg(F.bitmap_construct_agg(bit).alias("__marks"))
    byte = F.conv(F.hex(F.substring("__marks", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    out = rows.withColumn("__bucket", F.bitmap_bucket_number(spot)).join(F.broadcast(marks), "__bucket", "left")
    return out.withColumn(flag, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("__bucket", "__marks")


def _with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with ``column`` of both nodes as x and y."""
    one, two = (of.select(F.col("node").alias(n), F.col(column).alias(c)) for n, c in (("a", "x"), ("b", "y")))
    return pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")


def _verified(pairs: DataFrame, entries: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` whose shingle sets are SIMILAR; the tally of sketches refuses clear cases before sets are looked up."""
    pairs = stage(_with_both(pairs, entries, "sketch").where(_maybe_alike("x", "y")).select("a", "b"), "candidates")
    return stage(_with_both(pairs, sets, "set").where(_alike_sets("x", "y")).select("a", "b"), "links")


def _shingle_sets(entries: DataFrame, nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(node, set) of the ``nodes``, from the text of one row of each; ``texts`` are (row, text)."""

    @F.pandas_udf("binary")
    def as_set(column: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, width).tobytes() for t in column], dtype=object)

    wanted = stage(entries.join(nodes, "node", "left_semi").select("node", "row"), "wanted")
    found = _marked_in(texts, wanted, "row", "found").where("found")
    return stage(found.join(wanted.hint("merge"), "row").select("node", as_set("text").alias("set")), "sets")


def _mixed(rows: DataFrame) -> DataFrame:
    """Postings (k, node, group, size) that hold several groups, with their largest one as ``main``.

    ``mains`` and ``others`` say in how many parts of TILE shingles the entries of that group and the rest are cut.
    """
    counts = rows.groupBy("k", "group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    main = counts.groupBy("k").agg(F.max(F.struct("n", "group", "s")).alias("m"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    parts = lambda size: F.greatest(F.lit(1), F.ceil(size / TILE)).cast("long")
    main = main.select("k", F.col("m.group").alias("main"), parts(F.col("m.s")).alias("mains"), parts(F.col("s") - F.col("m.s")).alias("others"))
    return rows.join(main, "k")


def _tiles() -> Column:
    """The tiles of an entry of a mixed posting: each entry that is not of the main group meets all others in a tile.

    Tile (x, y) holds part x of the others, and part y of the main group or, from ``mains`` on, another part of the others.
    """
    mains, others = F.col("mains"), F.col("others")
    wide, upto = mains + others, lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    part = lambda n: F.pmod(F.xxhash64("node"), n)
    of_main = F.transform(upto(others), lambda x: x * wide + part(mains))
    with_main = F.transform(upto(mains), lambda y: part(others) * wide + y)
    rest = F.filter(upto(others), lambda x: x != part(others))
    with_rest = F.transform(rest, lambda x: F.least(x, part(others)) * wide + mains + F.greatest(x, part(others)))
    return F.when(F.col("group") == F.col("main"), of_main).otherwise(F.concat(with_main, with_rest))


def links_across(nodes: np.ndarray, groups: np.ndarray, main: int, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between entries of different groups whose sets are SIMILAR, at least a chain of them between any two groups.

    No set is empty: the empty one is one entry and its sketch, all zeros, meets no other.
    """
    sizes = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    groups, edges, held = groups.copy(), [], np.zeros(len(values), np.int64)
    for i in np.flatnonzero(groups != main):
        own = flat[starts[i] : starts[i] + sizes[i]]
        held[own] = 1
        both = np.add.reduceat(held[flat], starts)
        held[own] = 0
        near = np.flatnonzero((groups != groups[i]) & (both / (sizes + sizes[i] - both) >= SIMILAR))
        met, first = np.unique(groups[near], return_index=True)
        edges += [(int(nodes[i]), int(nodes[j])) for j in near[first]]
        groups[np.isin(groups, met)] = groups[i]  # they are one group now
    return edges


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """The tiles (k, tile) of sorted rows and the further columns of each; the open tile is carried over batches."""
    key, held = None, []
    for batch in batches:
        for k, tile, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k, tile) != key:
                if len(held) > 1:
                    yield key, held
                key, held = (k, tile), []
            held.append(row)
    if len(held) > 1:
        yield key, held


def worth_comparing(k: int, groups: np.ndarray, main: int, sketches: np.ndarray) -> np.ndarray:
    """Which entries of posting ``k`` share enough bytes with one of another group; a pair counts in its first band only."""
    band, keys, worth = k >> (8 * ROWS), band_keys(sketches), np.zeros(len(groups), bool)
    for i in np.flatnonzero(groups != main):
        near = np.flatnonzero(groups != groups[i])
        near = near[~(keys[near, :band] == keys[i, :band]).any(axis=1)]
        near = near[shares_enough(sketches[i], sketches[near])]
        worth[near] = True
        worth[i] |= len(near) > 0
    return worth


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (k, tile), rows in _held(batches):
        nodes, groups, mains, sketches = zip(*rows, strict=True)
        worth = np.flatnonzero(worth_comparing(k, np.array(groups), mains[0], _rows_of(sketches)))
        if len(worth):
            out = [[k] * len(worth), [tile] * len(worth), *([c[i] for i in worth] for c in (nodes, groups, mains))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["k", "tile", "node", "group", "main"])


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _held(batches):
        nodes, groups, mains, sets = zip(*rows, strict=True)
        edges = links_across(np.array(nodes), np.array(groups), mains[0], [np.frombuffer(s, np.uint64) for s in sets])
        if edges:
            yield _edge_batch(edges)


def _across(mixed: DataFrame, entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between entries of different groups that meet in a posting.

    Both the tally of their sketches and the comparison of the sets that it leaves are done in tasks, tile by tile.
    """
    n, columns = tasks(mixed.sparkSession), ["k", "tile", "node", "group", "main"]
    tiled = mixed.select("k", F.explode(_tiles()).alias("tile"), "node", "group", "main")

    def by_tile(of: DataFrame, column: str) -> DataFrame:
        rows = tiled.join(of.select("node", column).hint("merge"), "node").select(*columns, column)
        return rows.repartition(n, "k", "tile").sortWithinPartitions("k", "tile")

    tiled = stage(by_tile(entries, "sketch").mapInArrow(_tally, ", ".join(f"{c} long" for c in columns)), "tallied")
    return stage(by_tile(sets, "set").mapInArrow(_cross, "a long, b long"), "links")


def link_similar(entries: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Entries (node, row, size, fp, sketch) with ``texts`` (row, text) to (node, root), for those linked with another.

    Candidates are the entries that fingerprints link, each with its group's first, and the entries that meet in a
    posting of sketch bytes, first each with the posting's hub, the entry that meets the most others: that links a group
    of copies at once. Then the entries of a posting are compared that are still in different groups, but never two of
    one group.
    """
    prints = stage(cluster(entries.select(F.col("node").alias("id"), "fp")).select("fp", "component"), "prints")
    near = stage(entries.join(prints, "fp").where("node != component").select(*_pair(F.col("node"), F.col("component"))), "near")
    postings = stage(entries.select("node", "size", F.explode(_bands("sketch")).alias("k")), "postings")
    sizes = stage(postings.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    postings = stage(postings.join(sizes.hint("merge"), "k"), "postings", [postings])
    weights = postings.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = postings.join(weights, "node").groupBy("k").agg(F.max(F.struct("weight", "node")).alias("hub"))
    first = postings.join(hubs, "k").where("node != hub.node").select(*_pair(F.col("node"), F.col("hub.node")))
    nodes = postings.select("node").unionByName(near.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    sets = _shingle_sets(entries, nodes, texts, width)
    links = _verified(near.unionByName(first).distinct(), entries, sets)
    group = F.coalesce("root", "node").alias("group")
    rows = stage(postings.join(components(links), "node", "left").select("k", "node", "size", group), "groups")
    more = _across(stage(_mixed(rows), "meetings"), entries, sets)
    return components(links.unionByName(more))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """The document with the smallest id of each group of documents whose shingle sets are SIMILAR, with its own columns.

    Texts with equal shingle sets are one entry; shingles are told apart by 64-bit hashes, and so are sets.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("__p", _shingle_print(text, width)).withColumn("__row", F.monotonically_increasing_id())
    marked = stage(marked, "marked")
    first = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    prints = [F.first("__p.size").alias("size"), F.min("__p.fp").alias("fp"), F.first("__p.sketch").alias("sketch")]
    entries = marked.groupBy(F.col("__p.node").alias("node")).agg(F.min(first).alias("first"), *prints)
    entries = stage(entries.withColumn("row", F.col("first.row")), "entries")
    texts = marked.select(F.col("__row").alias("row"), F.col(text).alias("text"))
    links = link_similar(entries.drop("first"), texts, width)
    groups = entries.select("node", "first").join(links, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("first")["row"].alias("__row"))
    firsts = stage(groups.select("__row"), "firsts")
    others = stage(marked.select("__row").join(firsts.hint("merge"), "__row", "left_anti"), "others")
    marked = _marked_in(marked, others, "__row", "__maybe")
    rest = marked.where("__maybe").join(others.hint("merge"), "__row", "left_anti")
    return marked.where("not __maybe").select(*own).union(rest.select(*own))
