"""Merkle manifest of a table: one leaf per row, a tree per group, a tree over the groups.

Leaves of a group ascend by id. Where a leaf stands is not found by sorting rows: the ids of a group are kept as
bitmaps, one for each CHUNK of ids, and the place is a rank query: rows in the chunks before, plus set bits before the
id's own. A bitmap is compressed by leaving out its empty blocks of BLOCK bits; a popcount directory holds, for each
block, the bits before it and where it is. Ids that occur more than once are counted in bit-sliced planes: plane j
holds the ids whose number of further rows has bit j set, and weighs 2^j. The rows before a chunk are summed up the
prefixes of ids, so no window holds more than CHUNK prefixes (or the few left at the top).

Levels are reduced by keyed slot arrays: the nodes of a run of ``fanout`` places are put into the array of their run,
whose hash is a node of the next level. Paths (what stands left and right of a node, level by level) are handed down
from the root, so that each level joins its own number of runs and only the last step holds a row per leaf.

Defined results: each row is a leaf, repeated rows too; rows of a group with equal ids are ordered by their leaf hash,
null ids come first; a null group is a group of its own and the first one; a group with one leaf has it as its subroot,
one group has its subroot as the root; an empty table gives no rows and no root. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.keys import distributed_key
from marketlake.session import stage

CHUNK_BITS = 15
CHUNK = 1 << CHUNK_BITS
BLOCK = 512
FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def leaves(docs: DataFrame, columns=COLUMNS, doc_id: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """(doc_id, group, leaf, changed): ``changed`` is the leaf after tampering, null where nothing is tampered with.

    ``group`` is an ordered key: "0" for null, else "1" and the value.
    """
    own = [F.col(f"`{c}`") for c in columns]
    tampered = [F.translate(F.col(f"`{c}`"), _UPPER, _UPPER.lower()) if c == text else F.col(f"`{c}`") for c in columns]
    tamper = F.crc32(F.col(f"`{doc_id}`").cast("string")) % 5 == 0
    key = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), key.alias("group"), leaf_hash(*own).alias("leaf"),
        F.when(tamper, leaf_hash(*tampered)).alias("changed"),
    )


def _packed(bits: Column) -> Column:
    """(blocks that are not empty, in one; for each block the bits before it and the place of the block)."""
    size = BLOCK // 8
    blocks = F.transform(F.sequence(F.lit(0), F.lit(CHUNK // BLOCK - 1)), lambda i: F.substring(bits, i * size + 1, F.lit(size)))
    full = F.filter(blocks, lambda b: F.bitmap_count(b) > 0)
    data = F.aggregate(full, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    none = F.array().cast("array<struct<ones:int,block:int>>")
    start = F.struct(F.lit(0).alias("ones"), F.lit(0).alias("block"), none.alias("directory"))

    def add(a: Column, b: Column) -> Column:
        ones = F.bitmap_count(b).cast("int")
        entry = F.struct(a["ones"].alias("ones"), a["block"].alias("block"))
        return F.struct((a["ones"] + ones).alias("ones"), (a["block"] + (ones > 0).cast("int")).alias("block"), F.concat(a["directory"], F.array(entry)).alias("directory"))

    return F.struct(data.alias("data"), F.aggregate(blocks, start, add)["directory"].alias("directory"))


def _rank(plane: Column, at: Column) -> Column:
    """Set bits of a plane before position ``at``."""
    size = BLOCK // 8
    entry = F.get(plane["bits"]["directory"], (at / BLOCK).cast("int"))
    block = F.substring(plane["bits"]["data"], entry["block"] * size + 1, F.lit(size))
    byte = ((at % BLOCK) / 8).cast("int")
    own = F.coalesce(F.conv(F.hex(F.substring(block, byte + 1, F.lit(1))), 16, 10).cast("int"), F.lit(0))  # an empty block has no bytes
    own = F.bit_count(own.bitwiseAND((F.pow(F.lit(2), at % 8) - 1).cast("int")))
    # Of an empty block the next one's bytes would be read: its own count is 0.
    empty = entry["ones"] == F.coalesce(F.get(plane["bits"]["directory"], (at / BLOCK).cast("int") + 1)["ones"], plane["n"])
    return entry["ones"] + F.when(empty, 0).otherwise(F.bitmap_count(F.substring(block, F.lit(1), byte)) + own)


def bitmaps(ids: DataFrame) -> DataFrame:
    """``ids`` (group, doc_id, rows) to (group, chunk, rows, planes): one bitmap for each weight, compressed."""
    more = F.filter(F.transform(F.sequence(F.lit(0), F.lit(40)), lambda j: F.pow(F.lit(2), j).cast("long")), lambda w: (F.col("rows") - 1).bitwiseAND(w) != 0)
    weights = F.concat(F.array(F.lit(0).cast("long")), F.when(F.col("rows") > 1, more).otherwise(F.array().cast("array<long>")))
    rows = ids.select("group", F.shiftright("doc_id", CHUNK_BITS).alias("chunk"), F.col("doc_id").bitwiseAND(F.lit(CHUNK - 1)).alias("at"), "rows", weights.alias("weights"))
    # All ids of a chunk meet in one task, 32,768 at most, before a bitmap is made: ids travel, not bitmaps of one bit each.
    rows = rows.repartition("group", "chunk").select("group", "chunk", "at", "rows", F.explode("weights").alias("weight"))
    planes = rows.groupBy("group", "chunk", "weight").agg(F.bitmap_construct_agg("at").alias("b"), F.count(F.lit(1)).cast("int").alias("n"), F.sum("rows").alias("rows"))
    plane = F.struct(F.when(F.col("weight") == 0, 1).otherwise(F.col("weight")).alias("weight"), "n", _packed(F.col("b")).alias("bits"))
    return planes.groupBy("group", "chunk").agg(F.max(F.when(F.col("weight") == 0, F.col("rows"))).alias("rows"), F.collect_list(plane).alias("planes"))


def _before(chunks: DataFrame, most: int = CHUNK) -> DataFrame:
    """(group, chunk, rows) to (group, chunk, base): the rows of the group in earlier chunks."""
    levels = [chunks.select("group", F.col("chunk").alias("prefix"), "rows")]
    while (levels[-1].groupBy("group").count().agg(F.max("count")).first()[0] or 0) > most:
        up = levels[-1].groupBy("group", F.shiftright("prefix", CHUNK_BITS).alias("prefix")).agg(F.sum("rows").alias("rows"))
        levels.append(stage(up, "prefixes"))
    earlier = lambda *keys: F.coalesce(F.sum("rows").over(Window.partitionBy("group", *keys).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = levels[-1].select("group", "prefix", earlier().alias("base"))
    for level in reversed(levels[:-1]):
        up = F.shiftright("prefix", CHUNK_BITS)
        own = level.select("group", "prefix", up.alias("up"), earlier(up).alias("own"))
        base = own.join(base.withColumnRenamed("prefix", "up"), ["group", "up"]).select("group", "prefix", (F.col("own") + F.col("base")).alias("base"))
    return base.withColumnRenamed("prefix", "chunk")


def places(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """``rows`` (doc_id, group, leaf, ...) with ``place``, from 0 in each group, and ``size``, the rows of the group."""
    counts = stage(rows.groupBy("group", "doc_id").agg(F.count(F.lit(1)).alias("rows")), "ids")
    nulls = counts.where("doc_id is null").select("group", F.col("rows").alias("nulls"))
    sizes = counts.groupBy("group").agg(F.sum("rows").alias("size")).join(nulls, "group", "left")
    maps = stage(bitmaps(counts.where("doc_id is not null")), "bitmaps")
    maps = maps.join(_before(maps.select("group", "chunk", "rows"), most), ["group", "chunk"]).select("group", "chunk", "base", "planes")
    own = F.coalesce("doc_id", F.lit(0).cast("long"))
    at = own.bitwiseAND(F.lit(CHUNK - 1))
    earlier = F.aggregate("planes", F.lit(0).cast("long"), lambda n, p: n + p["weight"] * _rank(p, at).cast("long"))
    many = counts.where("rows > 1 or doc_id is null")
    if many.isEmpty():
        rows = rows.withColumn("copy", F.lit(1).cast("long"))
    else:
        # Only rows that share their id are put in order, by their leaf; equal ones are spread over ranges.
        shared = rows.join(many.select(F.col("group").alias("g"), F.col("doc_id").alias("d")), (F.col("group") == F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
        shared = stage(shared.withColumn("many", F.col("g").isNotNull()).drop("g", "d"), "shared")
        copies = distributed_key(shared.where("many"), ["leaf"], "copy", by=["group", "doc_id"]).select("copy", *rows.columns)
        rows = shared.where("not many").withColumn("copy", F.lit(1).cast("long")).select("copy", *rows.columns).unionByName(copies)
    rows = rows.withColumn("chunk", F.shiftright("doc_id", CHUNK_BITS)).join(maps, ["group", "chunk"], "left").join(sizes, "group")
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("nulls", F.lit(0)) + F.col("base") + earlier) + F.col("copy") - 1
    return rows.withColumn("place", place.cast("long")).drop("chunk", "base", "planes", "nulls", "copy")


def _runs(nodes: DataFrame, fanout: int, *more: str) -> DataFrame:
    """Nodes (key, place, size, hash) to (key, run, size, slots): slots hold the nodes of a run by place."""
    slot = F.struct("place", "hash", *more)
    return nodes.groupBy("key", F.floor(F.col("place") / fanout).alias("run")).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(slot)).alias("slots"))


def _over(runs: DataFrame, fanout: int) -> DataFrame:
    """The nodes that the runs of trees with several nodes make."""
    joined = F.sha2(F.array_join("slots.hash", ""), 256)
    return runs.where("size > 1").select("key", F.col("run").alias("place"), F.ceil(F.col("size") / fanout).alias("size"), joined.alias("hash"))


def build(nodes: DataFrame, most: int, fanout: int, *more: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level from the bottom up, and (key, size, hash, height): the last node of each tree.

    ``most`` is the size of the largest tree. ``more`` names columns that stay in the slots of the first level.
    """
    levels, tops, height = [], None, 0
    while True:
        runs = stage(_runs(nodes, fanout, *(more if not height else ())), "runs")
        lone = runs.where("size = 1").select("key", F.element_at("slots", 1)["hash"].alias("hash"), F.lit(height).alias("height"))
        tops = lone if tops is None else tops.unionByName(lone)
        levels.append(runs)
        if most <= 1:
            return levels, stage(tops, "tops")
        nodes, most, height = _over(runs, fanout), -(-most // fanout), height + 1


def _step(slots: Column, i: Column) -> Column:
    """What stands left and right of slot ``i`` (from 0) in its run."""
    hashes = slots["hash"]
    return F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"), F.array_join(F.slice(hashes, i + 2, F.lit(1 << 30)), "").alias("right"))


def above(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(key, run, path, ...) for the runs of the first level: the path of the node that the run makes.

    ``tops`` (key, height, path, ...) has the path of the last node of each tree; its further columns are handed down. A
    tree with one node has a run of one slot, whose own path is that of ``tops``.
    """
    more = [c for c in tops.columns if c not in ("key", "height", "path")]
    known = None
    for height in range(len(levels) - 1, 0, -1):
        top = tops.where(F.col("height") == height).select("key", F.lit(0).cast("long").alias("place"), "path", *more)
        known = top if known is None else known.unionByName(top)
        if height == 1:
            break
        # Nodes of the level below get their paths from the runs of that level, of which these are the hashes.
        runs = levels[height - 1].where("size > 1").join(known.withColumnRenamed("place", "run"), ["key", "run"])
        spread = runs.select("key", F.posexplode("slots").alias("i", "slot"), "slots", "path", *more)
        known = stage(spread.select("key", F.col("slot.place").alias("place"), F.concat(F.array(_step(F.col("slots"), F.col("i"))), "path").alias("path"), *more), "paths")
    lone = tops.where("height = 0").select("key", F.lit(0).cast("long").alias("run"), "path", *more)
    return lone if known is None else lone.unionByName(known.withColumnRenamed("place", "run"))


def manifest(rows: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``rows`` as from ``leaves`` to doc_id, leaf, subroot, root, proof_sha256, folded_root.

    ``folded_root`` is what the path makes of ``changed`` where it is given, else of the leaf.
    """
    nodes = stage(places(stage(rows, "leaves")).select(F.col("group").alias("key"), "place", "size", F.col("leaf").alias("hash"), "doc_id", "changed"), "places")
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels, tops = build(nodes, most, fanout, "doc_id", "changed")
    # The groups in order are the leaves of the tree above.
    ranked = stage(distributed_key(tops, ["key"], "rank"), "groups")
    n = ranked.count()
    groups = ranked.select(F.lit("all").alias("key"), (F.col("rank") - 1).alias("place"), F.lit(n).cast("long").alias("size"), "hash", F.col("key").alias("group"), F.col("height").alias("of"))
    top_levels, top = build(groups, n, fanout, "group", "of")
    roots = top.first()
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = top.select("key", "height", no_path.alias("path"))
    paths = _spread(top_levels[0], above(top_levels, top), "slot.group", "slot.of", "slot.hash")
    tops = stage(paths.select(F.col("group").alias("key"), F.col("of").alias("height"), "path", F.col("hash").alias("subroot")), "roots")
    out = _spread(levels[0], above(levels, tops), "slot.doc_id", "slot.hash", "slot.changed", "subroot")
    proof = F.aggregate("path", F.lit(""), lambda a, p: F.concat(a, p["left"], p["right"]))
    folded = F.aggregate("path", F.coalesce("changed", "hash"), lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
    root = F.lit(roots["hash"] if roots else None).cast("string")
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", root.alias("root"), F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"))


def _spread(runs: DataFrame, paths: DataFrame, *columns: str) -> DataFrame:
    """The slots of the first level's runs with their paths."""
    rows = runs.join(paths, ["key", "run"])
    more = [c for c in columns if not c.startswith("slot.")]
    rows = rows.select("size", "slots", "path", *more, F.posexplode("slots").alias("i", "slot"))
    own = F.when(F.col("size") > 1, F.concat(F.array(_step(F.col("slots"), F.col("i"))), "path")).otherwise(F.col("path"))
    return rows.select(own.alias("path"), *columns)
