"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A paragraph (a line, or a sentence of a long line) has a 64-bit digest. A sketch has three parts of ``size`` cells; a
digest falls into one cell of each part and adds there to a count, an exclusive-or of digests and one of check hashes.
Two versions are compared by subtracting their sketches: what they share cancels, and peeling reads the rest - a cell
with count 1 or -1 whose check agrees gives a digest, which is taken out of its other cells, and so on. If cells remain,
both are sketched anew at twice the size.

Digests are first dealt into groups of about GROUP by their value, so a sketch stays small however long the texts
are and the work grows in proportion to them. After the last size a group is compared digest by digest (never seen but
with broken hashes). Likeness is the share of common digests among all digests of both.

Defined results: a null text is empty; texts without paragraphs have likeness 1 with each other and 0 with all others;
a paragraph that a text repeats counts once; rows with the same id are ordered by their text; a table of one document
has that document as its own next; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlake.llm.common import NO_WORD, tasks, text_of
from marketlake.session import stage

GROUP = 16
SIZES = (6, 12, 24, 48, 96)
PEELS = 8
#: Cells of a part in the printed sketch.
PRINTED = 4


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    parts = F.filter(F.split(text, r"\n+|(?<=[.!?]) +"), lambda p: ~p.rlike(NO_WORD))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _entry(x: Column, sign: Column, size: int) -> Column:
    """A digest with its sign, its check and its cell in each part."""
    cells = [(F.pmod(F.xxhash64(x, F.lit(part)), F.lit(size)) + part * size).cast("int").alias(f"i{part}") for part in range(3)]
    return F.struct(x.alias("k"), sign.cast("int").alias("n"), F.xxhash64(x, F.lit(99)).alias("c"), *cells)


def _falls(e: Column, cell: Column) -> Column:
    return (e["i0"] == cell) | (e["i1"] == cell) | (e["i2"] == cell)


def _add(acc: Column, e: Column, sign: int) -> Column:
    return F.struct((acc["n"] + sign * e["n"]).alias("n"), acc["k"].bitwiseXOR(e["k"]).alias("k"), acc["c"].bitwiseXOR(e["c"]).alias("c"))


def sketch(entries: Column, size: int) -> Column:
    """The cells of signed entries; of two versions with opposite signs it is the difference of their sketches."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))
    return F.transform(
        F.sequence(F.lit(0), F.lit(3 * size - 1)), lambda cell: F.aggregate(F.filter(entries, lambda e: _falls(e, cell)), empty, lambda a, e: _add(a, e, 1))
    )


def _peel(cells: Column, size: int) -> Column:
    """(cells that remain, how many digests only the first version has, how many only the second)."""

    def once(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (F.xxhash64(c["k"], F.lit(99)) == c["c"]))
        found = F.array_distinct(F.transform(pure, lambda c: _entry(c["k"], c["n"], size)))
        return _let(found, lambda out: F.when(F.size(out) == 0, state).otherwise(F.struct(
            F.transform(state["cells"], lambda c, i: F.aggregate(F.filter(out, lambda e: _falls(e, i)), c, lambda a, e: _add(a, e, -1))).alias("cells"),
            (state["plus"] + F.size(F.filter(out, lambda e: e["n"] == 1))).alias("plus"),
            (state["minus"] + F.size(F.filter(out, lambda e: e["n"] == -1))).alias("minus"),
        )))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(PEELS)), start, once)


def _difference(group: Column) -> Column:
    """(plus, minus) of a group of signed digests: by the smallest sketch that peels empty."""

    def attempt(size: int) -> Column:
        cells = _let(F.transform(group, lambda e: _entry(e["x"], e["s"], size)), lambda es: sketch(es, size))
        empty = lambda s: ~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["c"] != 0))
        return _let(_peel(cells, size), lambda s: F.when(empty(s), F.struct(s["plus"].alias("plus"), s["minus"].alias("minus"))))

    of = lambda sign: F.transform(F.filter(group, lambda e: e["s"] == sign), lambda e: e["x"])
    exact = F.struct(F.size(F.array_except(of(1), of(-1))).alias("plus"), F.size(F.array_except(of(-1), of(1))).alias("minus"))
    return F.coalesce(*[attempt(size) for size in SIZES], exact)


def with_likeness(df: DataFrame, a: str, b: str, to: str) -> DataFrame:
    """``df`` with the likeness of the digest arrays ``a`` and ``b``."""
    signed = lambda xs, sign: F.transform(xs, lambda x: F.struct(F.pmod(x, F.col("__groups")).alias("g"), x.alias("x"), F.lit(sign).alias("s")))
    df = df.withColumn("__groups", F.floor((F.size(a) + F.size(b)) / GROUP) + 1)
    df = df.withColumn("__all", F.array_sort(F.concat(signed(F.col(a), 1), signed(F.col(b), -1))))
    first = lambda e, i: (i == 0) | (F.get(F.col("__all"), i - 1)["g"] != e["g"])
    df = df.withColumn("__starts", F.array_compact(F.transform("__all", lambda e, i: F.when(first(e, i), i))))
    until = lambda k: F.coalesce(F.get(F.col("__starts"), k + 1), F.size("__all"))
    groups = F.transform("__starts", lambda s, k: F.slice(F.col("__all"), s + 1, until(k) - s))
    df = df.withColumn("__diffs", F.transform(groups, _difference))
    total = lambda name: F.aggregate("__diffs", F.lit(0), lambda t, d: t + d[name])
    df = df.withColumn("__plus", total("plus")).withColumn("__minus", total("minus"))
    both = F.size(a) + F.col("__minus")
    return df.withColumn(to, F.when(both == 0, 1.0).otherwise((F.size(a) - F.col("__plus")) / both)).drop("__groups", "__all", "__starts", "__diffs", "__plus", "__minus")


def fingerprint(digest: str) -> Column:
    """The sketch of a digest array at a fixed size, printed: count and digests of each cell in hexadecimal."""
    entries = F.transform(digest, lambda x: _entry(x, F.lit(1), PRINTED))
    cells = _let(entries, lambda es: sketch(es, PRINTED))
    return F.array_join(F.transform(cells, lambda c: F.lower(F.concat(F.hex(c["n"]), F.lit("."), F.hex(c["k"])))), "-")


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc, text) with ``next``: the text of the document with the next smaller id, after the last the first.

    Ranges of ids are dealt out and sorted on their own; the head of each range is handed to the range above it.
    """
    n = 4 * tasks(docs.sparkSession)
    bounds = docs.agg(F.percentile_approx("doc", [i / n for i in range(1, n)], 1000)).first()[0] or []  # n - 1 ids
    cut = F.array(*[F.lit(b) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<bigint>")
    docs = docs.withColumn("range", F.size(F.filter(cut, lambda b: b < F.col("doc"))))
    # The head of a range is its row with the largest id (a null id is the smallest); at most n rows, in one window.
    heads = docs.groupBy("range").agg(F.max("doc").alias("head"))
    heads = docs.join(F.broadcast(heads.withColumnRenamed("range", "r")), (F.col("range") == F.col("r")) & F.col("doc").eqNullSafe(F.col("head")))
    heads = heads.groupBy("range").agg(F.max("text").alias("text"))
    down = W.orderBy(F.desc("range"))
    first = F.first("text").over(down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    heads = stage(heads.select("range", F.coalesce(F.lead("text").over(down), first).alias("below")), "heads")
    order = W.partitionBy("range").orderBy(F.desc_nulls_last("doc"), F.desc("text"))
    rows = docs.withColumn("next", F.lead("text").over(order))
    return rows.join(heads, "range").withColumn("next", F.coalesce("next", "below")).drop("range", "below")


def edited(text: Column, after: Column) -> Column:
    """The last third of the text replaced by as much of the start of the next one."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(after, F.lit(1), third))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    rows = with_next(docs.select(F.col(doc_id).cast("long").alias("doc"), text_of(text).alias("text")))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next")))
    rows = rows.select(
        F.col("doc").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("b"), digests(F.col("next")).alias("c"),
    )
    rows = rows.withColumn("fingerprint", fingerprint("a")).withColumn("edited_fingerprint", fingerprint("b"))
    rows = with_likeness(with_likeness(rows, "a", "b", "near_edited"), "a", "c", "near_next")
    return rows.drop("a", "b", "c")
