"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """The last node, and for each first node the pairs (left, right) up to it."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(own):
            run = nodes[i - i % fanout : i - i % fanout + fanout]
            paths[k].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
            own[k] = i // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return (nodes or [None])[0], paths


def brute(rows, fanout=16):
    """``rows`` (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for doc, source, lang, n, text in rows:
        leaf = h(*map(field, (doc, source, lang, n, text)))
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        low = text.translate(LOWER) if text is not None else None
        groups.setdefault(source, []).append((doc, leaf, h(*map(field, (doc, source, lang, n, low))) if tampered else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([leaf for _, leaf, _ in groups[s]], fanout) for s in order]
    root, above = tree([top for top, _ in trees], fanout)
    out = []
    for s, (top, paths), rest in zip(order, trees, above, strict=True):
        for (doc, leaf, own), path in zip(groups[s], paths, strict=True):
            for left, right in [*path, *rest]:
                own = h(left, own, right)
            out.append((doc, leaf, top, root, h(*[a + b for a, b in [*path, *rest]]), own))
    return sorted(out, key=repr)


def got(df, fanout=16):
    return sorted((tuple(r) for r in merkle.manifest(merkle.leaves(df), fanout).collect()), key=repr)


def ids(spark, rows):
    """Columns that have the names of inner ones are not in the way."""
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.withColumn("leaf", F.lit(1)).withColumn("key", F.lit("k")).withColumn("group", F.lit("g")).withColumn("place", F.lit(0))


def mixed(n=700):
    rng, rows = random.Random(2), []
    for k in range(n):
        doc = rng.choice([None, 5, -3, 2**40 + k, -(2**50) - k * 7, 2**62 - k, k, k * 32768, 40000 + k, 7, -1, 0])
        rows.append((doc, rng.choice([None, "", "a", "é", "b", "solo" if k == 3 else "z"]), "en", k % 3, rng.choice([None, "", "Text A", "x" * k])))
    return rows + [(9, "hot", "en", 1, "same")] * 90 + [(i, f"s{i}", "de", None, "One Row") for i in range(40)]


@pytest.mark.parametrize("fanout, most", [(16, merkle.CHUNK), (3, 4)])
def test_manifest(spark, monkeypatch, fanout, most):
    monkeypatch.setattr(merkle.places, "__defaults__", (most,))
    rows = mixed()
    assert got(ids(spark, rows), fanout) == brute(rows, fanout)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(None, "a", "en", 1, "T")] * 2, [(i, "a", "en", 1, "T") for i in range(17)]])
def test_small_tables(spark, rows):
    assert got(ids(spark, rows)) == brute(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.COLUMNS).collect()]
    out = got(docs)
    assert out == brute(rows)
    changed = {d for d, _, _, _, t in rows if zlib.crc32(str(d).encode()) % 5 == 0 and t is not None and t != t.translate(LOWER)}
    assert {r[0] for r in out if r[5] != r[3]} == changed


def test_places_are_ranks_without_sorting(spark):
    """Dense, scattered and repeated ids: the place is the number of rows before in the group."""
    rng = random.Random(4)
    rows = [(i, "dense") for i in range(3000)] + [(rng.randrange(-(2**62), 2**62), "wide") for _ in range(500)] + [(rng.randrange(50), "few") for _ in range(600)]
    df = spark.createDataFrame([(d, g, f"{d}", None) for d, g in rows], "doc_id long, group string, leaf string, changed string")
    out = merkle.places(df).collect()
    for g in ("dense", "wide", "few"):
        own = sorted((r.place, r.doc_id) for r in out if r.group == g)
        assert own == list(enumerate(sorted(d for d, x in rows if x == g))) and {r.size for r in out if r.group == g} == {len(own)}
