"""Revisits, mixing, the registry and the pipeline."""

from __future__ import annotations

import datetime

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import connect, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from marketlake.llm import bpe, mixing, queries, revisits, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = connect(SF).execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_registry():
    names = entry_points.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


# --- revisits ---------------------------------------------------------------------------------------------------

RECORD = "record_id long, kind string, url string, time timestamp, headers map<string,string>, payload string, status string"


def at(hour):
    return datetime.datetime(2024, 1, 1, hour)


@pytest.mark.parametrize("slices", [1, 3, None])
def test_revisits(spark, slices):
    u = "HTTP://www.Example.com:80/a/?utm_source=x#top"
    rows = [
        (1, "response", "http://example.com/a", at(1), {"ETag": "1", "Content-Length": "9", "A": "old"}, "p1"),
        (2, "response", u, at(3), {"ETag": "2", "Last-Modified": "m"}, "p2"),
        (3, "response", u, at(3), {"ETag": "3"}, "p3"),  # a tie: the larger id counts
        (4, "revisit", u, at(2), {"etag": "1", "content-length": "0", "a": "new"}, None),
        (5, "revisit", u, at(3), {"etag": "1"}, None),  # the responses of the same time are not earlier
        (6, "revisit", u, at(4), {"etag": "2"}, None),  # disagrees with the latest
        (7, "revisit", u, at(4), None, None),
        (7, "revisit", u, at(4), None, None),
        (8, "revisit", u, at(0), {"etag": "1"}, None),
        (9, "revisit", None, at(4), {"etag": "1"}, None),
        (10, "revisit", u, None, {"etag": "1"}, None),
        (11, "response", None, at(0), {"etag": "1"}, "px"),
    ]
    out = revisits.resolve(spark.createDataFrame([(*r, "x") for r in rows], RECORD), slices).collect()
    found = sorted((r.record_id, r.status, r.response_id, r.checked, r.payload) for r in out)
    assert found == [
        (4, "resolved", 1, "etag", "p1"), (5, "resolved", 1, "etag", "p1"), (6, "mismatch", 3, "mismatch", None), (7, "resolved", 3, "none", "p3"),
        (7, "resolved", 3, "none", "p3"), (8, "missing", None, None, None), (9, "missing", None, None, None), (10, "missing", None, None, None),
    ]
    merged = next(r.headers for r in out if r.record_id == 4)
    assert merged == {"etag": "1", "content-length": "9", "a": "new"}


def test_no_records(spark):
    assert revisits.resolve(spark.createDataFrame([], RECORD)).count() == 0


def test_names_in_several_cases(spark):
    """Of names that differ only in case the last one counts."""
    out = spark.range(1).select(revisits._clean(F.create_map(F.lit("ETag"), F.lit("a"), F.lit("Age"), F.lit("1"), F.lit("etag"), F.lit("b"))).alias("h")).first().h
    assert out == {"etag": "b", "age": "1"}


# --- mixing -----------------------------------------------------------------------------------------------------


def test_raking_reaches_the_targets(spark):
    rows = [(s, l, t, float(w)) for k, (s, l, t, w) in enumerate((s, l, t, 10 + 7 * i + 3 * j + 40 * m) for i, s in enumerate("abc") for j, l in enumerate(["x", None]) for m, t in enumerate("pq"))]
    cells = spark.createDataFrame(rows, "__source string, __lang string, __topic string, w double")
    shares = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.4, None: 0.6}, "topic": {"p": 0.5, "q": 0.5}}
    out = [(r["__source"], r["__lang"], r["__topic"], r.own * r.factor) for r in mixing.fit(cells, shares).collect()]
    total = sum(r[3] for r in out)
    for k, dim in enumerate(("source", "lang", "topic")):
        for level, share in shares[dim].items():
            assert abs(sum(r[3] for r in out if r[k] == level) / total - share) < 0.01


def test_targets_of_zero_and_out_of_reach(spark):
    cells = spark.createDataFrame([("a", "x", "p", 10.0), ("a", "y", "p", 5.0), ("b", "x", "p", 20.0)], "__source string, __lang string, __topic string, w double")
    out = {(r["__source"], r["__lang"]): r.factor for r in mixing.fit(cells, {"source": {"a": 1.0, "b": 0.0}}, flatten=1.0).collect()}
    assert out["b", "x"] == 0 and out["a", "x"] > 0
    apart = spark.createDataFrame([("a", "x", "p", 30.0), ("b", "y", "p", 70.0)], "__source string, __lang string, __topic string, w double")
    with pytest.warns(UserWarning, match="cannot all be met"):
        mixing.fit(apart, {"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.3, "y": 0.7}}, flatten=1.0).collect()


def test_mix(small):
    rows, docs = small
    out = mixing.mix(docs)
    assert out.count() == len(rows) and out.where("__probability <= 0 or __probability > 1.0000001").isEmpty()
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns and kept.count() == mixing.mix(docs).where("__sampled").count()


# --- pipeline ---------------------------------------------------------------------------------------------------


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        out = out.cache()
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
        assert {*after} <= {*before} and after
        if name == "line_dedup":
            assert {*after} == {*before}
            assert out.where("n_chars <> length(text)").isEmpty()
        else:
            assert all(before[i] == t for i, t in after.items())
        if name == "simhash_near_dedup":
            assert {*after} == {*brute.similar_groups(list(before.items()))}
        docs = out
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    own = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    want = {r.doc_id: library.encode_ordinary(r.text) for r in docs.collect()}
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in out.collect()} == want
    assert out.where(F.col("n_tokens") * 4 != F.octet_length("ids")).isEmpty()


def test_run(spark):
    assert 0 < corpus_pipeline.run(spark, SF).count() <= 200


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
