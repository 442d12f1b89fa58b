from __future__ import annotations

import gzip
import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from marketlake.functions import exact, geo, scalars, text
from marketlake.session import scratch_path
from marketlake.sources import readers


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_money(spark):
    values = ["$1,234.50", "1234.5", "€80", "", None, "$0.00", "$-5"]
    assert column(spark, values, "string", scalars.parse_money) == [1234.5, 1234.5, None, None, None, 0.0, -5.0]


def test_int_text(spark):
    assert column(spark, ["3", "3.0", " 7 ", "x", "", None], "string", scalars.parse_int) == [3, 3, 7, None, None, None]
    big = "922337203685477580"
    assert column(spark, [big], "string", lambda c: scalars.parse_int(c, "bigint")) == [int(big)]


def test_booleans(spark):
    values = ["t", "f", "true", "False", "1", "0", "yes", "", None]
    assert column(spark, values, "string", scalars.bool_to_num) == [1, 0, 1, 0, 1, 0, 1, 0, 0]


def test_dates(spark):
    got = column(spark, ["2025-01-31", "", "2025-13-01", None], "string", scalars.parse_date)
    assert [str(d) if d else None for d in got] == ["2025-01-31", None, None, None]


def test_isodow_weekend_season(spark):
    days = ["2024-01-01", "2024-01-06", "2024-01-07"]
    assert column(spark, days, "string", lambda c: scalars.isodow(c.cast("date"))) == [1, 6, 7]
    assert column(spark, [1, 6, 7], "int", scalars.is_weekend) == [False, True, True]
    assert column(spark, list(range(1, 13)), "int", scalars.season) == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    )


def test_tenure(spark):
    df = spark.sql("select cast('2026-06-22' as date) d union all select null").select(scalars.tenure_days("d").alias("t"))
    assert sorted(r.t for r in df.collect()) == [-1, 1]


def test_name_flags(spark):
    values = ["Luxury LOFT, city center", "newly renovated", "", None, "  a  b "]
    words = ["luxury", "loft", "city center", "new"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, name string").orderBy("i")
    loose = [tuple(r) for r in df.select(*text.keyword_flags("name", words)).collect()]
    strict = [tuple(r) for r in df.select(*text.word_flags("name", words)).collect()]
    assert loose == [(1, 1, 1, 0), (0, 0, 0, 1), (0,) * 4, (0,) * 4, (0,) * 4]
    assert strict == [(1, 1, 1, 0), (0,) * 4, (0,) * 4, (0,) * 4, (0,) * 4]
    assert column(spark, values, "string", text.word_count) == [4, 2, 0, 0, 2]
    assert column(spark, values, "string", text.char_len) == [24, 15, 0, 0, 7]
    grouped = df.select(*text.synonym_flags("name", {"kw_lux": ["luxury", "luxurious"]}))
    assert [r[0] for r in grouped.collect()] == [1, 0, 0, 0, 0]


def test_champion_keywords():
    assert len(text.NAME_KEYWORDS) == 23 and len(text.NAME_SYNONYMS) == 8


def test_pair_key(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(text.pair_key("a", "b")).collect()] == ["a||nan", "nan||nan"]


def test_ratios(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 2.0), (4.0, -2.0), (4.0, None)], "a double, b double")
    rows = df.select(scalars.safe_ratio("a", "b"), scalars.safe_ratio("a", "b", 0), scalars.positive_ratio("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(2, 2, 2), (None, 0, 0), (None, None, 0), (-2, -2, 0), (None, None, 0)]
    values = [float("inf"), float("-inf"), 1.0, None]
    assert column(spark, values, "double", scalars.inf_to_null) == [None, None, 1.0, None]
    assert column(spark, [-3.0, 0.5, 7.0, None], "double", lambda c: scalars.clip(c, 0.0, 1.0)) == [0.0, 0.5, 1.0, None]
    assert column(spark, [-3.0, math.e - 1, None], "double", scalars.log1p_clipped) == pytest.approx([0.0, 1.0, None])


def test_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    km = [r[0] for r in df.select(geo.haversine("a", "b", "c", "d")).collect()]
    assert km == pytest.approx([math.pi * 6371, 0.0, math.pi * 6371 / 180])
    assert [r[0] for r in df.select(geo.euclid_deg("a", "b", "c", "d")).collect()] == [180.0, 0.0, 1.0]


def test_local_distance_keeps_null_group(spark):
    df = spark.createDataFrame([("A", 0.0, 0.0), ("A", 0.0, 2.0), (None, 5.0, 5.0), ("A", None, None)], "city string, latitude double, longitude double")
    rows = {(r.city, r.longitude): r.dist_local for r in geo.local_distance(df, "city").collect()}
    one = math.pi * 6371 / 180
    assert rows[("A", 0.0)] == pytest.approx(one) and rows[("A", None)] == 0.0 and rows[(None, 5.0)] == 0.0


def test_half_up_and_exact_mean(spark):
    df = spark.createDataFrame([(1, 0.01), (1, 0.02), (2, 1.0), (2, None), (3, None)], "g int, x double")
    got = dict(df.groupBy("g").agg(exact.mean_money("x").alias("m")).collect())
    assert got == {1: 0.02, 2: 1.0, 3: None}  # 0.015 rounds up
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(exact.sum_money("x"), exact.mean_money("x")).first() == (4.0, 0.0)  # digits below the cent add up
    signed = spark.createDataFrame([(-3, 2), (3, 2), (1, 0)], "a bigint, b bigint")
    assert [r[0] for r in signed.select(exact.half_up(F.col("a"), F.col("b"))).collect()] == [-2, 2, None]
    large = spark.range(3).select((F.lit(10**12) + F.col("id")).alias("a"), F.lit(3).cast("bigint").alias("b"))
    assert [r[0] for r in large.select(exact.half_up(F.col("a"), F.col("b"))).collect()] == [333333333333, 333333333334, 333333333334]
    prices = spark.createDataFrame([(0.1,), (0.2,), (0.4,)], "x double")
    assert prices.select(exact.stddev_money("x")).first()[0] == pytest.approx(0.152752, abs=1e-6)


def test_wide_synonyms(spark):
    df = spark.createDataFrame([("Newly REFURBISHED, large",), (None,)], "n string")
    hit, none = df.select(*text.synonym_flags("n", text.NAME_SYNONYMS_WIDE)).collect()
    assert {k for k, v in hit.asDict().items() if v} == {"kw_spacious", "kw_new", "kw_renovated"}
    assert len(hit) == 22 and not any(none)


def test_one_hot_levels_are_bounded(spark):
    with pytest.raises(ValueError, match="levels"):
        scalars.one_hot(spark.range(1001), "id")


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "k string, v int")
    out = scalars.one_hot(df, "k")
    assert out.columns == ["v", "k_b", "k_c"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]
    with pytest.raises(ValueError):
        scalars.one_hot(df, "k", max_levels=2)


def test_headings(spark):
    html = (
        "<html><head><title> Tom &amp; Co </title><script>var a = '<h1>no</h1>';</script></head><body><!-- <h2>no</h2> -->"
        "<H1 class='x'>One <b>bold</b> &eacute;t&eacute;</H1><h4>no</h4><h3>  </h3><h2>Two</h2></body></html>"
    )
    df = spark.createDataFrame([(7, html)], "page_id int, html string")
    rows = [tuple(r) for r in text.html_headings(df, "page_id", "html").orderBy("position").collect()]
    assert rows == [(7, 0, "title", "Tom & Co"), (7, 1, "h1", "One"), (7, 2, "h1", "bold"), (7, 3, "h1", "été"), (7, 4, "h2", "Two")]


def test_currency(spark):
    prices = spark.createDataFrame([("EUR", 2.0), ("USD", 3.0), ("XXX", 1.0)], "currency string, price double")
    rates = spark.createDataFrame([("EUR", 1.5), ("USD", 1.0)], "currency string, rate double")
    got = {r.currency: r.price_converted for r in scalars.to_currency(prices, rates).collect()}
    assert got == {"EUR": 3.0, "USD": 3.0, "XXX": None}


def test_log_lines(spark, tmp_path):
    report = '{"profiles": [\n\n  {"level": "x"}]}\n'
    log = '{"level": "INFO", "logger": "a", "message": "b"}\n'
    (tmp_path / "r.json").write_bytes((log + report + log).encode("utf-16"))
    lines = readers.read_log_lines(spark, str(tmp_path / "r.json"))
    kept = [r.line for r in readers.strip_log_lines(lines).orderBy("line_no").collect()]
    assert kept == ['{"profiles": [', '  {"level": "x"}]}']


def _many_documents(folder, odd=()):
    """100 documents in two folders of a partition, then the odd ones."""
    for i in range(100):
        at = folder / f"year={2000 + i % 2}"
        at.mkdir(parents=True, exist_ok=True)
        value = [f'"{i}"', str(i), "null", str(i / 4), str(2**40 + i)][i % 5 if i > 50 else 1]
        (at / f"d{i:03}.json").write_text('{\n "id": %d, "v": %s, "Year": "y%d",\n "n": {"a": [%d, null]}\n}' % (i, value, i, i))
    for name, content in odd:
        (folder / "year=2001" / name).write_bytes(content)
    return str(folder)


_ODD_DOCUMENTS = [
    ("wide.json", '{"id": 900, "w": "ü"}'.encode("utf-16")), ("marked.json", '{"id": 901, "b": true}'.encode("utf-8-sig")),
    ("list.json", b'[{"id": 902},\n {"id": 903, "n": {"c": "x"}}]'), ("empty.json", b""), ("none.json", b"{}"),
    ("packed.json.gz", gzip.compress(b'{"id": 904, "z": 1.5}')), ("_hidden.json", b'{"hidden": 1}'),
]


@pytest.mark.parametrize("odd", [[], _ODD_DOCUMENTS, [*_ODD_DOCUMENTS, ("broken.json", b'{"id": 905, "v": ')]], ids=["plain", "odd", "broken"])
@pytest.mark.parametrize("nested", [True, False])
def test_many_json_documents_are_read_as_spark_reads_them(spark, tmp_path, odd, nested):
    path = _many_documents(tmp_path / "docs", odd) + ("" if nested else "/year=2001")
    for paths in (path, [path, _many_documents(tmp_path / "more") + "/year=2000"] if not nested else [path]):
        want, got = spark.read.option("multiLine", True).json(paths), readers.read_json(spark, paths)
        assert got.schema == want.schema
        for df in (got, got.select("*", "_metadata.file_name")):
            same = want if df is got else want.select("*", "_metadata.file_name")
            assert sorted(map(str, df.collect())) == sorted(map(str, same.collect()))


def test_many_json_documents_do_not_reach_sparks_inference(spark, tmp_path, monkeypatch):
    """It writes the names of all files once for each file."""
    path, reader = _many_documents(tmp_path / "docs"), type(spark.read)
    given, own = reader.schema, reader.json

    def schema(self, found):
        self.has_schema = True
        return given(self, found)

    def json(self, at):
        assert hasattr(self, "has_schema")
        return own(self, at)

    monkeypatch.setattr(reader, "schema", schema)
    monkeypatch.setattr(reader, "json", json)
    assert readers.read_json(spark, path).count() == 100


def test_small_files_share_tasks(spark, tmp_path):
    path = tmp_path / "docs"
    path.mkdir()
    for i in range(100):
        (path / f"d{i}.json").write_text("{}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = readers.read_json(spark, str(path), "id long")
        assert len(df.select(F.spark_partition_id().alias("p")).distinct().collect()) == 4 * spark.sparkContext.defaultParallelism < 100
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_folder_without_documents_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_json(spark, str(tmp_path))


def test_geojson(spark, tmp_path):
    doc = """{"type": "FeatureCollection", "features": [
      {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[1.0, 2.0], [3, 4], [1.0, 2.0]]]},
       "properties": {"neighbourhood": "N1", "neighbourhood_group": null}},
      {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[5, 6], [7, 8], [5, 6]]], [[[9, 9]]]]},
       "properties": {"neighbourhood": "N2", "neighbourhood_group": "G"}}]}"""
    (tmp_path / "n.geojson").write_text(doc)
    df = readers.geojson_features(readers.read_json(spark, str(tmp_path), readers.GEOJSON_SCHEMA))
    rows = {r.neighbourhood: r for r in df.collect()}
    assert rows["N1"].neighbourhood_group is None and rows["N1"].coordinates == [[[[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]]]]
    assert rows["N2"].geometry_type == "MultiPolygon" and len(rows["N2"].coordinates) == 2


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
