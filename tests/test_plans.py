from __future__ import annotations

import datetime
import os
import statistics

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quality as Q
from marketlake.plans import features, gold, marts, silver
from marketlake.plans.dataset import DATASET_KEYS, listing_dataset
from marketlake.session import scratch_path, stage, staged_tables, work_dir
from marketlake.sources import landing, readers, writers
from marketlake.streaming.incremental import read_silver, stream_silver


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def raw_listing(spark, data):
    base = {"name": "n", "host_id": "7", "host_name": "h", "host_since": "2020-01-01", "host_listings_count": "1", "host_is_superhost": "t",
            "neighbourhood_cleansed": "N", "neighbourhood_group_cleansed": None, "latitude": "1.5", "longitude": "2", "room_type": "r",
            "property_type": "p", "accommodates": "2", "bedrooms": "1.5", "beds": "", "price": "$1,000.00", "minimum_nights": "2",
            "number_of_reviews": "0", "review_scores_rating": None, "instant_bookable": "f", "city": "A"}
    full = [{**base, **d} for d in data]
    columns = ["id", *base]
    return spark.createDataFrame([tuple(d.get(c) for c in columns) for d in full], ", ".join(f"{c} string" for c in columns))


def test_clean_listings(spark):
    raw = raw_listing(spark, [
        {"id": "1"}, {"id": "2", "price": "$0.00"}, {"id": "3", "price": None}, {"id": "4", "latitude": ""}, {"id": "5", "price": "n/a"},
        {"id": "6", "host_since": "2025-13-01", "accommodates": "2.0"},
    ])
    clean = {r.listing_id: r for r in silver.clean_listings(raw, "2025-01-02").collect()}
    assert sorted(clean) == [1, 6]
    assert clean[1].price == 1000.0 and clean[1].beds is None and clean[1].bedrooms == 1.5 and clean[1].is_superhost is True
    assert clean[6].host_since is None and clean[6].accommodates == 2
    assert clean[1].captured_date == datetime.date(2025, 1, 2)
    kinds = {f.name: f.dataType.simpleString() for f in silver.clean_listings(raw).schema.fields}
    assert kinds["listing_id"] == "bigint" and kinds["price"] == "float" and kinds["latitude"] == "float" and kinds["captured_date"] == "date"
    assert silver.rejects(raw, silver.LISTINGS).first().price == 1
    with pytest.raises(Exception):
        silver.clean_listings(raw, mode="fail").collect()


def test_clean_calendar_defaults(spark):
    raw = spark.createDataFrame(
        [("1", "2025-01-01", "t", "$10.00", None, ""), ("2", None, "f", "", "3", "9"), (None, "2025-01-01", "f", "", "3", "9")],
        "listing_id string, date string, available string, price string, minimum_nights string, maximum_nights string",
    )
    assert rows(silver.clean_calendar(raw)) == [(1, datetime.date(2025, 1, 1), True, 10.0, 1, 365)]


def test_raw_files_round_trip(spark, tmp_path):
    import gzip

    for month, text in ((1, "old"), (2, 'multi\nline, "quoted"')):
        folder = tmp_path / "city=london" / "year=2025" / f"month={month}"
        folder.mkdir(parents=True)
        with gzip.open(folder / "reviews.csv.gz", "wt") as f:
            quoted = text.replace('"', '""')
            f.write(f'listing_id,id,date,reviewer_id,reviewer_name,comments\n1,{month},2025-01-01,5,Ann,"{quoted}"\n')
        (folder / "reviews.csv").write_text("listing_id,date\n9,2025-01-01\n")
    for schema in (None, readers.text_schema("listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments")):
        raw = readers.read_bronze(spark, str(tmp_path), "reviews.csv.gz", ["LONDON"], schema=schema)
        got = silver.clean_reviews(raw).collect()
        assert [(r.review_id, r.comments, r.city) for r in got] == [(2, 'multi\nline, "quoted"', "london")]
    assert readers.read_bronze(spark, str(tmp_path), "reviews.csv.gz", latest=False).count() == 2
    assert readers.read_bronze(spark, str(tmp_path), "reviews.csv.gz", ["paris"]).count() == 0


def test_cities_with_different_headers(spark, tmp_path):
    for city, text in (("a", "id,name,price,extra\n1,x,$10,e\n"), ("b", "id,price,extra,name\n2,$30,f,y\n"), ("c", "name,id\nz,3\n")):
        folder = tmp_path / f"city={city}" / "year=2025" / "month=1"
        folder.mkdir(parents=True)
        (folder / "listings.csv").write_text(text)
    want = [("1", "x", "$10", "a"), ("2", "y", "$30", "b"), ("3", "z", None, "c")]
    for schema in (None, readers.text_schema("id", "name", "price")):
        got = readers.read_bronze(spark, str(tmp_path), "listings.csv", schema=schema, multi_line=False)
        assert rows(got.select("id", "name", "price", "city")) == want


def test_json_layouts_are_not_mixed_up(spark, tmp_path):
    entry = '{"source_url": "u", "captured_at": "d", "bytes": 1, "sha256": "%s", "rows_est": 0, "status": "NEW"}'
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "m.json").write_text("\n".join('{"entries": [%s], "generated_at": "t"}' % (entry % i) for i in range(3)))
    assert readers.read_manifest(spark, str(lines)).count() == 3
    with pytest.raises(ValueError):
        readers.read_manifest(spark, str(lines), multi_line=True)
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "m.json").write_text('{\n "entries": [\n %s,\n %s\n ],\n "generated_at": "t"\n}' % (entry % 1, entry % 2))
    assert readers.read_manifest(spark, str(whole), multi_line=True).count() == 2
    with pytest.raises(Exception):
        readers.read_manifest(spark, str(whole)).collect()


def test_hidden_manifests_are_read(spark, tmp_path):
    entry = '{"source_url": "%s", "captured_at": "d", "bytes": 1, "sha256": "s", "rows_est": 0, "status": "NEW"}'
    for city, month, names in (("Paris", 9, "ab"), ("Rome", 8, "c")):
        folder = tmp_path / f"city={city}" / "year=2025" / f"month={month}"
        folder.mkdir(parents=True)
        (folder / "_manifest.json").write_text('{\n "entries": [\n%s\n ],\n "generated_at": "t"\n}' % ",\n".join(entry % n for n in names))
    got = readers.read_manifest(spark, str(tmp_path)).select("city", "year", "month", "source_url", "bytes")
    assert rows(got) == [("Paris", 2025, 9, "a", 1), ("Paris", 2025, 9, "b", 1), ("Rome", 2025, 8, "c", 1)]
    # Next to files that Spark lists, and at the top.
    (tmp_path / "city=Rome" / "year=2025" / "month=8" / "m.json").write_text('{"entries": [%s], "generated_at": "u"}' % (entry % "d"))
    assert rows(readers.read_manifest(spark, str(tmp_path)).select("city", "source_url"))[2:] == [("Rome", "c"), ("Rome", "d")]
    top = tmp_path / "top"
    top.mkdir()
    (top / "_manifest.json").write_text('{"entries": [%s], "generated_at": "t"}' % (entry % "e"))
    assert rows(readers.read_manifest(spark, str(top)).select("source_url", "generated_at")) == [("e", "t")]


def test_a_log_of_runs_as_one_list(spark, tmp_path):
    run = '{"run_id": "r%d", "timestamp": "t", "model_type": "gbt", "hyperparameters": {"rate": 0.05, "leaves": 48, "kind": "x"},\n "metrics": {"mae": 1.5, "rmse": 2, "mape": NaN, "r2": 0.5}, "reasoning": "", "features_used": ["a", "b"]}'
    (tmp_path / "log.json").write_text("[\n" + ",\n".join(run % i for i in range(2)) + "\n]")
    got = sorted(readers.read_run_log(spark, str(tmp_path), multi_line=True).collect(), key=lambda r: r.run_id)
    assert [r.run_id for r in got] == ["r0", "r1"] and got[0].hyperparameters == {"rate": "0.05", "leaves": "48", "kind": "x"}
    assert (got[0].mae, got[0].rmse, got[0].r2, got[0].features_used) == (1.5, 2.0, 0.5, ["a", "b"]) and got[0].mape != got[0].mape


def test_appended_runs_are_all_read(spark):
    from marketlake.operators import ml

    path = scratch_path(spark, "runs")
    runs = spark.createDataFrame([(float(i), 1.0, float("nan"), 0.5) for i in range(3)], "mae double, rmse double, mape double, r2 double")
    for _ in range(2):
        ml.append_runs(runs, path)
    assert readers.read_runs(spark, path).count() == 6


def test_silver_partition_overwrite(spark):
    path = scratch_path(spark, "silver")
    df = spark.createDataFrame([("A", 1, "x"), ("B", 2, "y")], "city string, listing_id int, v string")
    writers.write_silver(df, path, order=["listing_id"])
    writers.write_silver(df.where("city = 'A'").withColumn("v", F.lit("z")), path, order=["listing_id"])
    assert rows(spark.read.parquet(path).select("city", "v")) == [("A", "z"), ("B", "y")]


def test_write_splits_one_hot_key(spark):
    # All rows share one sort key; they still spread over several files.
    path = scratch_path(spark, "hot")
    df = spark.range(0, 20000, 1, 4).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_silver(df, path, partition=None, order=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = [r[0] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().select("count").collect()]
    assert sum(counts) == 20000 and len(counts) > 1 and max(counts) < 20000


# --- star -----------------------------------------------------------------------------------------------------

LISTING = "city string, listing_id bigint, name string, room_type string, property_type string, accommodates int, bedrooms float, beds float, " \
          "latitude float, longitude float, host_id bigint, host_name string, is_superhost boolean, host_since date, host_listings_count int, " \
          "neighbourhood string, neighbourhood_group string, price float"


def listing(city, id, host=9, area="N", group=None, price=100.0, count=1, lat=1.0):
    return (city, id, f"l{id}", "room", "flat", 2, 1.0, 1.0, lat, 2.0, host, "host", True, datetime.date(2020, 1, 1), count, area, group, price)


@pytest.fixture()
def star(spark):
    listings = spark.createDataFrame(
        [listing("A", 1), listing("A", 2, host=None), listing("A", 3, area=None), listing("B", 4, lat=3.0), listing("B", 5, host=8, group="G")], LISTING
    )
    day = datetime.date(2025, 1, 4)
    calendar = spark.createDataFrame(
        [(c, i, day, True, p, 1) for c, i, p in [("A", 1, 50.0), ("A", 2, 60.0), ("A", 3, 70.0), ("B", 4, None), ("B", 5, 90.0), ("A", 99, 1.0)]]
        + [("A", 1, datetime.date(1990, 1, 1), False, None, 2)],
        "city string, listing_id bigint, calendar_date date, is_available boolean, price float, minimum_nights int",
    )
    reviews = spark.createDataFrame([("A", 1), ("A", 1), ("B", 5)], "city string, listing_id bigint")
    dates = gold.dim_calendar(spark, "2025-01-01", "2025-01-31")
    return listings, calendar, reviews, dates


def test_dim_calendar_defaults(spark):
    dim = gold.dim_calendar(spark)
    assert dim.count() == 4018
    first = dim.where("date_key = 1").first()
    assert (str(first.full_date), first.day_of_week, first.is_weekend, first.season) == ("2020-01-01", 3, False, "Winter")


def test_fact_semantics(star):
    listings, calendar, reviews, dates = star
    dims = gold.build_dims(listings)
    fact = gold.fact_daily(calendar, listings, reviews, dims, dates)
    by_listing = {}
    names = {r.listing_key: r.listing_id for r in dims["listings"].collect()}
    for r in fact.collect():
        by_listing.setdefault(names[r.listing_key], []).append(r)
    assert 99 not in by_listing  # the listing was dropped
    # The area name occurs in two groups, so every fact of it doubles.
    assert {k: len(v) for k, v in by_listing.items()} == {1: 4, 2: 2, 3: 1, 4: 2, 5: 2}
    assert by_listing[4][0].price == 100.0 and by_listing[4][0].est_revenue == 100.0  # listing price as fallback
    early = [r for r in by_listing[1] if r.date_key is None]
    assert len(early) == 2 and early[0].est_revenue == 0.0 and early[0].reviews_to_date == 2
    assert by_listing[2][0].host_key is None and by_listing[3][0].neighbourhood_key is None
    assert sorted(r.fact_id for r in fact.collect()) == list(range(1, 12))
    strict = gold.fact_daily(calendar, listings, reviews, dims, dates, strict=True, with_id=False)
    assert strict.count() == 6


def test_host_versions_fan_out(spark):
    listings = spark.createDataFrame([listing("A", 1, host=7, count=1), listing("A", 2, host=7, count=2)], LISTING)
    hosts = gold.dim_hosts(listings)
    assert rows(hosts.select("host_key", "host_id", "host_listings_count")) == [(1, 7, 1), (2, 7, 2)]


def test_conformed_star(star):
    listings, calendar, reviews, dates = star
    out = gold.conform(listings, calendar, reviews, dates, cities=["A", "B"])
    assert out["listings"].count() == 5 and out["hosts"].count() == 2
    areas = {(r.neighbourhood, r.neighbourhood_group): r.centroid_lat for r in out["neighbourhoods"].collect()}
    assert areas[("N", None)] == 1.0  # the first city's centroid
    fact = out["fact"]
    # Unknown host or area goes; in city B the name N is in two groups.
    assert fact.count() == 2 + 2 + 2
    for key, dim in (("listing_key", "listings"), ("host_key", "hosts"), ("neighbourhood_key", "neighbourhoods")):
        assert Q.check_fk(fact, out[dim], key).isEmpty() and Q.check_unique(out[dim], [key]).isEmpty()
    assert Q.check_unique(fact, ["fact_id"]).isEmpty()


def test_marts(star):
    listings, calendar, reviews, dates = star
    dims = {**gold.build_dims(listings), "dates": dates}
    fact = gold.fact_daily(calendar, listings, reviews, dims, dates, with_id=False)
    snapshot = marts.daily_market_snapshot(fact, dims)
    assert snapshot.where("neighbourhood_group is null").first().active_listings == 3
    assert snapshot.agg(F.sum("available_count")).first()[0] == 6  # listings 1, 4 and 5, twice each
    hosts = {r.host_id: r for r in marts.host_performance(fact, dims["hosts"]).collect()}
    assert hosts[9].active_listings == 3 and hosts[9].total_available_days == 5 and hosts[8].total_reviews == 2
    trend = marts.neighbourhood_trends(fact, dims).where("neighbourhood_group = 'G'").first()
    assert trend.listing_count == 4 and trend.availability_rate == 100.0
    data = listing_dataset(fact, dims)
    # One row per group of the area name; listing 2 has no host, listing 3 no area.
    assert {(r.listing_id, r.neighbourhood_group) for r in data.where("listing_id = 1").collect()} == {(1, "G"), (1, None)}
    assert set(DATASET_KEYS) <= set(data.columns) and data.where("listing_id in (2, 3)").isEmpty()


def test_listing_dataset_reads_the_facts_once(spark, tmp_path):
    """Keys with equal attributes are one listing, a key that is twice in its dimension counts in both; the fact's rows are staged."""
    listing = {1: ["a"], 2: ["a"], 3: ["b", "a"], 4: ["c", "c"], 5: [None], 6: ["d"]}  # key: names
    host, area = {1: [3], 2: [3], 3: [4, 3]}, {1: ["x"], 2: [None]}
    names = [(k, 1, n, None, "p", 2, 1.0, 1.0, 0.0 if k % 2 else -0.0, 1.0) for k, all_names in listing.items() for n in all_names]
    dims = {
        "listings": spark.createDataFrame(names, "listing_key long, listing_id long, name string, room_type string, property_type string, "
                                          "accommodates int, bedrooms double, beds double, latitude double, longitude double"),
        "hosts": spark.createDataFrame([(k, True, n, None) for k, ns in host.items() for n in ns], "host_key long, is_superhost boolean, host_listings_count int, host_since date"),
        "neighbourhoods": spark.createDataFrame([(k, n, None) for k, ns in area.items() for n in ns], "neighbourhood_key long, neighbourhood string, neighbourhood_group string"),
    }
    days = [(k % 7 + 1 if k % 13 else None, k % 4 + 1, k % 2 + 1, float(k % 5) if k % 3 else None, k % 2 == 0, float(k % 5), k) for k in range(300)]
    spark.createDataFrame(days, "listing_key long, host_key long, neighbourhood_key long, price double, is_available boolean, est_revenue double, "
                          "reviews_to_date long").write.parquet(str(tmp_path / "fact"))
    data = listing_dataset(spark.read.parquet(str(tmp_path / "fact")), dims)
    want = {}
    for lk, hk, nk, *rest in days:
        for group in ((n, h, a) for n in listing.get(lk, []) for h in host.get(hk, []) for a in area.get(nk, [])):
            want.setdefault(group, []).append(rest)
    got = {(r.name, r.host_listings_count, r.neighbourhood): r for r in data.collect()}
    assert got.keys() == want.keys() and data.count() == len(want)
    for group, found in want.items():
        r, prices = got[group], [p for p, *_ in found if p is not None]
        assert r.target_price == statistics.median(prices) and r.avg_price == pytest.approx(sum(prices) / len(prices), abs=1e-6)
        assert r.availability_rate == sum(x[1] for x in found) / len(found) and r.est_revenue == sum(x[2] for x in found)
        assert r.total_reviews == max(x[3] for x in found)
    assert not [f for f in data.inputFiles() if f"{tmp_path}/fact" in f]


def test_views_match_functions(spark, star):
    listings, calendar, reviews, dates = star
    dims = {**gold.build_dims(listings), "dates": dates}
    fact = gold.fact_daily(calendar, listings, reviews, dims, dates, with_id=False)
    views = marts.register_marts(fact, dims)
    assert views == ["v_daily_market_snapshot", "v_host_performance", "v_neighbourhood_trends"]
    for view, df in zip(views, (marts.daily_market_snapshot(fact, dims), marts.host_performance(fact, dims["hosts"]), marts.neighbourhood_trends(fact, dims))):
        assert rows(spark.table(view).select(*df.columns)) == rows(df)


def test_views_of_a_script(spark):
    script = "create or replace temp view v_one as select 1 x; create or replace temp view v_two as select x + 1 y from v_one;"
    assert writers.register_views(spark, script) == ["v_one", "v_two"]
    assert spark.table("v_two").first().y == 2


def test_conform_leaves_the_tables_of_its_result_only(spark, star):
    def tables():
        return set(os.listdir(f"{work_dir(spark)}/marketlake"))

    stage(spark.range(1), "any")
    before = tables()
    with staged_tables(spark):
        out = gold.conform(*star, cities=["A", "B"])
        left = sorted(t.rsplit("-", 1)[0] for t in tables() - before)
        assert left and all(t.startswith(("key-", "offsets")) and "input" not in t for t in left), left
        assert len(out["fact"].collect()) > 0 and {n: out[n].count() for n in ("listings", "hosts")} == {"listings": 5, "hosts": 2}
        assert out["neighbourhoods"].count() > 0
    assert tables() == before


def test_reviews_as_of_the_day(spark, star):
    listings, calendar, _, dates = star
    day = datetime.date(2025, 1, 4)
    given = [(1, day), (1, day), (1, day + datetime.timedelta(1)), (5, day - datetime.timedelta(9)), (5, None), (4, None)]
    reviews = spark.createDataFrame(given, "listing_id bigint, review_date date")
    dims = {**gold.build_dims(listings), "dates": dates}
    facts = [gold.fact_daily(calendar, listings, reviews, dims, dates, with_id=False, as_of=a).join(dates, "date_key").join(dims["listings"], "listing_key")
             for a in (False, True)]
    total, running = ([(r.listing_id, r.full_date, r.reviews_to_date) for r in f.collect()] for f in facts)
    seen = [(r.listing_id, r.review_date) for r in reviews.collect()]
    assert sorted(total) == sorted((i, d, sum(s[0] == i for s in seen)) for i, d, _ in total)
    assert sorted(running) == sorted((i, d, sum(s[0] == i and s[1] is not None and s[1] <= d for s in seen)) for i, d, _ in total)


def test_reviews_at_a_day_keep_to_their_city_and_need_no_list(spark):
    day = datetime.date(2025, 1, 4)
    later = day + datetime.timedelta(3)
    calendar = spark.createDataFrame([("x", 1, day), ("x", 1, day), ("y", 1, later), (None, 1, day), ("x", 1, None)],
                                     "city string, listing_id bigint, calendar_date date")
    given = [("x", 1, day)] * 500 + [("x", 1, later), ("y", 1, day), (None, 1, day), ("x", 1, None)]
    at = gold.reviews_at(calendar, spark.createDataFrame(given, "city string, listing_id bigint, review_date date"), "city")
    got = {(r.r_city, r.r_day): r.reviews_at for r in at.collect()}
    assert got == {("x", day): 500, ("x", later): 501, ("y", day): 1, ("y", later): 1, (None, day): 1}
    assert not any(f.dataType.typeName() == "array" for f in at.schema.fields)


# --- landing --------------------------------------------------------------------------------------------------


def test_landing_is_idempotent(spark):
    files = spark.createDataFrame([("a", "x", b"1"), ("b", "x", b"1"), ("c", "x", b"2"), ("d", "y", b"3")], "path string, city string, content binary")
    known = landing.hash_files(files.where("path = 'd'"))
    hashed = landing.hash_files(files)
    assert rows(landing.new_files(hashed, known).select("path")) == [("a",), ("c",)]
    classified = landing.classify(hashed, known)
    assert {r.path: r.status for r in classified.collect()} == {"a": "NEW", "b": "DUPLICATE", "c": "NEW", "d": "DUPLICATE"}
    summary = {r.city: (r.downloaded, r.skipped) for r in landing.landing_summary(classified).collect()}
    assert summary == {"x": (2, 1), "y": (0, 1)}
    broken = landing.classify(landing.hash_files(files.withColumn("content", F.when(F.col("path") != "c", F.col("content")))), known)
    assert {r.path: r.status for r in broken.collect()} == {"a": "NEW", "b": "DUPLICATE", "c": "FAILED", "d": "DUPLICATE"}
    assert rows(landing.landing_summary(broken).select("city", "failed")) == [("x", 1), ("y", 0)]
    assert rows(landing.dry_run(broken).select("city", "path", "bytes")) == [("x", "a", 1)]
    path = scratch_path(spark, "manifest")
    entries = landing.manifest_entries(classified.withColumns({"year": F.lit(2025), "month": F.lit(1), "source_url": F.col("path")}), "2025-01-01")
    landing.append_manifest(entries, path, "t1")
    landing.append_manifest(entries, path, "t2")
    assert readers.read_manifest(spark, path).count() == 8
    assert landing.new_files(hashed, readers.read_manifest(spark, path)).isEmpty()


def test_stream_adds_each_content_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("listing_id,date\n1,2025-01-01\n1,2025-01-01\n")
    (src / "copy.csv").write_text("listing_id,date\n1,2025-01-01\n1,2025-01-01\n")
    args = (str(src), str(tmp_path / "out"), str(tmp_path / "mark"), readers.text_schema("listing_id", "date"), silver.clean_reviews_summary)
    stream_silver(spark, *args)
    assert read_silver(spark, str(tmp_path / "out")).count() == 2  # repeated rows inside one file stay
    (src / "again.csv").write_text("listing_id,date\n1,2025-01-01\n1,2025-01-01\n")
    (src / "b.csv").write_text("listing_id,date\n2,2025-01-02\n")
    query = stream_silver(spark, *args)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2  # contents known, not files seen
    stream_silver(spark, *args)
    assert rows(read_silver(spark, str(tmp_path / "out")).select("listing_id")) == [(1,), (1,), (2,)]
    manifest = spark.read.parquet(str(tmp_path / "out" / "manifest"))
    assert manifest.count() == manifest.select("sha256").distinct().count() == 2
    with pytest.raises(ValueError):
        stream_silver(spark, args[0], args[1], str(tmp_path / "other"), *args[3:])


def test_stream_of_many_batches_knows_earlier_contents(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i in range(6):
        (src / f"f{i}.csv").write_text(f"listing_id,date\n{i % 2},2025-01-01\n")
    args = (str(src), str(tmp_path / "out"), str(tmp_path / "mark"), readers.text_schema("listing_id", "date"), silver.clean_reviews_summary)
    stream_silver(spark, *args, max_files=1)  # six batches, two contents
    assert rows(read_silver(spark, str(tmp_path / "out")).select("listing_id")) == [(0,), (1,)]


# --- features -------------------------------------------------------------------------------------------------


def test_feature_count_and_target(star):
    listings, calendar, reviews, dates = star
    dims = {**gold.build_dims(listings), "dates": dates}
    data = listing_dataset(gold.fact_daily(calendar, listings, reviews, dims, dates, with_id=False), dims)
    out = features.listing_features(data)
    assert len(out.columns) == 56 and "target_price" in out.columns  # 55 features and the target
    assert "est_revenue" not in features.feature_set(out, "prospective").columns
    assert "avg_price" not in features.feature_set(out, "no_avg").columns
    empty_target = features.listing_features(data.withColumn("target_price", F.lit(None).cast("double")))
    assert empty_target.where("target_price is not null").isEmpty()


def test_features_of_a_bare_table(spark):
    out = features.listing_features(spark.createDataFrame([(1, "Cozy loft"), (2, None)], "listing_id int, name string"), keep=["listing_id"])
    got = {r.listing_id: r for r in out.collect()}
    assert got[1].kw_cozy == 1 and got[1].name_kw_count == 2 and got[2].name_len_words == 0.0 and got[1].room_type_freq == 0.0


def test_feature_program_gate(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "listing_id int, s string, target_price double")
    with pytest.raises(ValueError):
        features.apply_program(df, lambda d: d)
    with pytest.raises(ValueError):
        features.apply_program(df, lambda d: d.drop("target_price"))
    assert features.apply_program(df, lambda d: d.drop("s")).columns == ["listing_id", "target_price"]
