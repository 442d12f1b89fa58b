"""Scans, sinks, landing and catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.plans import silver
from marketlake.plans.dataset import DATASET_SCHEMA
from marketlake.session import scratch_path, stage
from marketlake.sources import catalog, landing, readers, writers
from marketlake.sources.split_csv import read_csv_split
from marketlake.streaming.incremental import read_silver, stream_silver
from marketlake.verification.fixtures import days_as_text, widen, with_ctes
from marketlake.verification.registry import query

RAW_COLUMNS = ["id", "name", "price", "host_is_superhost", "latitude", "longitude", "minimum_nights"]


@query("s01_gzip_csv_scan", with_ctes("fx_listing_raw", "select * from fx_listing_raw"))
def s01(t):
    path = scratch_path(t.spark, "s01")
    t.listing_raw.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv(t.spark, path, readers.text_schema(*RAW_COLUMNS))


@query(
    "s02_plain_csv_scan",
    "select cast(o_orderkey as varchar) o_orderkey, cast(o_custkey as varchar) o_custkey, o_orderstatus, o_orderpriority from orders",
)
def s02(t):
    path = scratch_path(t.spark, "s02")
    t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, multi_line=False)


@query(
    "s02_quoted_csv_split",
    "select cast(doc_id as varchar) doc_id, text, lang, source from documents",
)
def s02_split(t):
    path = scratch_path(t.spark, "s02-split")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    t.documents.select("doc_id", "text", "lang", "source").write.options(header=True, escape='"', quoteAll=True, **keep).csv(path)
    return read_csv_split(t.spark, path, readers.text_schema("doc_id", "text", "lang", "source"))


@query("s03_json_scan", "select conv_id, turn, role, text from conversations")
def s03(t):
    path = scratch_path(t.spark, "s03")
    t.conversations.write.json(path)
    return readers.read_json(t.spark, path, multi_line=False).select("conv_id", "turn", "role", "text")


@query("s03_json_documents", "select s_suppkey, s_name, s_nationkey::bigint s_nationkey, s_acctbal from supplier")
def s03_documents(t):
    """A document per file, as the default reads them, with an inferred schema.

    The files are written by all cores and committed by their tasks. On a local disk they get no checksum file: that and
    its permissions cost three processes a file.
    """
    path = scratch_path(t.spark, "s03-documents")
    plain = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    spread = t.table("supplier").repartition(4 * t.spark.sparkContext.defaultParallelism)
    spread.write.options(**plain, **{"mapreduce.fileoutputcommitter.algorithm.version": "2"}).option("maxRecordsPerFile", 1).json(path)
    return readers.read_json(t.spark, path).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("s04_parquet_scan", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def s04(t):
    return readers.read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "s05_parquet_sink",
    with_ctes(
        "fx_listing",
        """select listing_id, name, case when city = 'ASIA' then price + 1 else price end price, city
           from fx_listing where city is not null""",
    ),
)
def s05(t):
    path = scratch_path(t.spark, "s05")
    rows = t.listing.where("city is not null").select("listing_id", "name", "price", "city")
    writers.write_silver(rows, path, order=["listing_id"])
    # A second run for one city replaces that city only.
    again = rows.where("city = 'ASIA'").withColumn("price", F.col("price") + 1)
    return writers.write_silver(again, path, order=["listing_id"]).select("listing_id", "name", "price", "city")


def _bronze_orders(t, tag):
    path = scratch_path(t.spark, tag)
    orders = t.orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("city"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )
    # One file per month directory and city, as a landing job leaves them.
    orders.repartition("city", "year", "month").write.option("header", True).option("compression", "gzip").partitionBy(
        "city", "year", "month").csv(path)
    return path


@query(
    "s06_bronze_discovery",
    """select cast(o_orderkey as varchar) o_orderkey, o_orderstatus, o_orderpriority city, cast(year(o_orderdate) as bigint) "year",
              cast(month(o_orderdate) as bigint) "month"
       from orders o join (select o_orderpriority p, max(year(o_orderdate) * 100 + month(o_orderdate)) ym from orders group by 1) m
         on m.p = o.o_orderpriority and m.ym = year(o_orderdate) * 100 + month(o_orderdate)
       where o_orderpriority in ('1-URGENT', '5-LOW')""",
)
def s06(t):
    root = _bronze_orders(t, "s06")
    df = readers.read_bronze(
        t.spark, root, "part-*.csv.gz", ["1-urgent", "5-low"], schema=readers.text_schema("o_orderkey", "o_orderstatus")
    )
    return df.select("o_orderkey", "o_orderstatus", "city", F.col("year").cast("bigint"), F.col("month").cast("bigint"))


def _document_files(t):
    """Documents as landed files: the text is the content, the language the city."""
    return t.documents.select(
        F.col("doc_id").alias("path"), F.col("lang").alias("city"), F.encode("text", "utf-8").alias("content")
    )


def _known(t):
    """The manifest of an earlier run that landed the French files."""
    return t.documents.where("lang = 'fr'").select(F.sha2("text", 256).alias("sha256"))


@query(
    "s07_new_files",
    """select sha256(text) sha256, min(doc_id) path, min_by(lang, doc_id) city, min_by(octet_length(encode(text)), doc_id) bytes
       from documents where coalesce(sha256(text) not in (select sha256(text) from documents where lang = 'fr' and text is not null), true)
         and text is not null group by 1""",
)
def s07(t):
    hashed = landing.hash_files(_document_files(t))
    return landing.new_files(hashed, _known(t)).select("sha256", "path", "city", "bytes")


_CLASSIFIED = """
files as (select doc_id, lang city, sha256(text) sha256, octet_length(encode(text)) bytes from documents),
known as (select distinct sha256(text) sha256 from documents where lang = 'fr' and text is not null),
fresh as (select min(doc_id) doc_id from files where sha256 is not null and sha256 not in (select sha256 from known) group by sha256),
classified as (select f.*, case when f.sha256 is null then 'FAILED' when n.doc_id is null then 'DUPLICATE' else 'NEW' end status
               from files f left join fresh n on n.doc_id = f.doc_id)
"""


def _classified(t):
    return landing.classify(landing.hash_files(_document_files(t)), _known(t))


def _entries(t):
    files = _classified(t).withColumns({
        "year": F.lit(2025), "month": F.lit(9), "source_url": F.concat(F.lit("doc-"), F.col("path").cast("string")),
    })
    return landing.manifest_entries(files, "2025-09-30")


def _write_manifest(t, tag):
    path = scratch_path(t.spark, tag)
    entries = stage(_entries(t), "entries")
    landing.append_manifest(entries.where("status = 'DUPLICATE'"), path, "2025-09-30T00:00:00")
    landing.append_manifest(entries.where("status = 'NEW'"), path, "2025-10-01T00:00:00")
    return path


@query(
    "s08_manifest_append",
    f"""with {_CLASSIFIED}
        select city, case when status = 'NEW' then '2025-10-01T00:00:00' else '2025-09-30T00:00:00' end generated_at,
               count(*) entries, sum(bytes)::bigint bytes from classified where status <> 'FAILED' group by 1, 2""",
)
def s08(t):
    path = _write_manifest(t, "s08")
    docs = t.spark.read.schema(readers.MANIFEST_SCHEMA).json(path)
    entries = docs.select("city", "generated_at", F.explode("entries").alias("e"))
    return entries.groupBy("city", "generated_at").agg(F.count(F.lit(1)).alias("entries"), F.sum("e.bytes").alias("bytes"))


@query(
    "s09_manifest_read",
    f"""with {_CLASSIFIED}
        select city, 2025::bigint "year", 9::bigint "month", 'doc-' || doc_id source_url, '2025-09-30' captured_at, bytes, sha256,
               0::bigint rows_est, status from classified where status <> 'FAILED'""",
)
def s09(t):
    rows = readers.read_manifest(t.spark, _write_manifest(t, "s09")).drop("generated_at")
    return rows.withColumns({"year": F.col("year").cast("bigint"), "month": F.col("month").cast("bigint")})


@query(
    "s10_row_estimates",
    "select l_returnflag || l_linestatus part, count(*) rows_est from lineitem group by 1",
)
def s10(t):
    path = scratch_path(t.spark, "s10")
    flags = t.lineitem.select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("part"))
    flags.write.option("header", True).partitionBy("part").csv(path)
    counts = readers.estimate_rows(readers.read_csv(t.spark, path, multi_line=False))
    part = F.regexp_extract("file", r"part=([^/]+)/", 1)
    return counts.groupBy(part.alias("part")).agg(F.sum("rows_est").alias("rows_est"))


@query("s11_publish_table", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def s11(t):
    path = scratch_path(t.spark, "s11")
    name = "serving_" + path.rsplit("-", 1)[-1]
    writers.publish_table(t.supplier, name, path=path)
    return t.spark.table(name)


@query("s12_materialise", "select o_custkey, count(*) orders from orders group by 1")
def s12(t):
    path = scratch_path(t.spark, "s12")
    orders = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return writers.materialise(orders, "orders_by_customer_" + path.rsplit("-", 1)[-1], path)


_DATASET_SQL = with_ctes("dataset", "select * replace (strftime(host_since, '%Y-%m-%d') as host_since) from dataset")


@query("s14_csv_sink", _DATASET_SQL)
def s14(t):
    path = scratch_path(t.spark, "s14")
    writers.write_csv(t.dataset, path)
    raw = readers.read_csv(t.spark, path, multi_line=False)
    return widen(raw.select(*[F.col(f.name).cast(f.dataType) for f in DATASET_SCHEMA.fields]))


@query("s15_dataset_scan", _DATASET_SQL)
def s15(t):
    path = scratch_path(t.spark, "s15")
    writers.write_csv(t.dataset, path)
    return widen(readers.read_dataset(t.spark, path, DATASET_SCHEMA))


@query(
    "s16_raw_null_audit",
    with_ctes("fx_listing_raw", """select count(*) total_rows, count(price) non_null_price, count(minimum_nights) non_null_minimum_nights
                                   from fx_listing_raw"""),
)
def s16(t):
    return catalog.raw_null_audit(t.listing_raw, ["price", "minimum_nights"])


@query(
    "s17_catalog_inventory",
    """select 'inv_lineitem' "table", count(*) "rows", 'l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax' "columns" from lineitem
       union all select 'inv_orders', count(*), 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' from orders
       union all select 'inv_documents', count(*), 'doc_id, text, lang, source, n_chars' from documents""",
)
def s17(t):
    for name in ("lineitem", "orders", "documents"):
        t.table(name).createOrReplaceTempView(f"inv_{name}")
    return catalog.catalog_inventory(t.spark, "inv_*")


@query(
    "s18_describe_schema",
    """select 1 "position", 'doc_id' "column", 'bigint' "type", count(doc_id) filled from documents
       union all select 2, 'text', 'string', count(text) from documents
       union all select 3, 'lang', 'string', count(lang) from documents
       union all select 4, 'source', 'string', count(source) from documents
       union all select 5, 'n_chars', 'bigint', count(n_chars) from documents""",
)
def s18(t):
    filled = t.documents.agg(*[F.count(c).alias(c) for c in t.documents.columns])
    schema = catalog.describe_schema(t.documents).drop("nullable")
    return schema.join(filled.unpivot([], t.documents.columns, "column", "filled"), "column")


@query(
    "s19_date_series",
    """with days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) full_date from
         (select cast(min(cast(l_shipdate as date)) as timestamp) lo, cast(max(cast(l_shipdate as date)) as timestamp) hi from lineitem))
       select strftime(full_date, '%Y-%m-%d') full_date, count(l_orderkey) shipped
       from days left join lineitem on cast(l_shipdate as date) = full_date group by 1""",
)
def s19(t):
    first, last = t.lineitem.agg(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    shipped = t.lineitem.groupBy(F.to_date("l_shipdate").alias("full_date")).agg(F.count(F.lit(1)).alias("shipped"))
    days = readers.date_series(t.spark, first, last).join(shipped, "full_date", "left").na.fill(0, ["shipped"])
    return days_as_text(days)


@query(
    "s20_strip_log_lines",
    """select event_id, line from (
         select event_id, unnest([props, '', '  ', '{"level": "INFO", "logger": "' || event_type || '", "message": "done"}',
                                  '{"level": "' || event_type || '"}']) line from events)
       where trim(line) <> '' and not contains(line, '"logger"')""",
)
def s20(t):
    record = F.concat(F.lit('{"level": "INFO", "logger": "'), "event_type", F.lit('", "message": "done"}'))
    short = F.concat(F.lit('{"level": "'), "event_type", F.lit('"}'))
    lines = t.events.select("event_id", F.explode(F.array("props", F.lit(""), F.lit("  "), record, short)).alias("line"))
    return readers.strip_log_lines(lines)


@query(
    "s20_log_files",
    """select line, count(*) lines from (
         select unnest([props, '', '  ', '{"level": "INFO", "logger": "' || event_type || '", "message": "done"}',
                        '{"level": "' || event_type || '"}']) line from events)
       where trim(line) <> '' and not contains(line, '"logger"') group by 1""",
)
def s20_files(t):
    """The same lines in UTF-16 files."""
    record = F.concat(F.lit('{"level": "INFO", "logger": "'), "event_type", F.lit('", "message": "done"}'))
    short = F.concat(F.lit('{"level": "'), "event_type", F.lit('"}'))
    lines = t.events.select(F.explode(F.array("props", F.lit(""), F.lit("  "), record, short)).alias("line"))
    path = scratch_path(t.spark, "s20")
    plain = {"quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "sep": "\x01"}
    lines.write.options(encoding="UTF-16", **plain).csv(path)
    kept = readers.strip_log_lines(readers.read_log_lines(t.spark, path))
    return kept.groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s21_run_log",
    """select 'run_' || l_linenumber run_id, case when l_linenumber % 2 = 0 then 'forest' else 'gbt' end model_type,
              l_linenumber * 100 rounds, round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) mae, 2::bigint features, 'l_quantity' first_feature
       from lineitem group by l_linenumber""",
)
def s21_log(t):
    path = scratch_path(t.spark, "s21-log")
    number = F.col("l_linenumber").cast("bigint")
    runs = t.lineitem.groupBy(number.alias("n")).agg(F.avg(F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500)).alias("mae"))
    metrics = F.struct("mae", F.lit(1.0).alias("rmse"), F.lit(float("nan")).alias("mape"), F.lit(0.5).alias("r2"))
    runs.select(
        F.concat(F.lit("run_"), "n").alias("run_id"), F.lit("2026-01-01").alias("timestamp"),
        F.when(F.col("n") % 2 == 0, "forest").otherwise("gbt").alias("model_type"),
        F.struct((F.col("n") * 100).alias("rounds"), F.lit(0.05).alias("rate")).alias("hyperparameters"), metrics.alias("metrics"),
        F.lit("").alias("reasoning"), F.array(F.lit("l_quantity"), F.lit("l_discount")).alias("features_used"),
    ).write.json(path)
    read = readers.read_run_log(t.spark, path)
    return read.select(
        "run_id", "model_type", F.col("hyperparameters")["rounds"].cast("bigint").alias("rounds"), F.round("mae", 4).alias("mae"),
        F.size("features_used").cast("bigint").alias("features"), F.col("features_used")[0].alias("first_feature"),
    )


@query(
    "s21_run_log_scan",
    """select l_linenumber run_id, round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) mae,
              round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 4) rmse, true mape_is_nan
       from lineitem group by 1""",
)
def s21(t):
    path = scratch_path(t.spark, "s21")
    err = F.col("l_extendedprice") - F.col("l_quantity") * 1500
    runs = t.lineitem.groupBy(F.col("l_linenumber").alias("run")).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")
    )
    runs = runs.withColumns({"mape": F.lit(float("nan")), "r2": F.lit(1.0)})
    runs.write.option("ignoreNullFields", False).partitionBy("run").json(path)
    read = readers.read_runs(t.spark, f"{path}/run=*/*.json")
    return read.select(
        F.regexp_extract("file", r"run=(\d+)", 1).cast("bigint").alias("run_id"), F.round("mae", 4).alias("mae"),
        F.round("rmse", 4).alias("rmse"), F.isnan("mape").alias("mape_is_nan"),
    )


def _write_geojson(t, tag):
    """One FeatureCollection per customer: a polygon and a multi-polygon around points from the key."""
    x, y = (F.col("c_custkey") % 360).cast("double"), (F.col("c_custkey") % 90).cast("double")

    def ring(d):
        return F.array(F.array(x, y), F.array(x + d, y), F.array(x + d, y + d), F.array(x, y))

    def feature(kind, name, coordinates):
        return F.struct(
            F.lit("Feature").alias("type"),
            F.struct(name.alias("neighbourhood"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("neighbourhood_group")).alias("properties"),
            F.struct(F.lit(kind).alias("type"), F.parse_json(F.to_json(coordinates)).alias("coordinates")).alias("geometry"),
        )

    features = F.array(
        feature("Polygon", F.col("c_name"), F.array(ring(1.0))),
        feature("MultiPolygon", F.concat("c_name", F.lit(" north")), F.array(F.array(ring(2.0)), F.array(ring(3.0)))),
    )
    path = scratch_path(t.spark, tag)
    t.customer.select(F.lit("FeatureCollection").alias("type"), features.alias("features")).write.json(path)
    return path


_GEO_SQL = """
select c_name neighbourhood, case when c_mktsegment <> 'BUILDING' then c_mktsegment end neighbourhood_group,
       'Polygon' geometry_type, 1 polygons, (c_custkey % 360)::double first_lon from customer
union all
select c_name || ' north', case when c_mktsegment <> 'BUILDING' then c_mktsegment end, 'MultiPolygon', 2, (c_custkey % 360)::double
from customer
"""


def _geo_view(features):
    return features.select(
        "neighbourhood", "neighbourhood_group", "geometry_type", F.size("coordinates").alias("polygons"),
        F.col("coordinates")[0][0][0][0].alias("first_lon"),
    )


@query("s22_geojson_features", _GEO_SQL)
def s22(t):
    path = _write_geojson(t, "s22")
    return _geo_view(readers.geojson_features(readers.read_json(t.spark, path, readers.GEOJSON_SCHEMA, multi_line=False)))


@query("d07_clean_geojson", _GEO_SQL)
def d07(t):
    path = _write_geojson(t, "d07")
    clean = silver.clean_geojson(readers.read_json(t.spark, path, readers.GEOJSON_SCHEMA, multi_line=False))
    return _geo_view(stage(clean, "geojson"))


@query(
    "s23_landing_summary",
    f"""with {_CLASSIFIED}
        select city, count(*) filter (status = 'NEW') downloaded, count(*) filter (status = 'DUPLICATE') skipped, count(*) filter (status = 'FAILED') failed,
               0::bigint retried, true dry_run from classified group by 1""",
)
def s23(t):
    return landing.landing_summary(_classified(t), dry_run=True)


@query(
    "s23_dry_run_listing",
    f"""with {_CLASSIFIED.replace("sha256(text) sha256", "case when source not in ('src0', 'src1') then sha256(text) end sha256", 1).replace("octet_length(encode(text)) bytes", "case when source not in ('src0', 'src1') then octet_length(encode(text)) end bytes")}
        select city, doc_id path, bytes, sha256, failed from classified
        join (select city, count(*) filter (status = 'FAILED') failed from classified group by 1) using (city) where status = 'NEW'""",
)
def s23_dry_run(t):
    """What would land when the downloads of two sources have failed, and how many failed in the city."""
    files = t.documents.select(
        F.col("doc_id").alias("path"), F.col("lang").alias("city"),
        F.when(~F.col("source").isin("src0", "src1"), F.encode("text", "utf-8")).alias("content"),
    )
    classified = landing.classify(landing.hash_files(files), _known(t))
    failed = landing.landing_summary(classified, dry_run=True).select("city", "failed")
    return landing.dry_run(classified).join(failed, "city").select("city", "path", "bytes", "sha256", "failed")


@query(
    "s24_run_summary",
    """select 'lineitem' "table", count(*) "rows", 'processed' status from lineitem
       union all select 'orders', count(*), 'processed' from orders union all select 'geojson', null, 'failed'""",
)
def s24(t):
    paths = {}
    for name, col in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        paths[name] = scratch_path(t.spark, name)
        t.table(name).select(col).write.parquet(paths[name])
    return landing.run_summary(t.spark, {**paths, "geojson": None})


@query(
    "x01_stream_silver",
    with_ctes(
        "fx_listing_raw",
        """select cast(id as bigint) listing_id, name, cast(replace(replace(price, '$', ''), ',', '') as float)::double price,
                  case host_is_superhost when 't' then true when 'f' then false end is_superhost
           from fx_listing_raw where latitude is not null
             and cast(replace(replace(price, '$', ''), ',', '') as float) > 0""",
    ),
)
def x01(t):
    src, dst, mark = (scratch_path(t.spark, f"x01-{n}") for n in ("src", "dst", "mark"))
    raw = stage(t.listing_raw, "x01-raw")
    schema = readers.text_schema(*RAW_COLUMNS)
    for i in range(2):
        # The second landing brings the same files again under other names; nothing is added.
        raw.write.mode("append").option("header", True).csv(src)
        stream_silver(t.spark, src, dst, mark, schema, lambda df: silver.clean_listings(df, "2025-01-01"), "*.csv")
    return read_silver(t.spark, dst).select("listing_id", "name", F.col("price").cast("double").alias("price"), "is_superhost")
