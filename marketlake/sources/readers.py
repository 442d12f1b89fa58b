"""Scans of raw and clean files."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.session import scratch_path

GEOJSON_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("neighbourhood", T.StringType()),
            T.StructField("neighbourhood_group", T.StringType()),
        ])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),  # kept as JSON text: the depth depends on the type
        ])),
    ]))),
])

POLYGON = "array<array<array<double>>>"

#: Up to so many documents Spark infers the schema itself, from streams.
FEW_FILES = 64

MANIFEST_ENTRY = T.StructType([
    T.StructField("source_url", T.StringType()),
    T.StructField("captured_at", T.StringType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("rows_est", T.LongType()),
    T.StructField("status", T.StringType()),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("entries", T.ArrayType(MANIFEST_ENTRY)),
    T.StructField("generated_at", T.StringType()),
])


def text_schema(*cols: str) -> T.StructType:
    """All columns as text: one read pass, no inference, the same types in every city."""
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Headered CSV, plain or gzipped. Without a schema every column is text, named by the header.

    ``multi_line`` allows line breaks inside quotes; such files, like gzip, are read by one task each, so many
    files give the parallelism. Turn it off for plain CSV without such breaks to split large files.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("enforceSchema", False) if schema is not None else reader.option("inferSchema", False)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_json(spark: SparkSession, path, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """JSON documents, one per file (or one per line with ``multi_line=False``); the schema is inferred if absent.

    Many small files are read by few tasks (see :func:`_packed`), and their schema is inferred from whole texts, as
    Spark's own inference passes the names of all files along with each of them.
    """
    reader = spark.read.option("multiLine", multi_line)
    if not multi_line or not isinstance(path, (str, list)):
        return (reader.schema(schema) if schema is not None else reader).json(path)
    if schema is not None:
        return _packed(reader.schema(schema).json(path))
    # The text source lists the same files and finds the same partition columns; a text keeps the bytes of its file.
    texts = spark.read.schema("_document string").text(path, wholetext=True)
    if _n_files(texts) <= FEW_FILES:
        return reader.json(path)
    documents = getattr(_packed(texts).select("_document")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    inferred = DataFrame(spark._jsparkSession.read().json(documents), spark).schema
    parts = {_name(spark, f.name): f for f in texts.schema.fields[1:]}
    found = T.StructType([parts.get(_name(spark, f.name), f) for f in inferred.fields])
    df = _packed(reader.schema(found).json(path))
    # A field that is a partition column too has the column's type and the field's place, as when Spark infers.
    places = [*[f.name for f in found.fields], *[f.name for n, f in parts.items() if n not in {_name(spark, c) for c in found.names}]]
    return df if df.columns == places else df.select(*[F.col(f"`{c}`") for c in places])


def _name(spark: SparkSession, column: str) -> str:
    """The name as the session compares it."""
    return column if spark.conf.get("spark.sql.caseSensitive") == "true" else column.lower()


def _n_files(df: DataFrame) -> int:
    return len(df._jdf.inputFiles())


def _packed(df: DataFrame) -> DataFrame:
    """A scan of many small files in no more tasks than its bytes and files ask for: a thousand files a task, or fewer
    if that gives less than four tasks a core. By itself a scan counts some megabytes for every file."""
    files, spark = _n_files(df), df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(-(-size // most), -(-files // 1000), 4 * spark.sparkContext.defaultParallelism)
    return df.coalesce(tasks) if tasks < files else df


def read_parquet(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def latest_partitions(spark: SparkSession, root: str, filename: str, cities: list[str] | None = None) -> DataFrame:
    """Newest (city, year, month) per city that holds ``filename``. Lists the files, reads none."""
    files = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", filename)
    found = files.load(root).select("city", "year", "month").distinct()
    if cities is not None:
        found = found.where(F.lower("city").isin(*[c.lower() for c in cities]))
    return found.groupBy("city").agg(F.max(F.struct("year", "month")).alias("p")).select("city", "p.year", "p.month")


def read_bronze(spark: SparkSession, root: str, filename: str, cities: list[str] | None = None, latest: bool = True,
                schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """A raw file of many cities under ``root/city=/year=/month=/filename`` with its partition columns.

    ``filename`` may be a glob. With ``latest`` only the newest month of each city is read; other months are never
    opened. Every file is read by its own header and the columns of all are united by name, so cities may order
    or extend theirs as they like; a column that a city lacks is null. With ``schema`` its columns are taken by name.
    Turn ``multi_line`` off for plain files without line breaks in quotes, to split large ones.

    File names come to the driver, one for each landed file, and the header of each file by a small job.
    """
    files = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", filename).load(root)
    found = files.select("path", "city", "year", "month")
    if cities is not None:
        found = found.where(F.lower("city").isin(*[c.lower() for c in cities]))
    if latest:
        newest = found.groupBy(F.col("city").alias("_c")).agg(F.max(F.struct("year", "month")).alias("_p"))
        found = found.join(newest, (F.col("city") == F.col("_c")) & (F.struct("year", "month") == F.col("_p")))
    reader = (
        spark.read.option("basePath", root).option("pathGlobFilter", filename).option("header", True)
        .option("escape", '"').option("multiLine", multi_line).option("inferSchema", False)
    )
    paths = [r["path"] for r in found.select("path").orderBy("path").collect()]
    parts = [f.name for f in files.schema.fields if f.name in ("city", "year", "month")]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(c for c in reader.csv(path).columns if c not in parts)
        by_header.setdefault(header, []).append(path)
    if not by_header:
        empty = schema or T.StructType()
        return spark.createDataFrame([], T.StructType([*empty.fields, *[files.schema[c] for c in parts]]))
    tables = [reader.schema(text_schema(*header)).csv(same) for header, same in by_header.items()]
    df = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if schema is None:
        return df
    named = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*named, *parts)


def _json_documents(spark: SparkSession, root, schema: T.StructType, multi_line: bool, must_have: str, **options) -> DataFrame:
    """JSON files in one of two layouts; a file in the other one is an error, never a shorter result.

    By default a document per line, as this library writes them. ``multi_line`` is for files that hold a single
    document or list over many lines.
    """
    reader = spark.read.schema(schema).options(mode="FAILFAST", **options)
    if multi_line:
        lines = spark.read.options(**options).text(root).select("value", F.col("_metadata.file_path").alias("file"))
        whole = F.try_parse_json("value").isNotNull() & F.coalesce(F.from_json("value", schema)[must_have].isNotNull(), F.lit(False))
        many = lines.where(whole).groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("file").limit(1).collect()
        if many:
            raise ValueError(f"{many[0]['file']} has a document per line; read it with multi_line=False")
    return reader.option("multiLine", multi_line).json(root)


def _visible_manifests(spark: SparkSession, root: str) -> str | None:
    """Copies of the ``_manifest.json`` files under ``root`` with a name that Spark lists, in the work folder; None if there are none.

    There is one such file for each city and month; its bytes are passed on in pieces, none is held whole.
    """
    hadoop, conf, copies = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration(), None
    for depth in (0, 3):
        glob = hadoop.Path("/".join([root.rstrip("/"), *["*"] * depth, "_manifest.json"]))
        for status in glob.getFileSystem(conf).globStatus(glob) or []:
            copies = copies or scratch_path(spark, "manifests")
            found = status.getPath()
            folders = str(found.getParent().toUri().getPath()).split("/")
            to = hadoop.Path("/".join([copies, *(folders[-depth:] if depth else []), "manifest.json"]))
            hadoop.FileUtil.copy(found.getFileSystem(conf), found, to.getFileSystem(conf), to, False, conf)
    return copies


def read_manifest(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Manifest documents flattened to one row per entry, with the partition columns of their path.

    By default one document per line, as ``append_manifest`` writes them; ``multi_line`` is for files that are a single
    indented document; a file in the other layout raises an error. Files named ``_manifest.json`` always are a single
    document; Spark does not list names that start with an underscore, so they are read as copies.
    """
    df = _json_documents(spark, root, MANIFEST_SCHEMA, multi_line, "entries", basePath=root, pathGlobFilter="*.json")
    hidden = _visible_manifests(spark, root)
    if hidden:
        copies = _json_documents(spark, hidden, MANIFEST_SCHEMA, True, "entries", basePath=hidden)
        df = copies.unionByName(df, allowMissingColumns=True)
    have = [c for c in ("city", "year", "month") if c in df.columns]
    return df.select(*have, "generated_at", F.explode("entries").alias("e")).select(*have, "generated_at", "e.*")


def read_dataset(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """The listing dataset with its explicit schema."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def read_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Metrics of many experiment runs; ``NaN`` is read as such. ``file`` names the source.

    By default one run per line, as ``append_runs`` writes them; ``multi_line`` is for a file per run or a list of runs.
    """
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("mae", "rmse", "mape", "r2")])
    runs = _json_documents(spark, path, schema, multi_line, "mae", allowNonNumericNumbers="true")
    return runs.select("*", F.col("_metadata.file_path").alias("file"))


def read_run_log(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The log of experiments, one row per run: run_id, timestamp, model_type, hyperparameters (map of texts, as their
    names depend on the model), mae, rmse, mape, r2, reasoning, features_used and ``file``.

    By default one run per line; ``multi_line`` is for a single list of runs.
    """
    metrics = "struct<mae: double, rmse: double, mape: double, r2: double>"
    schema = T.StructType.fromDDL(
        f"run_id string, timestamp string, model_type string, hyperparameters map<string, string>, metrics {metrics}, reasoning string, features_used array<string>")
    runs = _json_documents(spark, path, schema, multi_line, "run_id", allowNonNumericNumbers="true")
    return runs.select("run_id", "timestamp", "model_type", "hyperparameters", "metrics.*", "reasoning", "features_used",
                       F.col("_metadata.file_path").alias("file"))


def read_log_lines(spark: SparkSession, path, charset: str = "UTF-16") -> DataFrame:
    """Lines (file, line_no, line) of text files in a given charset; one file is one task."""
    files = spark.read.format("binaryFile").load(path)
    text = F.regexp_replace(F.decode("content", charset), "﻿", "")
    return files.select(F.col("path").alias("file"), F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line_no", "line"))


def strip_log_lines(df: DataFrame, col: str = "line") -> DataFrame:
    """Drop blank lines and JSON log records (objects with level, logger and message); keep the rest."""
    record = F.from_json(F.col(col), "level string, logger string, message string")
    is_log = record["level"].isNotNull() & record["logger"].isNotNull() & record["message"].isNotNull()
    return df.where((F.trim(F.col(col)) != "") & ~F.coalesce(is_log, F.lit(False)))


def geojson_features(df: DataFrame) -> DataFrame:
    """One row per feature of a FeatureCollection: names, geometry type and coordinates.

    Coordinates are a list of polygons; a single polygon is a list of one.
    """
    shape, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    polygons = F.when(kind == "Polygon", F.array(F.from_json(shape, POLYGON))).otherwise(F.from_json(shape, f"array<{POLYGON}>"))
    have = [c for c in ("city", "year", "month") if c in df.columns]
    rows = df.select(*have, F.explode("features").alias("f"))
    return rows.select(
        *have,
        F.col("f.properties.neighbourhood").alias("neighbourhood"),
        F.col("f.properties.neighbourhood_group").alias("neighbourhood_group"),
        kind.alias("geometry_type"),
        polygons.alias("coordinates"),
    )


def estimate_rows(df: DataFrame) -> DataFrame:
    """(file, rows_est) of a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows_est"))


def date_series(spark: SparkSession, start: str, end: str, name: str = "full_date") -> DataFrame:
    """All days from ``start`` to ``end``."""
    return spark.sql(
        "select explode(sequence(cast(:a as date), cast(:b as date), interval 1 day)) as d", {"a": str(start), "b": str(end)}
    ).withColumnRenamed("d", name)


def date_span(df: DataFrame, col: str, name: str = "full_date") -> DataFrame:
    """All days from the first to the last date of a column."""
    day = F.col(col).cast("date")
    bounds = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return bounds.select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias(name))
