"""Idempotent landing: which files are new, what the manifest records, what a run did."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.joins import skip_known


def hash_files(files: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """SHA-256 and size of every file; the content itself is dropped at once and never shuffled.

    A download that failed has no content, so its hash and size are null.
    """
    keep = [c for c in files.columns if c != content]
    body = F.col(content)
    size = F.octet_length(body).cast("bigint")
    return files.select(*keep, F.sha2(body, 256).alias("sha256"), size.alias("bytes"))


def read_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Landed files with their bytes (path, content, ...) and partition columns."""
    return spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", glob).load(root)


def new_files(hashed: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """One file per unknown content: not in the manifest, and the first path among copies in the batch. Failed files do not count.

    Copies collapse in a map-side minimum, so one content that makes up much of the batch is no hot group.
    """
    rest = [c for c in hashed.columns if c not in ("sha256", path)]
    first = hashed.where("sha256 is not null").groupBy("sha256").agg(F.min(F.struct(path, *rest)).alias("f"))
    return skip_known(first, manifest, "sha256").select("sha256", "f.*")


def classify(hashed: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Every file with its status: NEW, DUPLICATE of a known file or of an earlier path in the batch, or FAILED without content."""
    fresh = new_files(hashed, manifest, path).select(path, F.lit(True).alias("_new"))
    joined = hashed.join(fresh, path, "left")
    return joined.withColumn("status", F.when(F.col("sha256").isNull(), "FAILED").when(F.col("_new"), "NEW").otherwise("DUPLICATE")).drop("_new")


def manifest_entries(files: DataFrame, captured_at: str, url: str = "source_url") -> DataFrame:
    """Manifest rows of classified files; failed ones are not recorded, so that the next run tries them again."""
    rows_est = F.col("rows_est") if "rows_est" in files.columns else F.lit(0).cast("bigint")
    return files.where("status != 'FAILED'").select(
        "city", "year", "month", F.col(url).alias("source_url"), F.lit(captured_at).alias("captured_at"),
        "bytes", "sha256", rows_est.alias("rows_est"), "status",
    )


def append_manifest(entries: DataFrame, path: str, generated_at: str) -> None:
    """Append manifest documents under city/year/month; earlier entries stay.

    One document per entry, so that no group of entries has to fit into one row.
    """
    entry = F.struct("source_url", "captured_at", "bytes", "sha256", "rows_est", "status")
    docs = entries.select("city", "year", "month", F.array(entry).alias("entries"), F.lit(generated_at).alias("generated_at"))
    docs.write.mode("append").partitionBy("city", "year", "month").json(path)


def landing_summary(classified: DataFrame, dry_run: bool = False) -> DataFrame:
    """Per city: downloaded, skipped, failed and retried files; a dry run counts what would land (``dry_run`` lists it)."""
    status = F.col("status")
    return classified.groupBy("city").agg(
        F.count_if(status == "NEW").alias("downloaded"),
        F.count_if(status == "DUPLICATE").alias("skipped"),
        F.count_if(status == "FAILED").alias("failed"),
        F.count_if(status == "RETRIED").alias("retried"),
    ).withColumn("dry_run", F.lit(dry_run))


def dry_run(classified: DataFrame, path: str = "path") -> DataFrame:
    """(city, path, bytes, sha256) of the files that a run would land. Nothing is written."""
    return classified.where("status = 'NEW'").select("city", path, "bytes", "sha256")


def run_summary(spark: SparkSession, results: dict[str, str | None]) -> DataFrame:
    """(table, rows, status) of a run: written tables are counted as read back, ``None`` marks a failed one."""
    rows = []
    for name, path in results.items():
        if path is None:
            rows.append(spark.range(1).select(F.lit(name).alias("table"), F.lit(None).cast("bigint").alias("rows"), F.lit("failed").alias("status")))
        else:
            counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
            rows.append(counted.select(F.lit(name).alias("table"), "rows", F.lit("processed").alias("status")))
    return functools.reduce(lambda a, b: a.unionByName(b), rows)
