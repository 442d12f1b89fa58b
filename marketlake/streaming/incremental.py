"""Incremental raw-to-clean job: every landed file is processed once, every content is added once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sources.landing import hash_files
from marketlake.sources.readers import read_csv


FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
MANIFEST = "sha256 string, path string, bytes bigint, batch bigint"


def _replace_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch folder; writing it again after a failure replaces it."""
    (
        df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    )


def stream_silver(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType,
                  clean: Callable[[DataFrame], DataFrame], glob: str = "*", max_files: int = 1000):
    """Clean what is new under ``src``, add it to ``dst/rows``, then stop.

    The checkpoint remembers the files seen and, as keyed state, the hashes of all contents. The state is held by the
    session's state store: Spark's default keeps it in the executors' memory, some 200 bytes a content over all of them;
    RocksDB keeps it on their disks, at a few MB for each shuffle partition. A file landed again under another name, in
    this run or an earlier one, meets its hash there and adds nothing; a batch looks up its own hashes only, however many
    are known. Contents are hashed where they are read and never shuffled. At most ``max_files`` paths per batch reach the
    driver. Rows and ``dst/manifest`` of a batch replace themselves when the batch runs again, so a lost executor or driver
    never doubles rows.

    Checkpoint and destination belong together: a new checkpoint over a filled destination is an error, as batches
    would be numbered anew and replace others. The number of shuffle partitions of the first run stays.
    """
    rows, manifest = f"{dst}/rows", f"{dst}/manifest"
    spark.createDataFrame([], MANIFEST).write.mode("ignore").partitionBy("batch").parquet(manifest)
    if not _exists(spark, f"{checkpoint}/offsets") and not spark.read.schema(MANIFEST).parquet(manifest).isEmpty():
        raise ValueError(f"{dst} was filled under another checkpoint than {checkpoint}")

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = batch.collect()  # once: every evaluation would ask the state again
        if not fresh:
            return
        paths = sorted(r["path"] for r in fresh)
        _replace_batch(clean(read_csv(session, paths, schema)), batch_id, rows)
        _replace_batch(session.createDataFrame(fresh, "sha256 string, path string, bytes bigint"), batch_id, manifest)

    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    )
    hashed = hash_files(files.load(src).select("path", "content")).select("sha256", "path", "bytes")
    query = (
        hashed.dropDuplicates(["sha256"]).writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(add).start()
    )
    query.awaitTermination()
    return query


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_silver(spark: SparkSession, dst: str) -> DataFrame:
    """The rows written by :func:`stream_silver`."""
    return spark.read.parquet(f"{dst}/rows").drop("batch")
