"""Session set-up and the shared work folder for staged tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(app: str = "marketlake", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution and UTC dates.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster both come from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for an unconfigured local session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="marketlake-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, not yet existing path in the work folder."""
    return f"{work_dir(spark)}/marketlake/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str = "stage", done: Iterable[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the work folder and read it back.

    Cuts the lineage: the rows are fixed from here on, survive the loss of executors, and the optimizer knows
    their size, so it can decide by itself whether a side is small enough to broadcast. ``done`` are staged tables
    whose last reader this write is; they are deleted after it. So are the write's shuffle files, which else stay until
    the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    for scope in _SCOPES:
        scope.paths.append(path)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    release(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their own shuffle files as they end."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def release(*tables: DataFrame) -> None:
    """Delete staged tables. Only for what nothing reads any more: results that were computed lazily still do.

    A task that runs again afterwards reads the table that was written from these, so a lost executor does no harm.
    """
    for table in tables:
        _delete(table.sparkSession, table._staged_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class StagedTables:
    """The tables staged inside ``with``, to be deleted by ``delete`` once their last reader has ended.

    Scopes may be nested; an outer one owns the tables of the inner ones too. They belong to one driver thread.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> StagedTables:
        _SCOPES.append(self)
        return self

    def __exit__(self, *error) -> None:
        _SCOPES.remove(self)

    def delete(self) -> None:
        while self.paths:
            _delete(self.spark, self.paths.pop())


_SCOPES: list[StagedTables] = []


@contextlib.contextmanager
def staged_tables(spark: SparkSession) -> Iterator[StagedTables]:
    """Delete at the end what is staged inside. Results have to be written, or collected, inside."""
    scope = StagedTables(spark)
    try:
        with scope:
            yield scope
    finally:
        scope.delete()
