"""Write and read back tables."""

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldtally.constants import FACT_PARTITION
from fieldtally.functions.columns import require_columns

#: How staged tables are compressed: smaller than the default, and as quick to read.
STAGED = "zstd"
run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: ``spark.checkpoint.dir``, or the
    warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of a path in any store Spark reaches."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses, below the folder of the run if there is one;
    it goes with the run, or when the application ends."""
    app = spark.sparkContext.applicationId
    folder = run_folder.get() or f"{shared_folder(spark)}/fieldtally-{app}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if not run_folder.get():
        system, target = hadoop_path(spark, path)
        system.deleteOnExit(target)
    return path


@contextmanager
def run_staging(spark: SparkSession) -> Iterator[str]:
    """Staged tables made inside are deleted at the end, on failure too."""
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/fieldtally-{app}/run-{uuid.uuid4().hex}"
    token = run_folder.set(folder)
    try:
        yield folder
    finally:
        run_folder.reset(token)
        system, target = hadoop_path(spark, folder)
        system.delete(target, True)


def side_by_side(work: Callable, items: list) -> list:
    """Run independent small jobs at the same time, in the same run."""
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return [job.result() for job in [
            pool.submit(copy_context().run, work, item) for item in items]]


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", max_records_per_file: int | None = None,
                  replace_all: bool = False, compression: str | None = None) -> None:
    """Write parquet; with partition columns an overwrite replaces only the
    partitions present in ``df``, unless ``replace_all``."""
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        scope = "static" if replace_all else "dynamic"
        writer = writer.option("partitionOverwriteMode", scope).partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_like(df: DataFrame, path: str) -> DataFrame:
    """Read a table written from ``df`` with the schema of ``df``, so that
    partition columns keep their type and column order is unchanged."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                path: str | None = None) -> DataFrame:
    """Write to a path of this run and read back, cutting the lineage.

    Each call has its own path: rows of earlier runs are never read back, and
    the table outlives lost executors."""
    path = path or scratch_path(df.sparkSession, name)
    write_parquet(df, path, partition_by, compression=STAGED)
    return read_like(df, path)


def materialize_measured(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """Materialize and return (table, rows, bytes): text counts its length,
    every other cell eight. Both are counted while the table is written."""
    size = Observation(name)
    width = sum((F.coalesce(F.octet_length(column), F.lit(0)) if kind == "string" else F.lit(8)
                 for column, kind in df.dtypes), F.lit(0))
    written = materialize(df.observe(
        size, F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes")), name)
    return written, size.get["rows"], size.get["bytes"]


def write_fact(fact: DataFrame, path: str, partition_by: list[str] = [FACT_PARTITION],
               max_records_per_file: int | None = None) -> None:
    """Publish the fact by partition, replacing only the partitions it brings.

    The rebalance gathers each partition into few files and lets adaptive
    execution split a partition that holds much of the table."""
    require_columns(fact, partition_by, "fact")
    balanced = fact.hint("rebalance", *[F.col(name) for name in partition_by])
    write_parquet(balanced, path, partition_by, max_records_per_file=max_records_per_file)


def write_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write named tables below a folder (dimensions, marts, drift) and return
    them as read back."""
    written = {}
    for name, df in tables.items():
        path = f"{folder}/{name}"
        write_parquet(df, path)
        written[name] = read_like(df, path)
    return written


def run_metrics(spark: SparkSession, completed_at: Column | None = None,
                status: str = "success", **rows: int) -> DataFrame:
    """One row for a finished run: status, completion time and row counts."""
    completed = F.current_timestamp() if completed_at is None else completed_at
    return spark.range(1).select(
        F.lit(status).alias("status"),
        completed.alias("completed_at_utc"),
        *[F.lit(count).cast("bigint").alias(name) for name, count in rows.items()],
    )


def append_run_metrics(metrics: DataFrame, path: str) -> None:
    write_parquet(metrics, path, mode="append")
