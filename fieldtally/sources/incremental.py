"""Load only periods the published fact does not hold yet."""

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldtally.constants import FACT_PARTITION, PERIOD_COLUMNS
from fieldtally.operators.lookup import small_enough
from fieldtally.operators.quality import EXACT, SUPERSEDED
from fieldtally.sources.publish import folder_names
from fieldtally.sources.tables import materialize, materialize_measured

STATISTICS = """
    year_month string, period_start_date date, period_end_date date, year int, month int,
    quarter int, row_count long, lastupdated timestamp
"""


def read_fact(spark: SparkSession, path: str, partition: str = FACT_PARTITION) -> DataFrame | None:
    """The published fact with its partition column as text; None before the
    first run."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    # a stated type keeps partition values as they are written, leading zeros too
    stated = StructType([StructField(field.name, StringType()) if field.name == partition else field
                         for field in found.fields])
    return spark.read.schema(stated).parquet(path)


def loaded_periods(spark: SparkSession, path: str, partition: str = FACT_PARTITION) -> DataFrame:
    """Periods of the published fact; reads partition values only, no columns."""
    fact = read_fact(spark, path, partition)
    if fact is None:
        return spark.createDataFrame([], f"{partition} string")
    return fact.select(partition).distinct()


def new_periods(df: DataFrame, loaded: DataFrame, partition: str = FACT_PARTITION,
                keep_null: bool = False) -> DataFrame:
    """Rows of periods not loaded yet. Rows without a period stay if
    ``keep_null`` and go otherwise, whether or not anything is loaded."""
    written, rows, size = materialize_measured(loaded, "periods")
    dated = df if keep_null else df.filter(F.col(partition).isNotNull())
    if rows == 0:
        return dated
    known = F.broadcast(written) if small_enough(rows, size) else written
    return dated.join(known, partition, "left_anti").select(*df.columns)


def changed_periods(df: DataFrame, fact: DataFrame, partition: str = FACT_PARTITION) -> DataFrame:
    """Loaded periods for which ``df`` brings a later update than the fact has.
    The statistics of a fact serve as well as the fact."""
    incoming = df.groupBy(partition).agg(F.max("lastupdated").alias("incoming"))
    stored = fact.groupBy(partition).agg(F.max("lastupdated").alias("stored"))
    return incoming.join(stored, partition).filter("incoming > stored").select(partition)


def partition_statistics(fact: DataFrame, partition: str = FACT_PARTITION) -> DataFrame:
    """Per period of a fact: its dates, rows and greatest lastupdated."""
    dates = [name for name in PERIOD_COLUMNS if name != partition]
    return fact.groupBy(partition).agg(
        *[F.first(name).alias(name) for name in dates], F.count(F.lit(1)).alias("row_count"),
        F.max("lastupdated").alias("lastupdated"))


def stored_statistics(spark: SparkSession, fact_path: str, path: str,
                      partition: str = FACT_PARTITION) -> DataFrame:
    """The statistics kept beside a fact, or counted anew where they are lost or
    name other periods than the fact has folders. Only names are listed for
    that, no file of the fact is opened."""
    held = read_fact(spark, path, partition)
    folders = {unquote(name.split("=", 1)[1]) for name in folder_names(spark, fact_path) if "=" in name}
    if held is not None and {row[0] for row in held.select(partition).collect()} == folders:
        return held
    fact = read_fact(spark, fact_path, partition)
    if fact is None:
        return spark.createDataFrame([], STATISTICS)
    return materialize(partition_statistics(fact, partition), "statistics")


def replace_periods(stored: DataFrame, fresh: DataFrame, touched: list[str],
                    partition: str = FACT_PARTITION) -> DataFrame:
    """``fresh`` and the rows of ``stored`` of other periods; as a filter on the
    partition column it leaves the files of touched periods unread."""
    kept = stored.filter(~F.col(partition).isin(touched)) if touched else stored
    return kept.select(*fresh.columns).unionByName(fresh)


KEPT, REPEATED, STALE, REPLACED = "kept", EXACT, SUPERSEDED, "replaced_records"


def merge_stored(sent: DataFrame, stored: DataFrame, grain: list[str],
                 newest: list[str]) -> DataFrame:
    """``sent`` and ``stored`` rows with ``merge_outcome``: per grain the newest is
    kept. The other is quarantined: a stored row that was replaced, or a sent row
    that is stale, or repeats the stored row in every column of ``newest``.

    Each side holds one row per grain, so no key gathers more than two rows.
    NULLs count as oldest."""
    def side(df: DataFrame, is_stored: bool) -> DataFrame:
        return df.withColumn("is_stored", F.lit(is_stored))

    both = side(sent, False).unionByName(side(stored, True), allowMissingColumns=True)
    by_grain = Window.partitionBy(*grain)
    order = by_grain.orderBy(*[F.desc_nulls_last(name) for name in newest], F.desc("is_stored"))
    same = F.count(F.lit(1)).over(by_grain.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)) > 1
    for name in newest:
        same = same & F.col(name).eqNullSafe(F.lag(name).over(order))
    ranked = both.withColumn("merge_rank", F.row_number().over(order)).withColumn("is_same", same)
    outcome = F.when(F.col("merge_rank") == 1, KEPT).when(F.col("is_stored"), REPLACED).when(
        F.col("is_same"), REPEATED).otherwise(STALE)
    return ranked.withColumn("merge_outcome", outcome).drop("merge_rank", "is_same", "is_stored")


def load_required(df: DataFrame) -> bool:
    return not df.isEmpty()
