"""Data-quality job, profiles, rates and row counts."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldtally.constants import BUSINESS_KEY, QUALITY_COLUMNS
from fieldtally.functions.casts import (
    with_completeness_flags, with_missing_flags, with_typed_values,
)
from fieldtally.functions.columns import present, select_existing
from fieldtally.functions.periods import with_late_flag
from fieldtally.functions.rates import rate
from fieldtally.operators.dedup import collapse_copies, expand_copies
from fieldtally.operators.latest import fold_latest
from fieldtally.sources.tables import materialize

CLEAN = "clean"
EXACT = "exact_duplicates"
SUPERSEDED = "superseded_records"


class QualityResult(NamedTuple):
    clean: DataFrame
    exact_duplicates: DataFrame
    superseded: DataFrame


def prune_columns(df: DataFrame, columns: list[str] = QUALITY_COLUMNS) -> DataFrame:
    """Keep the columns that define an identical row."""
    return select_existing(df, columns)


def with_value_flags(df: DataFrame) -> DataFrame:
    """Typed values, missing, late and completeness flags."""
    return with_completeness_flags(with_late_flag(with_missing_flags(with_typed_values(df))))


def judge(rows: DataFrame, keys: list[str] = BUSINESS_KEY, timestamp: str = "lastupdated",
          copies: str = "copies", hot: list[int] | None = None,
          meet: str | None = None) -> DataFrame:
    """Distinct rows of a written table with their number of copies and ``outcome``:
    the latest row per key is clean, the others are superseded. ``meet`` is a column
    of the key to join by later (``fold_latest``)."""
    newest = [timestamp] + present(rows, ["created", "value"])
    marked = fold_latest(rows, keys, newest, copies, hot, meet)
    outcome = F.when(F.col("is_latest"), CLEAN).otherwise(SUPERSEDED)
    return marked.withColumn("outcome", outcome).drop("is_latest")


def surplus_copies(judged: DataFrame, copies: str = "copies") -> DataFrame:
    """Copies beyond the first of the rows that passed resolution."""
    passed = F.col("outcome").isin(CLEAN, SUPERSEDED)
    return judged.filter((F.col(copies) > 1) & passed).withColumn(
        copies, F.col(copies) - 1).drop("outcome")


def run_quality(df: DataFrame, keys: list[str] = BUSINESS_KEY,
                attach: Callable[[DataFrame], DataFrame] | None = None,
                meet: str | None = None) -> QualityResult:
    """Prune, set exact and superseded duplicates apart, then type and flag.

    ``attach`` adds attributes that the business key alone decides and may drop
    keys it does not resolve. It runs after the ranking, so its shuffle moves the
    columns of ``df`` only, and gives what ranking rows with attributes would: they
    are equal within a key. It sees the columns ``copies`` and ``outcome`` and
    must keep them and the number of rows of a key it resolves. ``meet`` is a column
    of the key that it joins by and that many rows share (``fold_latest``)."""
    judged = judge(materialize(prune_columns(df), "raw"), keys, meet=meet)
    if attach:
        judged = attach(judged)
    rows = present(judged, QUALITY_COLUMNS)
    judged = judged.select(*rows, "copies", "outcome")
    return QualityResult(
        clean=with_value_flags(judged.filter(F.col("outcome") == CLEAN).select(*rows)),
        exact_duplicates=expand_copies(surplus_copies(judged)),
        superseded=judged.filter(F.col("outcome") == SUPERSEDED).select(*rows),
    )


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count, NULL count and NULL rate per column, in one pass."""
    columns = columns or df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )
    per_column = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_count"))
        for name in columns
    ])
    return counts.select("row_count", F.inline(per_column)).select(
        "column_name", "row_count", "null_count",
        rate(F.col("null_count"), F.col("row_count")).alias("null_rate"),
    )


def row_count(df: DataFrame) -> int:
    return df.count()


def null_count(df: DataFrame, column: str) -> int:
    return df.agg(F.count_if(F.col(column).isNull())).first()[0]


def null_rate(df: DataFrame, column: str) -> float:
    return df.agg(rate(F.count_if(F.col(column).isNull()), F.count(F.lit(1)))).first()[0]


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Rows, surplus copies and their rate."""
    counted = collapse_copies(df)
    totals = counted.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    return totals.withColumn(
        "duplicate_rate", rate(F.col("duplicate_rows"), F.col("total_rows")))


def completeness_score(df: DataFrame, reported: str = "has_reported_value") -> DataFrame:
    """Reported rows over all rows; 0.0 for an empty table."""
    return df.agg(
        F.count_if(F.col(reported)).alias("reported_count"),
        F.count(F.lit(1)).alias("expected_count"),
    ).withColumn("completeness_score", rate(F.col("reported_count"), F.col("expected_count")))


def observe_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while another action runs."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
