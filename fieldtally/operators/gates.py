"""Quarantine accounting and the gate a run must pass before it publishes."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.constants import MAX_QUARANTINE_RATE, MIN_FACT_ROWS
from fieldtally.functions.rates import rate
from fieldtally.operators.dedup import expand_copies
from fieldtally.operators.quality import CLEAN, EXACT, SUPERSEDED


class GateError(RuntimeError):
    """A run failed a critical check."""


def quarantine_union(buckets: dict[str, DataFrame]) -> DataFrame:
    """All rejected rows in one table, with the bucket as ``reason``; columns
    a bucket lacks are NULL."""
    return reduce(
        lambda one, other: one.unionByName(other, allowMissingColumns=True),
        [df.withColumn("reason", F.lit(reason)) for reason, df in buckets.items()],
    )


def quarantine_rows(judged: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row of a judged table that is not clean, as often as it was sent, with
    its ``reason``: one scan.

    Copies beyond the first of a row that passed resolution are exact duplicates.
    Only if a row has more copies than ``CHUNK`` such rows are read once more, and
    spread before they multiply."""
    kept = F.col("outcome").isin(CLEAN, SUPERSEDED)
    parts = F.array(
        F.struct(F.col("outcome").alias("reason"),
                 F.when(F.col("outcome") == CLEAN, 0).when(kept, 1)
                 .otherwise(F.col(copies)).cast("long").alias("times")),
        F.struct(F.lit(EXACT).alias("reason"),
                 F.when(kept, F.col(copies) - 1).otherwise(0).cast("long").alias("times")))
    columns = [name for name in judged.columns if name not in ("outcome", copies)]
    # most rows are clean and were sent once: they go before anything is made of them
    rejects = judged.filter(~F.col("outcome").eqNullSafe(CLEAN) | (F.col(copies) > 1))
    rows = rejects.select(*columns, F.inline(parts)).filter("times > 0")
    return expand_copies(rows, "times", judged.agg(F.max(copies)).first()[0] or 0)


def outcome_counts(judged: DataFrame, copies: str = "copies") -> DataFrame:
    """Rows per outcome of a judged table: copies beyond the first of a row
    that passed resolution are exact duplicates."""
    per_outcome = judged.groupBy("outcome").agg(
        F.sum(copies).alias("all_rows"), F.count(F.lit(1)).alias("kept_rows"))
    kept = F.col("outcome").isin(CLEAN, SUPERSEDED)
    parts = F.array(
        F.struct(F.col("outcome").alias("label"),
                 F.when(kept, F.col("kept_rows")).otherwise(F.col("all_rows")).alias("counted")),
        F.struct(F.lit(EXACT).alias("label"),
                 F.when(kept, F.col("all_rows") - F.col("kept_rows"))
                 .otherwise(F.lit(0)).alias("counted")),
    )
    return per_outcome.select(F.inline(parts)).groupBy(
        F.col("label").alias("outcome")).agg(F.sum("counted").alias("row_count"))


def quarantine_rate(counts: DataFrame) -> DataFrame:
    """Input rows, quarantined rows and their rate, from rows per outcome."""
    return counts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(F.col("outcome") != CLEAN, F.col("row_count"))),
                   F.lit(0)).alias("quarantine_rows"),
    ).withColumn("quarantine_rate", rate(F.col("quarantine_rows"), F.col("input_rows")))


def run_gates(counts: DataFrame, max_quarantine_rate: float = MAX_QUARANTINE_RATE,
              min_fact_rows: int = MIN_FACT_ROWS,
              max_unresolved_rate: float | None = None) -> DataFrame:
    """One row per critical check: observed value, limit and whether it passed.

    The check on unresolved codes is off unless it is given a limit."""
    def rows_where(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("row_count"))), F.lit(0))

    outcome = F.col("outcome")
    totals = counts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("input_rows"),
        rows_where(outcome != CLEAN).alias("quarantine_rows"),
        rows_where(outcome.startswith("unresolved_")).alias("unresolved_rows"),
        rows_where(outcome == CLEAN).alias("fact_rows"),
    )

    def check(name, observed, limit, passed):
        return F.struct(F.lit(name).alias("gate"), observed.cast("double").alias("observed"),
                        F.lit(float(limit)).alias("threshold"), passed.alias("passed"))

    quarantined = rate(F.col("quarantine_rows"), F.col("input_rows"))
    unresolved = rate(F.col("unresolved_rows"), F.col("input_rows"))
    checks = [
        check("max_quarantine_rate", quarantined, max_quarantine_rate,
              quarantined <= max_quarantine_rate),
        check("min_fact_rows", F.col("fact_rows"), min_fact_rows,
              F.col("fact_rows") >= min_fact_rows),
    ]
    if max_unresolved_rate is not None:
        checks.append(check("max_unresolved_rate", unresolved, max_unresolved_rate,
                            unresolved <= max_unresolved_rate))
    return totals.select(F.inline(F.array(*checks)))


def enforce_gates(gates: DataFrame) -> None:
    failed = gates.filter(~F.col("passed")).collect()
    if failed:
        raise GateError("; ".join(
            f"{row.gate}: {row.observed} against {row.threshold}" for row in failed))
