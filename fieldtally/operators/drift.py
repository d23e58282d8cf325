"""Differences between two snapshots of a keyed table."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from fieldtally.functions.columns import present
from fieldtally.operators.latest import latest_per_key
from fieldtally.operators.lookup import RECENCY


def added(current: DataFrame, reference: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key the reference snapshot lacks."""
    return current.join(reference.select(key), key, "left_anti")


def removed(current: DataFrame, reference: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key the current snapshot lacks."""
    return added(reference, current, key)


def renamed(current: DataFrame, reference: DataFrame, key: str = "id",
            name: str = "name", null_safe: bool = False) -> DataFrame:
    """(key, old_name, new_name) where the name differs between snapshots.

    Each snapshot counts once per key, with its most recent row. A NULL name is
    reported only when ``null_safe``."""
    def names(df: DataFrame, alias: str) -> DataFrame:
        recency = present(df, RECENCY)
        chosen = df.select(key, F.col(name).alias(alias), *recency)
        return latest_per_key(chosen, [key], recency).select(key, alias)

    pairs = names(reference, "old_name").join(names(current, "new_name"), key)
    same = F.col("new_name").eqNullSafe(F.col("old_name"))
    differs = ~same if null_safe else F.col("new_name") != F.col("old_name")
    return pairs.filter(differs).select(key, "old_name", "new_name")


def snapshot_diff(current: DataFrame, reference: DataFrame, key: str = "id",
                  ignored: list[str] = RECENCY) -> DataFrame:
    """One row per key of either snapshot: ``status`` (added, removed, changed or
    same), the ``changes`` of its attributes (NULL-safe) and its rows.

    Each snapshot counts once per key, with its most recent row; rows without a
    key are in no other snapshot. Ranking drops older rows before the shuffle and
    leaves each snapshot partitioned by key, so the join moves no row again."""
    def latest(df: DataFrame, alias: str) -> DataFrame:
        recency = present(df, RECENCY)
        ranked = df.select(F.col(key).alias("diff_key"), F.struct(*df.columns).alias(alias), *[
            F.col(name).alias(f"recency_{name}") for name in recency])
        return latest_per_key(ranked, ["diff_key"], [f"recency_{name}" for name in recency]).select(
            "diff_key", alias)

    shared = [name for name in present(current, reference.columns) if name not in [key, *ignored]]
    old, new = "reference_row", "current_row"
    both = latest(current, new).join(latest(reference, old), "diff_key", "full_outer")

    def text(df: DataFrame, side: str, name: str) -> Column:
        whole = F.col(f"{side}.{name}")
        nested = isinstance(df.schema[name].dataType, (StructType, ArrayType, MapType))
        return F.to_json(whole) if nested else whole.cast("string")

    changes = F.filter(F.array(*[
        F.struct(F.lit(name).alias("attribute"), text(reference, old, name).alias("old_value"),
                 text(current, new, name).alias("new_value")) for name in shared]),
        lambda change: ~change["old_value"].eqNullSafe(change["new_value"]),
    ) if shared else F.array().cast("array<struct<attribute:string,old_value:string,new_value:string>>")
    status = F.when(F.col(old).isNull(), "added").when(F.col(new).isNull(), "removed").when(
        F.size("changes") > 0, "changed").otherwise("same")
    return both.withColumn("changes", F.when(
        F.col(old).isNotNull() & F.col(new).isNotNull(), changes)).withColumn("status", status)


def drift_tables(diff: DataFrame, key: str = "id", name: str = "name") -> dict[str, DataFrame]:
    """The tables of a diff: added and removed rows, renamed rows, and every other
    change of an attribute. A name that was or became NULL is a change, no new
    name."""
    change = diff.filter(F.col("status") == "changed").select(
        F.col("diff_key").alias(key), F.inline("changes"))
    is_name = (F.col("attribute") == name) & F.col("old_value").isNotNull() & F.col("new_value").isNotNull()
    return {
        "added_data_elements": diff.filter(F.col("status") == "added").select("current_row.*"),
        "removed_data_elements": diff.filter(F.col("status") == "removed").select("reference_row.*"),
        "renamed_data_elements": change.filter(is_name).select(
            key, F.col("old_value").alias("old_name"), F.col("new_value").alias("new_name")),
        "changed_data_elements": change.filter(~is_name),
    }


def snapshot_drift(current: DataFrame, reference: DataFrame,
                   key: str = "id", name: str = "name") -> dict[str, DataFrame]:
    return {
        "added_data_elements": added(current, reference, key),
        "removed_data_elements": removed(current, reference, key),
        "renamed_data_elements": renamed(current, reference, key, name),
    }


def drift_summary(drift: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of every drift table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("label"), "rows")
        for label, df in drift.items()
    ]
    return reduce(DataFrame.unionByName, counts).agg(*[
        F.sum(F.when(F.col("label") == label, F.col("rows"))).alias(label) for label in drift
    ])
