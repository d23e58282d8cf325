"""Resolve coded values against lookup tables, keeping the unresolved rows."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.functions.columns import present
from fieldtally.operators.latest import hot_keys, key_hash, latest_per_key
from fieldtally.sources.tables import materialize_measured

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
RECENCY = ["lastupdated", "created"]


class Resolution(NamedTuple):
    resolved: DataFrame
    unresolved: DataFrame


def small_enough(rows: int, size: int, max_rows: int = MAX_BROADCAST_ROWS,
                 max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, name: str = "lookup", **limits: int) -> DataFrame:
    """Write the frame once, measured, and hint a broadcast if it proves small.

    Anything larger joins by shuffle, where adaptive execution splits the
    partitions of hot keys."""
    written, small = written_lookup(df, name, **limits)
    return F.broadcast(written) if small else written


def written_lookup(df: DataFrame, name: str = "lookup", **limits: int) -> tuple[DataFrame, bool]:
    """The frame as written, and whether it is small enough to be broadcast."""
    written, rows, size = materialize_measured(df, name)
    return written, small_enough(rows, size, **limits)


def lookup_table(table: DataFrame, key: str, attributes: dict[str, str],
                 key_name: str = "lookup_key", **limits: int) -> DataFrame:
    """One row per key (the most recent), attributes renamed, broadcast if small.

    ``attributes`` maps new names to columns of ``table``. The result is a
    written table, so every use of it is a plain scan."""
    return broadcast_if_small(one_per_key(table, key, attributes, key_name), "lookup", **limits)


def one_per_key(table: DataFrame, key: str, attributes: dict[str, str],
                key_name: str = "lookup_key") -> DataFrame:
    recency = present(table, RECENCY)
    chosen = table.select(
        F.col(key).alias(key_name),
        *[F.col(source).alias(name) for name, source in attributes.items()],
        *[F.col(name).alias(f"lookup_{name}") for name in recency],
    ).filter(F.col(key_name).isNotNull())
    unique = latest_per_key(chosen, [key_name], [f"lookup_{name}" for name in recency])
    return unique.select(key_name, *attributes)


def attach(df: DataFrame, on: str, lookup: DataFrame, key_name: str = "lookup_key",
           matched: str | None = None) -> DataFrame:
    """Left join a table made by ``lookup_table``; ``matched`` names an
    optional flag that tells a missing key from a NULL attribute."""
    joined = df.join(lookup, F.col(on) == F.col(key_name), "left")
    if matched:
        joined = joined.withColumn(matched, F.col(key_name).isNotNull())
    return joined.drop(key_name)


def attach_spread(df: DataFrame, on: str, lookup: DataFrame, hot: list[int],
                  key_name: str = "lookup_key", matched: str | None = None) -> DataFrame:
    """``attach`` for a lookup too large to broadcast, where the keys in ``hot``
    (``hot_keys``) hold much of ``df``, known to the lookup or not.

    Their rows stay where they are and meet their few lookup rows by broadcast, so
    no task sorts a hot key; the others meet by shuffle. ``df`` is read twice."""
    is_hot = key_hash([on]).isin(hot)
    few, small = written_lookup(lookup.filter(key_hash([key_name]).isin(hot)), "hot_lookup")
    if not hot or not small:
        return attach(df, on, lookup, key_name, matched)
    return attach(df.filter(is_hot), on, F.broadcast(few), key_name, matched).union(
        attach(df.filter(~is_hot), on, lookup, key_name, matched))


def split_by(df: DataFrame, required: str) -> Resolution:
    """Rows with and without the looked-up attribute."""
    return Resolution(df.filter(F.col(required).isNotNull()),
                      df.filter(F.col(required).isNull()))


def resolve(df: DataFrame, table: DataFrame, on: str, attributes: dict[str, str],
            required: str, key: str = "id", matched: str | None = None,
            spread: bool = False, **limits: int) -> Resolution:
    """Attach attributes by key and split on whether ``required`` was found.

    A key that exists with a NULL ``required`` attribute is unresolved too. With
    ``spread``, keys that hold much of ``df`` are found and spread if the lookup is
    too large to broadcast. That reads ``df`` once more, so it should be a table
    that is cheap to read."""
    lookup, small = written_lookup(one_per_key(table, key, attributes), **limits)
    if small:
        found = attach(df, on, F.broadcast(lookup), matched=matched)
    elif spread:
        found = attach_spread(df, on, lookup, hot_keys(df, [on]), matched=matched)
    else:
        found = attach(df, on, lookup, matched=matched)
    return split_by(found, required)


def reject_reason(required: dict[str, str]) -> Column:
    """First reason whose attribute is NULL, in the order given; NULL if none.

    ``required`` maps reason to attribute."""
    return F.coalesce(*[F.when(F.col(name).isNull(), F.lit(reason))
                        for reason, name in required.items()])
