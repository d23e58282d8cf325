"""Latest row per key, with a total order so that ties always fall the same way."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fieldtally.sources.tables import materialize

HOT_SHARE = 1e-3
HOT_ROWS = 10_000
#: Largest broadcast of winners; beyond it they are copied to so many salts.
WINNER_BYTES = 16 * 1024 * 1024
SALTS = 64


def recency_order(df: DataFrame, newest: list[str], keys: list[str]) -> list[str]:
    """Columns that decide which row is latest: ``newest`` first, then every
    other column outside the key."""
    return newest + [name for name in df.columns if name not in newest + keys]


def newest_first(keys: list[str], order: list[str]) -> WindowSpec:
    descending = [F.desc_nulls_last(name) for name in order] or [F.lit(1)]
    return Window.partitionBy(*keys).orderBy(*descending)


def rank_newest(keys: list[str], order: list[str]) -> Column:
    """Position within the key, largest ordering first."""
    return F.row_number().over(newest_first(keys, order))


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Keep one row per key: the largest by ``newest``, then by the other columns.

    The rank filter lets Spark drop losers before the shuffle, so a key that
    holds much of the table sends one row per input partition."""
    rank = rank_newest(keys, recency_order(df, newest, keys))
    return df.withColumn("latest_rank", rank).filter("latest_rank = 1").drop("latest_rank")


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, least: int = HOT_ROWS,
             tracked: int = 16_384) -> list[int]:
    """Hashes of the keys with more than ``share`` of the rows and ``least`` rows.

    A frequent-items sketch per group of input partitions, then one sketch over
    those; at most 1 / ``share`` keys can hold that much, so no more hashes come
    back however large the input is. They only steer how rows are spread: no
    result depends on them."""
    top = min(tracked, math.ceil(1 / share))
    sketches = df.select(key_hash(keys).alias("key_hash")).groupBy(
        F.pmod(F.spark_partition_id(), F.lit(256)).alias("slice")
    ).agg(
        F.expr(f"approx_top_k_accumulate(key_hash, {tracked})").alias("sketch"),
        F.count(F.lit(1)).alias("slice_rows"),
    )
    # grouped by a constant, because the sketch cannot be combined from no rows
    totals = sketches.groupBy(F.lit(1).alias("all_slices")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch), {top})").alias("items"),
        F.sum("slice_rows").alias("row_count"),
    )
    found = totals.select("row_count", F.inline("items").alias("item", "item_rows")).filter(
        F.col("item_rows") > F.greatest(F.col("row_count") * share, F.lit(least)))
    return [row.item for row in found.collect()]


def mark_latest(df: DataFrame, keys: list[str], newest: list[str],
                hot: list[int] | None = None) -> DataFrame:
    """Add ``is_latest``: true for the latest row per key, false for the rest.
    Rows must be distinct.

    Ordinary keys are ranked in a window. Keys in ``hot`` (found in ``df`` if
    not given) get their winner from a map-side combined maximum instead; their
    rows spread over all partitions and compare themselves with it."""
    hot = hot_keys(df, keys) if hot is None else hot
    order = recency_order(df, newest, keys)
    if not hot:
        return df.withColumn("is_latest", rank_newest(keys, order) == 1)
    rows = with_hot_winner(df, keys, order, hot)
    is_hot = F.col("winner").isNotNull()
    salted = rows.withColumn("salt", F.when(is_hot, F.xxhash64(*df.columns)).otherwise(F.lit(0)))
    return salted.withColumn(
        "is_latest",
        F.when(is_hot, F.struct(*order).eqNullSafe(F.col("winner")))
        .otherwise(rank_newest(keys + ["salt"], order) == 1),
    ).select(*df.columns, "is_latest")


def fold_latest(df: DataFrame, keys: list[str], newest: list[str], copies: str = "copies",
                hot: list[int] | None = None, meet: str | None = None) -> DataFrame:
    """Distinct rows with the number of their ``copies`` and ``is_latest``, from one
    shuffle of ``df``. It is read more than once, so it should be a written table.

    ``meet`` names a column of the key. Unless one of its values holds much of the
    table, rows are dealt by it alone, so a join by it need not move them again; and
    then no key is hot either. They are sorted by it first, as that join wants them.

    Rows of ordinary keys meet by key: equal rows are neighbours in the order that
    ranks them, so one window counts and ranks them. Rows of keys in ``hot`` (found
    in ``df`` if not given) fold before their shuffle, which spreads them by all
    columns, and compare themselves with the winner of their key."""
    if hot is None and meet and not hot_keys(df, [meet]):
        df, hot = df.repartition(meet), []
    hot = hot_keys(df, keys) if hot is None else hot
    order = recency_order(df, newest, keys)
    first = [meet] if meet else []
    by_key = newest_first(first + [name for name in keys if name not in first], order)
    is_hot = key_hash(keys).isin(hot)
    placed = (df.filter(~is_hot) if hot else df).select(
        "*", F.row_number().over(by_key).alias("fold_place"), F.rank().over(by_key).alias("fold_first"),
        F.count(F.lit(1)).over(by_key.rangeBetween(Window.currentRow, Window.currentRow)).alias(copies))
    folded = placed.filter("fold_place = fold_first").select(
        *df.columns, copies, (F.col("fold_place") == 1).alias("is_latest"))
    if not hot:
        return folded
    loud = df.filter(is_hot)
    rows = with_hot_winner(
        loud.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies)), keys, order, hot, loud)
    return folded.union(rows.select(
        *df.columns, copies, F.struct(*order).eqNullSafe(F.col("winner")).alias("is_latest")))


def with_hot_winner(df: DataFrame, keys: list[str], order: list[str],
                    hot: list[int], among: DataFrame | None = None) -> DataFrame:
    """Attach the largest ordering of its key to each row of a hot key. It is sought
    in ``among``, if given: a frame of the same rows that is cheaper to read.

    The winners are one row per hot key, at most 1 / ``HOT_SHARE`` of them. They are
    written and their bytes measured; if long texts make them too large for a
    broadcast, the join shuffles by a key and a salt, so a hot key still spreads."""
    rows = df.withColumn("key_hash", key_hash(keys))
    held = rows if among is None else among.withColumn("key_hash", key_hash(keys))
    winners = held.filter(F.col("key_hash").isin(hot)).groupBy(
        *[F.col(name).alias(f"hot_{name}") for name in keys]
    ).agg(F.max(F.struct(*order)).alias("winner"))
    winners = winners.withColumn("hot_hash", key_hash([f"hot_{name}" for name in keys]))
    same_key = F.col("key_hash") == F.col("hot_hash")
    for name in keys:
        same_key = same_key & F.col(name).eqNullSafe(F.col(f"hot_{name}"))
    winners = materialize(winners, "winners")
    size = winners.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= WINNER_BYTES:
        return rows.join(F.broadcast(winners), same_key, "left")
    spread = winners.withColumn("hot_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("row_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    joined = salted.join(spread, same_key & (F.col("row_salt") == F.col("hot_salt")), "left")
    return joined.drop("row_salt", "hot_salt")
