"""Exact and latest-wins duplicates; every input row lands in one output."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldtally.constants import BUSINESS_KEY
from fieldtally.functions.columns import present
from fieldtally.operators.latest import mark_latest
from fieldtally.sources.tables import materialize

CHUNK = 65_536


def column_named(df: DataFrame, name: str) -> str:
    """The frame's own spelling of ``name``, compared without case."""
    found = [held for held in df.columns if held.lower() == name.lower()]
    if not found:
        raise ValueError(f"The frame has no column like '{name}'")
    return found[0]


def collapse_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """One row per distinct row with the number of its copies.

    Copies merge before the shuffle, so a row repeated through a third of the
    table never meets in one task."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def written_copies(df: DataFrame, copies: str = "copies") -> tuple[DataFrame, int]:
    """``collapse_copies`` written, and the largest number of copies, seen while
    writing."""
    seen = Observation("copies")
    counted = materialize(
        collapse_copies(df, copies).observe(seen, F.max(copies).alias("most")), "counted")
    return counted, seen.get["most"] or 0


def expand_copies(df: DataFrame, copies: str = "copies", most: int | None = None) -> DataFrame:
    """Repeat each row ``copies`` times; zero or less gives none. ``most``, if
    known, is the largest number there is.

    Rows of up to ``CHUNK`` copies multiply where they are, without a shuffle.
    Larger counts are cut into chunks that are spread over the cluster before
    they multiply. The partition number is set because the chunks weigh next to
    nothing until then and would be merged again."""
    columns = [name for name in df.columns if name != copies]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = df.filter((F.col(copies) > 0) & (F.col(copies) <= CHUNK)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    if most is not None and most <= CHUNK:
        return few.select(*columns)
    chunks = df.filter(F.col(copies) > CHUNK).withColumn(
        "chunk", F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) div {CHUNK})"))
    )
    spread = chunks.repartition(partitions, F.xxhash64(*columns), F.col("chunk"))
    left = F.col(copies) - F.col("chunk") * CHUNK
    many = spread.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least(left, F.lit(CHUNK)).cast("int"))))
    return few.select(*columns).union(many.select(*columns))


def remove_exact_duplicates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct rows, surplus copies): n equal rows give one and n - 1. Copies
    are folded once, for both."""
    counted, most = written_copies(df)
    surplus = counted.filter("copies > 1").withColumn("copies", F.col("copies") - 1)
    return counted.select(*df.columns), expand_copies(surplus, most=most)


def resolve_near_duplicates(
    df: DataFrame, keys: list[str] = BUSINESS_KEY, timestamp: str = "lastupdated",
) -> tuple[DataFrame, DataFrame]:
    """(latest row per key, superseded rows). Names match without case.

    Ties on the timestamp fall to created, value and then the other columns."""
    held = {name.lower() for name in df.columns}
    absent = [name for name in keys if name.lower() not in held]
    if absent:
        raise ValueError(f"Key columns are absent: {absent}")
    keys = [column_named(df, name) for name in keys]
    newest = [column_named(df, timestamp)]
    newest += [name for name in present(df, ["created", "value"]) if name not in newest + keys]
    counted, most = written_copies(df)
    marked = mark_latest(counted, keys, newest + [
        name for name in df.columns if name not in newest + keys])
    latest = marked.filter("is_latest").select(*df.columns)
    superseded = marked.withColumn(
        "copies", F.col("copies") - F.col("is_latest").cast("long"))
    return latest, expand_copies(superseded.select(*df.columns, "copies"), most=most)
