"""Exact distinct counts that merge: facilities as bits.

Facilities get dense numbers, those of a country side by side. Per country, month
and run of 32 768 numbers two bitmaps say which facilities were expected and which
reported. Quarters, years or any other set of months are the union of their bitmaps,
so distinct counts roll up from a few kilobytes a country and month, without the
fact and without a distinct count.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.operators.lookup import small_enough
from fieldtally.sources.tables import materialize, materialize_measured

FACILITY = ["country_name", "facility_name"]


def number_facilities(facilities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """country_name, facility_name, number (from 0, dense); numbers in ``known`` stay
    and new facilities follow them.

    Sorted partitions are numbered each, and begin where the ones before end: only
    one row a partition meets in one task."""
    found = facilities.select(*FACILITY).where("facility_name is not null").distinct()
    first = 0
    if known is not None:
        same = [F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}")) for name in FACILITY]
        found = found.alias("new").join(known.alias("old"), same, "left_anti")
        first = known.count()
    placed = materialize(found.repartitionByRange(*FACILITY).select(
        *FACILITY, F.spark_partition_id().alias("part")), "facilities")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("held"))
    begins = sizes.select("part", (F.sum("held").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("begin"))
    within = Window.partitionBy("part").orderBy(*FACILITY)
    numbered = placed.join(F.broadcast(begins), "part").select(*FACILITY, (
        F.lit(first) + F.coalesce("begin", F.lit(0)) + F.row_number().over(within) - 1)
        .cast("long").alias("number"))
    return numbered if known is None else known.select(*numbered.columns).unionByName(numbered)


def reporting_bitmaps(facilities: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per country, month and bucket of numbers: who was expected, who reported.

    ``facilities`` is the fold of the fact by country, month and facility."""
    written, rows, size = materialize_measured(numbers.select(
        F.col("country_name").alias("numbered_country"), F.col("facility_name").alias("numbered_facility"),
        "number"), "numbers")
    side = F.broadcast(written) if small_enough(rows, size) else written
    same = F.col("country_name").eqNullSafe(F.col("numbered_country")) & (
        F.col("facility_name") == F.col("numbered_facility"))
    bit = F.bitmap_bit_position("number")
    return facilities.join(side, same).groupBy(
        "country_name", "year_month", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("expected"),
        F.bitmap_construct_agg(F.when(F.col("has_reported_value"), bit)).alias("reported"))


def quarter_of(year_month: Column) -> Column:
    quarter = F.ceil(F.substring(year_month, 5, 2).try_cast("int") / 3)
    return F.concat(F.substring(year_month, 1, 4), F.lit("Q"), quarter.cast("string"))


def year_of(year_month: Column) -> Column:
    return F.substring(year_month, 1, 4)


def reporting_rate_over(bitmaps: DataFrame, period: Column) -> DataFrame:
    """Facilities that reported in any month of a period over those expected in any."""
    united = bitmaps.groupBy("country_name", period.alias("period"), "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("reported")).alias("reported"),
        F.bitmap_count(F.bitmap_or_agg("expected")).alias("expected"))
    return united.groupBy("country_name", "period").agg(
        F.sum("reported").alias("reporting_facilities"),
        F.sum("expected").alias("expected_facilities"),
    ).withColumn("reporting_rate", F.round(
        F.try_divide("reporting_facilities", "expected_facilities"), 4))


def rate_marts(bitmaps: DataFrame) -> dict[str, DataFrame]:
    month = F.col("year_month")
    return {"quarterly_reporting_rate": reporting_rate_over(bitmaps, quarter_of(month)),
            "yearly_reporting_rate": reporting_rate_over(bitmaps, year_of(month))}
