"""Totals by the aggregation type of the data element.

A sum suits counted cases only: percentages average, stocks keep their last
value. Per country, element and month a fold holds states that merge exactly
(sum, count, least, greatest), so quarters, years and countries roll up from it
without the fact and averages are never averaged. The type comes from the element
dimension and meets the fold, not the fact.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.operators.lookup import attach, lookup_table
from fieldtally.operators.marts import month_index

# Aggregation types with a rule of their own; all others add up.
AVERAGE_TYPES = ["AVERAGE", "AVERAGE_SUM_ORG_UNIT"]
LAST_TYPES = ["LAST", "LAST_IN_PERIOD"]
TYPED_SERIES = ["country_name", "data_element_name", "aggregationtype"]


def fold_measures(fact: DataFrame) -> DataFrame:
    """Mergeable states of the numeric values per country, element and month."""
    amount = F.col("numeric_value")
    return fact.groupBy("country_name", "data_element_id", "data_element_name", "year", "quarter",
                        "year_month").agg(
        F.sum(amount).alias("total"), F.count(amount).alias("counted"),
        F.min(amount).alias("least"), F.max(amount).alias("greatest"))


def with_types(folded: DataFrame, elements: DataFrame, key: str = "data_element_id",
               kind: str = "aggregationtype") -> DataFrame:
    """The fold with each element's aggregation type; SUM where none is known."""
    types = lookup_table(elements, key, {"element_type": kind})
    return attach(folded, "data_element_id", types).withColumn(
        "aggregationtype", F.coalesce("element_type", F.lit("SUM"))).drop("element_type")


def merged() -> list[Column]:
    return [F.sum("total").alias("total"), F.sum("counted").alias("counted"),
            F.min("least").alias("least"), F.max("greatest").alias("greatest")]


def measure(last: Column) -> Column:
    """The amount that the states stand for; ``last`` is the total of the last month."""
    kind = F.col("aggregationtype")
    return (F.when(kind.isin(AVERAGE_TYPES), F.try_divide("total", "counted"))
            .when(kind.isin(LAST_TYPES), last)
            .when(kind == "COUNT", F.col("counted").cast("double"))
            .when(kind == "MIN", F.col("least"))
            .when(kind == "MAX", F.col("greatest"))
            .otherwise(F.col("total")))


def roll_up(typed: DataFrame, by: list[str], amount: str) -> DataFrame:
    """One amount per group and aggregation type. The last month of a group is the
    last with a numeric value."""
    keys = [*by, "aggregationtype"]
    monthly = typed.groupBy(*dict.fromkeys([*keys, "year_month"])).agg(*merged())
    last = F.max(F.when(F.col("counted") > 0, F.struct("year_month", "total"))).alias("last_month")
    groups = monthly.groupBy(*keys).agg(*merged(), last)
    return groups.withColumn(amount, measure(F.col("last_month.total"))).select(*keys, amount)


def typed_monthly(typed: DataFrame) -> DataFrame:
    """Amount per country, element and month."""
    return roll_up(typed, ["country_name", "data_element_name", "year_month"], "monthly_amount")


def typed_quarterly(typed: DataFrame) -> DataFrame:
    """Amount per element and quarter over all countries."""
    return roll_up(typed, ["year", "quarter", "data_element_name"], "quarterly_amount")


def typed_mom_change(typed: DataFrame, calendar: bool = False) -> DataFrame:
    """Change of the monthly amount against the previous reported month, or the
    previous calendar month."""
    window = Window.partitionBy(*TYPED_SERIES)
    if calendar:
        previous = F.first("monthly_amount").over(
            window.orderBy(month_index(F.col("year_month"))).rangeBetween(-1, -1))
    else:
        previous = F.lag("monthly_amount").over(window.orderBy("year_month"))
    return typed_monthly(typed).withColumn("previous_amount", previous).withColumn(
        "mom_change", F.col("monthly_amount") - F.col("previous_amount"))


def typed_rolling(typed: DataFrame, months: int = 3) -> DataFrame:
    """Up to ``months`` reported months taken together: averages weigh every value
    alike, sums are divided by the months."""
    monthly = typed.groupBy(*TYPED_SERIES, "year_month").agg(*merged())
    window = Window.partitionBy(*TYPED_SERIES).orderBy("year_month").rowsBetween(1 - months, 0)
    kind = F.col("aggregationtype")
    states = monthly.select(
        *TYPED_SERIES, "year_month",
        F.sum("total").over(window).alias("total"), F.sum("counted").over(window).alias("counted"),
        F.min("least").over(window).alias("least"), F.max("greatest").over(window).alias("greatest"),
        F.last("total", ignorenulls=True).over(window).alias("last_total"),
        F.count("total").over(window).alias("months"))
    together = measure(F.col("last_total"))
    is_additive = ~kind.isin(*AVERAGE_TYPES, *LAST_TYPES, "MIN", "MAX")
    return states.withColumn("rolling_amount", F.when(
        is_additive, F.try_divide(together, F.col("months"))).otherwise(together)).select(
        *TYPED_SERIES, "year_month", "rolling_amount")


def typed_marts(measures: DataFrame, elements: DataFrame) -> dict[str, DataFrame]:
    """The marts over amounts, from the fold and the element dimension."""
    typed = with_types(measures, elements)
    return {
        "monthly_change_by_type": typed_mom_change(typed),
        "rolling_3month_by_type": typed_rolling(typed),
        "quarterly_by_type": typed_quarterly(typed),
    }
