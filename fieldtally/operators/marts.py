"""Reporting marts over the fact table, or over a fact folded to fewer rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.functions.rates import rate, share_true
from fieldtally.sources.tables import materialize

SERIES = ["country_name", "data_element_name"]


def reported_counts() -> list[Column]:
    return [F.count_if(F.col("has_reported_value")).alias("reported_rows"),
            F.count(F.lit(1)).alias("folded_rows")]


def reported_share(df: DataFrame) -> Column:
    """Share of the rows that reported, of a fact or of a folded fact."""
    if "folded_rows" in df.columns:
        return rate(F.sum("reported_rows"), F.sum("folded_rows"))
    return share_true("has_reported_value")


def monthly_totals(fact: DataFrame) -> DataFrame:
    """Sum of numeric values per country, data element and month."""
    return fact.groupBy(*SERIES, "year_month").agg(
        F.sum("numeric_value").alias("monthly_total"))


def month_index(year_month: Column) -> Column:
    return (F.substring(year_month, 1, 4).try_cast("int") * 12
            + F.substring(year_month, 5, 2).try_cast("int"))


def monthly_mom_change(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """Change against the previous reported month of the series, or against
    the previous calendar month (NULL after a gap) when ``calendar``."""
    totals = monthly_totals(fact)
    if calendar:
        window = Window.partitionBy(*SERIES).orderBy(
            month_index(F.col("year_month"))).rangeBetween(-1, -1)
        previous = F.first("monthly_total").over(window)
    else:
        previous = F.lag("monthly_total").over(
            Window.partitionBy(*SERIES).orderBy("year_month"))
    return totals.withColumn("previous_month_total", previous).withColumn(
        "mom_change", F.col("monthly_total") - F.col("previous_month_total"))


def rolling_3month_avg(fact: DataFrame, calendar: bool = False) -> DataFrame:
    """Average over up to three reported months, or over three calendar
    months when ``calendar``."""
    window = Window.partitionBy(*SERIES)
    if calendar:
        window = window.orderBy(month_index(F.col("year_month"))).rangeBetween(-2, 0)
    else:
        window = window.orderBy("year_month").rowsBetween(-2, 0)
    return monthly_totals(fact).withColumn(
        "rolling_3month_avg", F.avg("monthly_total").over(window))


def country_reporting_rate(fact: DataFrame, facility: str = "facility_name") -> DataFrame:
    """Facilities that reported over facilities with any row, per country and
    month.

    Rows fold to one per facility and month first, so both counts come from a
    small table instead of two distinct counts. ``facility`` may name an id
    column to keep facilities of equal name apart."""
    monthly = fact.groupBy("country_name", "year_month", facility).agg(
        F.max("has_reported_value").alias("reported"))
    return monthly.groupBy("country_name", "year_month").agg(
        F.count(F.when(F.col("reported"), F.col(facility))).alias("reporting_facilities"),
        F.count(facility).alias("expected_facilities"),
    ).withColumn("reporting_rate", F.round(
        F.try_divide("reporting_facilities", "expected_facilities"), 4))


def underreporting_facilities(fact: DataFrame, threshold: float = 0.50,
                              facility: str = "facility_name") -> DataFrame:
    return fact.groupBy("country_name", facility).agg(
        reported_share(fact).alias("reporting_score")
    ).filter(F.col("reporting_score") < threshold)


def quarterly_global_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("year", "quarter", "data_element_name").agg(
        F.sum("numeric_value").alias("quarterly_total"))


def completeness_comparison(fact: DataFrame) -> DataFrame:
    return fact.groupBy("country_name").agg(
        reported_share(fact).alias("completeness_score"))


def indicator_coverage_matrix(fact: DataFrame) -> DataFrame:
    """Coverage per country and indicator, in long form."""
    return fact.groupBy(*SERIES).agg(
        reported_share(fact).alias("coverage_score"))


def low_completeness_countries(fact: DataFrame, threshold: float = 0.70) -> DataFrame:
    return completeness_comparison(fact).filter(F.col("completeness_score") < threshold)


def fold_series(fact: DataFrame) -> DataFrame:
    """Sums and row counts per country, indicator and month; averages come from
    the counts, never from averages."""
    return fact.groupBy(*SERIES, "year", "quarter", "year_month").agg(
        F.sum("numeric_value").alias("numeric_value"), *reported_counts())


def fold_facilities(fact: DataFrame, facility: str = "facility_name") -> DataFrame:
    """Whether each facility reported in a month, and row counts."""
    return fact.groupBy("country_name", "year_month", facility).agg(
        F.max("has_reported_value").alias("has_reported_value"), *reported_counts())


def all_marts(fact: DataFrame) -> dict[str, DataFrame]:
    """The eight marts from two scans of the fact."""
    return marts_of_folds(materialize(fold_series(fact), "series"),
                          materialize(fold_facilities(fact), "facilities"))


def marts_of_folds(series: DataFrame, facilities: DataFrame) -> dict[str, DataFrame]:
    """The eight marts from the fact's folds alone. A fold holds no row that
    belongs to two months, so folds of single months can be kept and joined."""
    return {
        "monthly_mom_change": monthly_mom_change(series),
        "rolling_3month_avg": rolling_3month_avg(series),
        "country_reporting_rate": country_reporting_rate(facilities),
        "underreporting_facilities": underreporting_facilities(facilities),
        "quarterly_global_totals": quarterly_global_totals(series),
        "completeness_comparison": completeness_comparison(series),
        "indicator_coverage_matrix": indicator_coverage_matrix(series),
        "low_completeness_countries": low_completeness_countries(series),
    }
