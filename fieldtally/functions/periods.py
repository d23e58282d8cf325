"""Monthly periods, timestamps and reporting deadlines."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fieldtally.constants import LATE_REPORTING_DAYS

MONTH = "^[0-9]{4}(0[1-9]|1[0-2])$"


def period_start(period: Column) -> Column:
    """First day of a ``yyyyMM`` period; NULL when it names no month.

    Text is matched first, so the cast cannot fail and needs no formatter."""
    day_one = F.concat_ws("-", F.substring(period, 1, 4), F.substring(period, 5, 2), F.lit("01"))
    return F.when(period.rlike(MONTH), day_one.cast("date"))


def with_period_dates(df: DataFrame, period: str = "period") -> DataFrame:
    """Add year_month, period bounds, year, month and quarter."""
    start = period_start(F.col(period))
    return df.withColumns({
        "year_month": F.col(period),
        "period_start_date": start,
        "period_end_date": F.last_day(start),
        "year": F.year(start),
        "month": F.month(start),
        "quarter": F.quarter(start),
    })


def standardize_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Read text columns as timestamps in place; unreadable text becomes NULL."""
    def as_timestamp(name: str) -> Column:
        if isinstance(df.schema[name].dataType, StringType):
            return F.try_to_timestamp(F.col(name))
        return F.col(name).cast("timestamp")

    return df.withColumns({name: as_timestamp(name) for name in columns})


def with_deadline(df: DataFrame, days: int = LATE_REPORTING_DAYS) -> DataFrame:
    return df.withColumn("reporting_deadline", F.date_add("period_end_date", days))


def with_late_flag(df: DataFrame, days: int = LATE_REPORTING_DAYS,
                   period: str = "period") -> DataFrame:
    """Flag values updated after midnight at the start of the deadline day."""
    dated = with_deadline(with_period_dates(df, period), days)
    return dated.withColumn(
        "is_late_submission", F.col("lastupdated") > F.col("reporting_deadline"))
