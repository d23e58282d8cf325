"""Typed values and value flags; nothing here throws under ANSI mode."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.constants import BOOLEAN_TYPES, FLOAT_TYPES, INTEGER_TYPES

# A failed cast costs far more than a pattern (it builds an error and drops it),
# so text is matched first and cast only when it can succeed.

# What a cast trims, and the words it reads as a flag.
PAD = r"[\x00-\x20\x7f]*"
TRUE_WORDS = "t|true|y|yes|1"
FALSE_WORDS = "f|false|n|no|0"

SHORT_INT = rf"^{PAD}[+-]?[0-9]{{1,9}}{PAD}$"
DECIMAL_TEXT = rf"^{PAD}([+-]?[0-9]*)(\.[0-9]*)?{PAD}$"
BARE_FRACTION = rf"^{PAD}[+-]?\.[0-9]*{PAD}$"
MAYBE_NUMBER = r"[0-9]|(?i)nan|inf"


def truncated_int(text: Column) -> Column:
    """Text to int, dropping decimals ('12.7' is 12, '.5' is 0); other text
    and overflow give NULL."""
    whole = F.regexp_extract(text, DECIMAL_TEXT, 1)
    return (
        F.when(text.rlike(SHORT_INT), text.cast("int"))
        .when(text.rlike(BARE_FRACTION), F.lit(0))
        .when(whole.rlike("[0-9]"), whole.try_cast("int"))
    )


def number(text: Column) -> Column:
    return F.when(text.rlike(MAYBE_NUMBER), text.try_cast("double"))


def flag(text: Column) -> Column:
    return (
        F.when(text.rlike(rf"(?i)^{PAD}({TRUE_WORDS}){PAD}$"), True)
        .when(text.rlike(rf"(?i)^{PAD}({FALSE_WORDS}){PAD}$"), False)
    )


def with_typed_values(df: DataFrame) -> DataFrame:
    """Add numeric_value (double) and boolean_value, read from ``value`` as
    ``value_type`` says; other value types leave both NULL."""
    kind, text = F.col("value_type"), F.col("value")
    return df.withColumns({
        "numeric_value": F.when(kind.isin(INTEGER_TYPES), truncated_int(text).cast("double"))
        .when(kind.isin(FLOAT_TYPES), number(text)),
        "boolean_value": F.when(kind.isin(BOOLEAN_TYPES), flag(text)),
    })


def with_missing_flags(df: DataFrame) -> DataFrame:
    """NULL, blank and zero flags; blank and zero are NULL for a NULL value."""
    text = F.col("value")
    return df.withColumns({
        "is_null_value": text.isNull(),
        "is_blank_value": text == "",
        "is_zero_value": text == "0",
    })


def with_completeness_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "has_reported_value": F.col("value").isNotNull(),
        "has_valid_numeric_value": F.col("numeric_value").isNotNull(),
    })
