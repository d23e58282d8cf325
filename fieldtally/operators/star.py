"""Star schema: dimensions by natural key and the service-delivery fact."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.constants import (
    DIM_DATA_ELEMENT, DIM_ORG_UNIT, DIM_PROGRAM, FACT_COLUMNS, PERIOD_COLUMNS,
)
from fieldtally.functions.columns import present, require_columns
from fieldtally.operators.latest import latest_per_key
from fieldtally.operators.lookup import RECENCY


def dimension(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Rename to the dimension's columns and keep the most recent row per key."""
    shaped = df.select(*[F.col(source).alias(name) for source, name in columns.items()])
    return latest_per_key(shaped, [key], present(shaped, RECENCY))


def dim_data_element(elements: DataFrame) -> DataFrame:
    return dimension(elements, "data_element_id", DIM_DATA_ELEMENT)


def dim_org_unit(hierarchy: DataFrame) -> DataFrame:
    return dimension(hierarchy, "org_unit_id", DIM_ORG_UNIT)


def dim_program(programs: DataFrame) -> DataFrame:
    return dimension(programs, "program_id", DIM_PROGRAM)


def dim_period(clean: DataFrame) -> DataFrame:
    """Periods present in the clean rows; the dates follow from the month, so
    whole rows are distinct by month."""
    return require_columns(clean, PERIOD_COLUMNS, "clean fact").select(*PERIOD_COLUMNS).distinct()


def build_fact(clean: DataFrame, load_timestamp: Column | None = None) -> DataFrame:
    """Fact columns in order, then load_timestamp (now, unless given)."""
    require_columns(clean, list(FACT_COLUMNS), "clean fact")
    loaded = F.current_timestamp() if load_timestamp is None else load_timestamp
    return clean.select(
        *[F.col(source).alias(name) for source, name in FACT_COLUMNS.items()],
        loaded.alias("load_timestamp"),
    )
