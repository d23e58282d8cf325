"""Column names and column sets."""

from collections import Counter

from pyspark.sql import DataFrame


def standard_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower-case names, spaces and dashes to underscores; two columns that
    would end up with the same name are an error."""
    names = [standard_name(name) for name in df.columns]
    clashes = [name for name, uses in Counter(names).items() if uses > 1]
    if clashes:
        raise ValueError(f"Columns share a standard name: {clashes}")
    return df.toDF(*names)


def present(df: DataFrame, columns: list[str]) -> list[str]:
    held = set(df.columns)
    return [name for name in columns if name in held]


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select those of ``columns`` that the frame has, in the order given."""
    return df.select(*present(df, columns))


def require_columns(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Pass the frame on, or raise ``ValueError`` naming the absent columns."""
    held = set(df.columns)
    absent = [name for name in columns if name not in held]
    if absent:
        raise ValueError(f"{label} lacks {absent}")
    return df
