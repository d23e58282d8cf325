"""Declarative data contracts, checked into a table of violations.

A contract is a dict with ``primary_grain`` (column names), ``columns`` (name,
type, nullable and optional min_value / max_value) and optional ``min_rows``.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Type names a contract may use.
CONTRACT_TYPES = ["string", "double", "boolean", "timestamp"]
RULES = ["required_columns", "column_types", "nullability", "numeric_ranges",
         "primary_grain", "min_rows"]
VIOLATION_SCHEMA = "rule string, column_name string, detail string, violating_rows bigint"


class ContractError(ValueError):
    """A table breaks its contract."""


def violation(rule: str, column: str, detail: Column, rows: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"),
                    detail.alias("detail"), rows.cast("bigint").alias("violating_rows"))


def schema_violations(df: DataFrame, contract: dict) -> DataFrame:
    """Absent columns and types that differ; reads the schema only."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    found = []
    for column in contract["columns"]:
        name, expected = column["name"], column["type"]
        if expected not in CONTRACT_TYPES:
            raise KeyError(expected)
        if name not in actual:
            found.append(("required_columns", name, "column is absent", None))
        elif actual[name] != expected:
            found.append(("column_types", name,
                          f"expected {expected} but found {actual[name]}", None))
    return local_rows(df.sparkSession, found)


def local_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, VIOLATION_SCHEMA)


def out_of_range(column: dict) -> Column:
    value, tests = F.col(column["name"]), []
    if "min_value" in column:
        tests.append(value < column["min_value"])
    if "max_value" in column:
        tests.append(value > column["max_value"])
    return reduce(lambda one, other: one | other, tests)


def unfold(totals: DataFrame, checks: list[Column]) -> DataFrame:
    """Turn a one-row frame into one row per check that failed."""
    return totals.select(F.inline(F.array(*checks))).filter("violating_rows > 0")


def null_violations(df: DataFrame, contract: dict) -> DataFrame:
    """NULLs in columns that may hold none."""
    return _value_violations(df, contract, ranges=False)


def range_violations(df: DataFrame, contract: dict) -> DataFrame:
    """Values outside the inclusive limits; NULL is inside, NaN above any limit."""
    return _value_violations(df, contract, nulls=False)


def _value_violations(df: DataFrame, contract: dict, nulls: bool = True,
                      ranges: bool = True) -> DataFrame:
    counts, checks = [], []

    def add(rule: str, column: str, detail: str, failed: Column) -> None:
        alias = f"{rule}_{len(counts)}"
        counts.append(F.count_if(failed).alias(alias))
        checks.append(violation(rule, column, F.lit(detail), F.col(alias)))

    for column in contract["columns"]:
        name = column["name"]
        if name not in df.columns:
            continue
        if nulls and not column["nullable"]:
            add("nullability", name, "NULL in a non-nullable column", F.col(name).isNull())
        if ranges and ("min_value" in column or "max_value" in column):
            limits = f"outside {column.get('min_value', '-')} to {column.get('max_value', '-')}"
            add("numeric_ranges", name, limits, out_of_range(column))
    if not counts:
        return local_rows(df.sparkSession, [])
    return unfold(df.agg(*counts), checks)


def grain_violations(df: DataFrame, contract: dict) -> DataFrame:
    """Rows beyond the first per grain, and too few rows if the contract says."""
    grain, least = contract["primary_grain"], contract.get("min_rows", 0)
    if any(name not in df.columns for name in grain):
        return local_rows(df.sparkSession, [])
    totals = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("grain_rows")).agg(
        F.sum(F.col("grain_rows") - 1).alias("surplus_rows"),
        F.coalesce(F.sum("grain_rows"), F.lit(0)).alias("total_rows"),
    )
    total = F.col("total_rows").cast("string")
    return unfold(totals, [
        violation("primary_grain", ", ".join(grain),
                  F.concat(F.lit("duplicate rows out of "), total), F.col("surplus_rows")),
        violation("min_rows", "*", F.concat(F.lit(f"expected {least} rows but found "), total),
                  F.greatest(F.lit(least) - F.col("total_rows"), F.lit(0))),
    ])


def contract_violations(df: DataFrame, contract: dict) -> DataFrame:
    """Every broken rule of a contract; no rows means the table passes.

    Two passes over the data: one for NULLs and ranges, one for the grain."""
    return schema_violations(df, contract).unionByName(
        _value_violations(df, contract)).unionByName(grain_violations(df, contract))


def enforce_contract(df: DataFrame, contract: dict) -> None:
    """Raise ``ContractError`` listing what is broken, in rule order."""
    found = contract_violations(df, contract).collect()
    if found:
        found.sort(key=lambda row: RULES.index(row.rule))
        label = contract.get("table_name", "table")
        lines = [f"{label} {row.rule.replace('_', ' ')} violation: {row.column_name} "
                 f"{row.detail} ({row.violating_rows or 0} rows)" for row in found]
        raise ContractError("; ".join(lines))


def load_contract(path: str) -> dict:
    """Read a contract from a YAML file (needs PyYAML)."""
    import yaml

    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)
