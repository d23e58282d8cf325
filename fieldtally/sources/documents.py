"""Read nested export documents and flatten their payload arrays.

A path may be one document, a directory of documents or JSON Lines. A pretty-
printed document is one parse task whatever its size; exports meant for large
clusters should come as many documents or, with ``lines=True``, one per line.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldtally.constants import (
    DATA_VALUES_SCHEMA, METADATA_SCHEMA, ORG_UNITS_SCHEMA, PROGRAMS_SCHEMA,
)
from fieldtally.functions.columns import standardize_names
from fieldtally.functions.periods import standardize_timestamps, with_period_dates
from fieldtally.sources.tables import materialize

CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, schema: str | StructType,
                   lines: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """Read documents with a fixed schema; fields outside it are dropped.

    ``keep_corrupt`` adds the text of documents that could not be parsed."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("multiLine", not lines)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def corrupt_documents(documents: DataFrame) -> DataFrame:
    """File and text of documents that could not be parsed (``keep_corrupt``),
    with the number of fields that could still be read."""
    fields = [name for name in documents.columns if name != CORRUPT]
    return documents.select(
        F.input_file_name().alias("file"),
        sum((F.col(name).isNotNull().cast("int") for name in fields), F.lit(0))
        .alias("fields_read"),
        CORRUPT,
    ).filter(F.col(CORRUPT).isNotNull())


class Parsed(NamedTuple):
    rows: DataFrame
    corrupt: DataFrame


def parse(spark: SparkSession, path: str, schema: str, payload: str, lines: bool = False) -> Parsed:
    """One parse, written: the elements of a payload array, and source_file and
    corrupt_record of the documents that could not be read in full."""
    found = read_documents(spark, path, schema, lines, keep_corrupt=True)
    items = found.select(F.input_file_name().alias("source_file"), CORRUPT,
                         F.posexplode_outer(payload).alias("position", "item"))
    first = F.coalesce("position", F.lit(0)) == 0
    staged = materialize(items.select(
        F.when(F.col(CORRUPT).isNotNull() & first, F.col("source_file")).alias("source_file"),
        F.when(first, F.col(CORRUPT)).alias("corrupt_record"), "position", "item",
    ).filter("position is not null or corrupt_record is not null"), payload)
    return Parsed(staged.filter("position is not null").select("item.*"),
                  staged.filter("corrupt_record is not null").select("source_file", "corrupt_record"))


def flatten(documents: DataFrame, payload: str) -> DataFrame:
    """One row per element of an array of structs; a NULL or empty array gives
    no rows."""
    return documents.select(F.inline(payload))


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Pass the frame on, or raise ``ValueError`` when it holds no rows."""
    if df.isEmpty():
        raise ValueError(f"No rows in {label}")
    return df


def standardize_entity(df: DataFrame) -> DataFrame:
    """Standard names, and created / lastupdated as timestamps."""
    return standardize_timestamps(standardize_names(df), ["created", "lastupdated"])


def parse_entity(spark: SparkSession, path: str, schema: str, payload: str,
                 lines: bool = False) -> Parsed:
    """Standardised rows of one payload array, which must hold some, and the
    documents that could not be read in full."""
    found = parse(spark, path, schema, payload, lines)
    return found._replace(rows=standardize_entity(require_rows(found.rows, f"{path} {payload}")))


def parse_metadata(spark: SparkSession, path: str, lines: bool = False) -> tuple[Parsed, Parsed]:
    """Data elements and category option combos, from one parse; its unreadable
    documents stand with the elements."""
    payloads = ["dataElements", "categoryOptionCombos"]
    found = materialize(read_documents(spark, path, METADATA_SCHEMA, lines, keep_corrupt=True).select(
        F.input_file_name().alias("source_file"), *payloads, CORRUPT), "metadata")
    corrupt = found.filter(F.col(CORRUPT).isNotNull()).select(
        "source_file", F.col(CORRUPT).alias("corrupt_record"))
    elements, combos = (
        standardize_entity(require_rows(flatten(found, payload), f"{path} {payload}"))
        for payload in payloads)
    return Parsed(elements, corrupt), Parsed(combos, corrupt.limit(0))


def parse_reference_metadata(spark: SparkSession, path: str, lines: bool = False) -> Parsed:
    return parse_entity(spark, path, METADATA_SCHEMA, "dataElements", lines)


def parse_org_units(spark: SparkSession, path: str, lines: bool = False) -> Parsed:
    return parse_entity(spark, path, ORG_UNITS_SCHEMA, "organisationUnits", lines)


def parse_programs(spark: SparkSession, path: str, lines: bool = False) -> Parsed:
    return parse_entity(spark, path, PROGRAMS_SCHEMA, "programs", lines)


def ingest_metadata(spark: SparkSession, path: str,
                    lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(data elements, category option combos), from one parse."""
    return tuple(found.rows for found in parse_metadata(spark, path, lines))


def ingest_reference_metadata(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Data elements of an earlier metadata snapshot."""
    return parse_reference_metadata(spark, path, lines).rows


def ingest_org_units(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return parse_org_units(spark, path, lines).rows


def ingest_programs(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return parse_programs(spark, path, lines).rows


def parse_data_values(spark: SparkSession, path: str, lines: bool = False) -> Parsed:
    """Reported values with their period columns, and unreadable documents; an
    export without values passes."""
    found = parse(spark, path, DATA_VALUES_SCHEMA, "dataValues", lines)
    return found._replace(rows=with_period_dates(standardize_entity(found.rows)))


def ingest_data_values(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Reported values with their period columns; there must be some."""
    return require_rows(parse_data_values(spark, path, lines).rows, f"{path} dataValues")
