"""Every registered query against its SQL counterpart on the small tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from fieldtally.constants import DATA_VALUES_SCHEMA
from fieldtally.sources import documents, publish, tables
from workload import documents as docs
from workload import fixtures
from workload.oracle import statements
from workload.queries import registered

SF_DIR = Path("/root/testdata/sf0.001")
QUERIES, STATEMENTS = registered(), statements()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def plain(cell):
    if isinstance(cell, float) and math.isnan(cell):
        return "nan"
    return cell


def test_each_query_has_a_counterpart():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry.queries()) and set(STATEMENTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    expected = duck.execute(STATEMENTS[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    order = [column[0] for column in expected.description]
    found = Counter(tuple(plain(cell) for cell in row) for row in df.select(*order).collect())
    wanted = Counter(tuple(plain(cell) for cell in row) for row in expected.fetchall())
    assert sum(found.values()) > 0
    assert found == wanted


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_value_documents_are_written_compressed_and_read_whole(spark):
    sent = spark.range(250).selectExpr(
        "'D' as dataelement", "'202401' as period", "concat('C', id % 2) as orgunit", "'X' as categoryoptioncombo",
        "cast(id as string) as attributeoptioncombo", "'1' as value", "'clerk' as storedby",
        "timestamp_ntz '2024-01-01 00:00:00' as created", "timestamp_ntz '2024-01-02 00:00:00' as lastupdated",
        "'false' as followup", "if(id = 7, 2, 1) as sent")
    path = docs.value_documents(sent)
    files = {name for name in publish.folder_names(spark, path) if name.startswith("part-")}
    assert files and all(name.endswith(".json.gz") for name in files)
    found = documents.ingest_data_values(spark, path, lines=True)
    assert found.count() == 251 and found.select("attributeoptioncombo").distinct().count() == 250


@pytest.mark.parametrize("name", ["incremental_filter_periods", "incremental_changed_periods"])
def test_values_are_made_once(spark, monkeypatch, name):
    made = []
    held = fixtures.data_values
    monkeypatch.setattr(fixtures, "data_values", lambda *given: made.append(given) or held(*given))
    assert QUERIES[name](spark, str(SF_DIR)).columns and len(made) == 1


def test_what_a_row_decides_is_not_staged(spark, monkeypatch):
    staged = {}
    held = tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, name, *rest, **more: staged.update(
        {name: df.columns}) or held(df, name, *rest, **more))
    assert "reason" in QUERIES["quarantine_union"](spark, str(SF_DIR)).columns
    assert "country_name" in staged["judged"]
    assert not {"period_start_date", "numeric_value", "is_late_submission"} & set(staged["judged"])


def test_values_of_a_parcel_are_grouped_where_they_are(spark):
    """One shuffle brings rows to their parcel, none follows; a large parcel becomes
    several documents, and the first values lie in a folder of their own."""
    sent = spark.range(0, 1_000, 1, 4).selectExpr(
        "'D' as dataelement", "if(id < 600, '202401', if(id = 999, null, '202402')) as period",
        "concat('C', id % 2) as orgunit", "'X' as categoryoptioncombo",
        "cast(id as string) as attributeoptioncombo", "'1' as value", "'clerk' as storedby",
        "timestamp_ntz '2024-01-01 00:00:00' as created", "timestamp_ntz '2024-01-02 00:00:00' as lastupdated",
        "'false' as followup", "if(id = 7, 2, 1) as sent", "if(id < 600, 0, id) as parcel")
    moves = []
    held = docs.write_documents
    docs.write_documents = lambda df, *rest: moves.append(
        df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")) or held(df, *rest)
    try:
        path = docs.value_documents(sent.repartition("parcel"), sent["period"] < "202402")
    finally:
        docs.write_documents = held
    assert moves == [1]
    assert set(publish.folder_names(spark, path)) == {"first=0", "first=1"}
    early = documents.ingest_data_values(spark, f"{path}/first=1", lines=True)
    whole = documents.ingest_data_values(spark, path, lines=True)
    assert early.count() == 601 and early.select("period").distinct().count() == 1
    assert whole.count() == 1_001 and whole.select("attributeoptioncombo").distinct().count() == 1_000
    sizes = documents.read_documents(spark, f"{path}/first=1", DATA_VALUES_SCHEMA, lines=True).selectExpr(
        "size(dataValues) as n").filter("n > 0")
    assert sizes.count() > 6 and sizes.agg({"n": "max"}).first()[0] < 150
