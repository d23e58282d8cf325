"""Sources, sinks and the whole job over literal documents."""

import json
import os
import shutil
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldtally import constants as C
from fieldtally.operators.contract import ContractError
from fieldtally.operators.gates import GateError, quarantine_rows
from fieldtally.plans import reporting
from fieldtally.plans.reporting import Inputs, Options, run_reporting
from fieldtally.sources import documents, incremental, publish, tables

STAMPS = {"created": "2024-01-01T00:00:00", "lastUpdated": "2024-01-02T00:00:00"}


def element(uid, name, kind="NUMBER"):
    return {"id": uid, "name": name, "shortName": name, "code": uid, "valueType": kind,
            "domainType": "AGGREGATE", "aggregationType": "SUM", "zeroIsSignificant": True,
            "categoryCombo": {"id": "CC", "name": "default"},
            "dataElementGroups": [{"id": "G", "name": "group"}], **STAMPS}


def unit(uid, name, path):
    return {"id": uid, "name": name, "shortName": name, "code": uid, "level": path.count("/"),
            "path": path, "groups": [], **STAMPS}


def value(amount, element="DE1", period="202401", unit="F", combo="COC", updated="2024-02-02"):
    return {"dataElement": element, "period": period, "orgUnit": unit,
            "categoryOptionCombo": combo, "attributeOptionCombo": "AOC", "value": amount,
            "storedBy": "tester", "created": "2024-02-01T00:00:00",
            "lastUpdated": f"{updated}T00:00:00", "followup": "false"}


class Export:
    """Documents of one reporting export below a folder."""

    def __init__(self, folder):
        self.folder = folder
        self.put("metadata", {"dataElements": [element("DE1", "Cases"), element("DE2", "Open", "BOOLEAN")],
                              "categoryOptionCombos": [{"id": "COC", "name": "default", **STAMPS}]})
        self.put("reference", {"dataElements": [element("DE1", "Case count"), element("DE9", "Gone")],
                               "categoryOptionCombos": []})
        self.put("org_units", {"organisationUnits": [
            unit("C", "Land", "/C"), unit("R", "North", "/C/R"), unit("D", "Town", "/C/R/D"),
            unit("F", "Clinic", "/C/R/D/F")]})
        self.put("programs", {"programs": [
            {"id": "P", "name": "Malaria", "shortName": "Malaria", "healthArea": "Malaria",
             "country": "Land", "reportingFrequency": "MONTHLY", "dataElements": ["DE1"], **STAMPS}]})

    def put(self, name, document):
        (self.folder / f"{name}.json").write_text(json.dumps(document, indent=2))

    def values(self, *rows):
        self.put("data_values", {"responseType": "dataValueSet", "dataValues": list(rows)})

    def inputs(self):
        names = ["metadata", "reference", "org_units", "programs", "data_values"]
        return Inputs(*[str(self.folder / f"{name}.json") for name in names])


@pytest.fixture
def export(tmp_path):
    return Export(tmp_path)


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}")


def test_documents_flatten_and_standardise(spark, export):
    export.values(value("10"), value(None, period="202413"))
    found = documents.ingest_data_values(spark, export.inputs().data_values)
    rows = {r.period: r for r in found.collect()}
    assert found.columns == C.DATA_VALUE_COLUMNS + C.PERIOD_COLUMNS
    assert rows["202401"].year_month == "202401"
    assert rows["202401"].lastupdated == datetime(2024, 2, 2)
    assert rows["202413"].period_start_date is None and rows["202413"].value is None
    elements, combos = documents.ingest_metadata(spark, export.inputs().metadata)
    first = elements.filter("id = 'DE1'").first()
    assert (first.categorycombo.name, first.dataelementgroups[0].id) == ("default", "G")
    assert combos.columns == ["id", "name", "created", "lastupdated"]


def test_empty_payload_and_corrupt_documents(spark, export):
    export.values()
    with pytest.raises(ValueError, match="No rows in"):
        documents.ingest_data_values(spark, export.inputs().data_values)
    lines = export.folder / "lines.json"
    good = {"dataValues": [value("1"), value("2")], "unknown": 1}
    lines.write_text(json.dumps(good) + "\n{broken\n" + json.dumps({"dataValues": None}) + "\n")
    found = documents.read_documents(spark, str(lines), C.DATA_VALUES_SCHEMA, lines=True,
                                     keep_corrupt=True)
    assert documents.flatten(found, "dataValues").count() == 2
    broken = documents.corrupt_documents(found).collect()
    assert [(r[documents.CORRUPT], r.fields_read) for r in broken] == [("{broken", 0)]
    assert broken[0].file.endswith("lines.json")


def test_overwrite_replaces_only_the_partitions_it_brings(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("202401", 1), ("202402", 2)], "year_month string, v int")
    tables.write_parquet(first, path, ["year_month"])
    tables.write_parquet(first.limit(1).withColumn("v", F.lit(9)), path, ["year_month"],
                         max_records_per_file=10)
    again = tables.read_like(first, path)
    assert again.schema == first.schema
    assert sorted(map(tuple, again.collect())) == [("202401", 9), ("202402", 2)]
    tables.write_parquet(first.limit(1), path, ["year_month"], replace_all=True)
    assert tables.read_like(first, path).count() == 1


def test_materialize_reads_back_only_its_own_rows(spark):
    first = tables.materialize(spark.range(3), "same")
    second = tables.materialize(spark.range(5), "same")
    assert (first.count(), second.count()) == (3, 5)
    empty = tables.materialize(spark.createDataFrame([], "a int, p string"), "none", ["p"])
    assert empty.count() == 0
    written, rows, size = tables.materialize_measured(spark.range(4), "measured")
    assert (written.count(), rows, size) == (4, 4, 4 * 8)
    texts = spark.createDataFrame([("é", 1), (None, 2)], "t string, n int")
    assert tables.materialize_measured(texts, "measured")[1:] == (2, 2 + 2 * 8)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_run_leaves_no_staged_table_behind(spark):
    with tables.run_staging(spark) as folder:
        assert tables.materialize(spark.range(3), "mine").count() == 3
        rows = tables.side_by_side(lambda n: tables.materialize(spark.range(n), "more").count(), [1, 2])
        assert rows == [1, 2] and len(os.listdir(folder)) == 3
    assert not os.path.exists(folder)
    with pytest.raises(ZeroDivisionError), tables.run_staging(spark) as folder:
        tables.materialize(spark.range(3), "mine")
        1 / 0
    assert not os.path.exists(folder) and tables.run_folder.get() is None


def test_fact_needs_its_partition_column(spark, tmp_path):
    with pytest.raises(ValueError, match="year_month"):
        tables.write_fact(spark.range(1), str(tmp_path / "fact"))


def test_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_csv(spark.createDataFrame([("a", 1)], "k string, n int"), path)
    assert [tuple(r) for r in spark.read.option("header", True).csv(path).collect()] == [("a", "1")]


def test_period_filters(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert incremental.loaded_periods(spark, path).count() == 0
    held = spark.createDataFrame([("202401", 1)], "year_month string, v int")
    tables.write_fact(held, path)
    loaded = incremental.loaded_periods(spark, path)
    assert [r.year_month for r in loaded.collect()] == ["202401"]
    df = spark.createDataFrame([("202401", 1), ("202402", 2), (None, 3)], "year_month string, v int")
    assert [r.v for r in incremental.new_periods(df, loaded).collect()] == [2]
    assert sorted(r.v for r in incremental.new_periods(df, loaded, keep_null=True).collect()) == [2, 3]
    none = loaded.filter("false")
    assert incremental.new_periods(df, none).count() == 2
    assert incremental.new_periods(df, none, keep_null=True).count() == 3
    assert incremental.load_required(df) and not incremental.load_required(df.filter("false"))


DIRTY = [
    value("10"), value("10"), value("10"),                # exact copies
    value("12", updated="2024-02-05"),                    # supersedes the copies
    value("3", combo="X"), value("3", combo="X"),         # unknown combo, sent twice
    value("4", element="GHOST"), value("5", unit="NOWHERE"),
    value("6", period="202413"), value("7", period=None),
    value("true", element="DE2"), value("8", period="202402", updated="2024-06-01"),
] + [value(str(n), unit=unit, period=f"2023{n:02d}") for n in range(1, 13) for unit in "CRD"]


def test_the_whole_job(spark, export, tmp_path):
    export.values(*DIRTY)
    output = str(tmp_path / "out")
    assert run_reporting(spark, export.inputs(), output, Options(max_unresolved_rate=0.15)) == "success"
    app = f"fieldtally-{spark.sparkContext.applicationId}"
    held = os.path.join(tables.shared_folder(spark), app)
    assert not [name for name in os.listdir(held) if name.startswith("run-")]

    fact = read(spark, output, "facts/fact_service_delivery")
    assert fact.count() == 3 + 36
    kept = {(r.data_element_id, str(r.year_month)): r for r in fact.filter(
        "org_unit_id = 'F'").collect()}
    assert kept["DE1", "202401"].numeric_value == 12.0
    assert kept["DE1", "202402"].is_late_submission is True
    assert kept["DE2", "202401"].boolean_value is True
    assert kept["DE1", "202401"].facility_name == "Clinic"
    assert set(r.facility_name for r in fact.filter("org_unit_id = 'R'").collect()) == {"North"}

    quarantine = read(spark, output, "quarantine")
    buckets = Counter(r.reason for r in quarantine.select("reason").collect())
    assert buckets == {"exact_duplicates": 2, "superseded_records": 1, "bad_period": 2,
                       "unresolved_category_option_combos": 2, "unresolved_data_elements": 1,
                       "unresolved_org_units": 1}
    assert fact.count() + sum(buckets.values()) == len(DIRTY)

    metrics = read(spark, output, "run_metrics").first()
    assert (metrics.status, metrics.input_rows, metrics.fact_rows, metrics.quarantine_rows) == (
        "success", len(DIRTY), 39, 9)
    assert metrics.corrupt_documents == 0
    drift = read(spark, output, "metadata_drift/summary").first()
    assert tuple(drift) == (1, 1, 1)
    assert read(spark, output, "dimensions/dim_period").count() == 14
    assert read(spark, output, "dimensions/dim_org_unit").count() == 4
    assert read(spark, output, "dimensions/dim_program").columns == list(C.DIM_PROGRAM.values())
    totals = read(spark, output, "analytics/quarterly_global_totals")
    assert totals.filter("year = 2024 and data_element_name = 'Cases'").first().quarterly_total == 20.0
    # values without a readable period are accounted for on every load
    assert run_reporting(spark, export.inputs(), output) == "no_new_periods"
    later = read(spark, output, "quarantine")
    assert later.count() == 9 + 2 and later.select("run_id").distinct().count() == 2
    again = read(spark, output, "run_metrics").filter("status = 'no_new_periods'").first()
    assert (again.input_rows, again.fact_rows, again.quarantine_rows) == (2, 0, 2)


def test_only_new_periods_load_and_reopening_is_a_choice(spark, export, tmp_path):
    output = str(tmp_path / "out")

    def run(**options):
        return run_reporting(spark, export.inputs(), output, Options(**options))

    def amounts():
        return {str(r.year_month): r.numeric_value for r in read(
            spark, output, "facts/fact_service_delivery").collect()}

    export.values(value("1"), value("2", period="202402"))
    assert run() == "success"
    assert run() == "no_new_periods"
    export.values(value("9", updated="2024-04-01"), value("3", period="202403"))
    assert run() == "success"
    assert amounts() == {"202401": 1.0, "202402": 2.0, "202403": 3.0}
    changes = read(spark, output, "analytics/monthly_mom_change")
    assert {str(r.year_month): r.mom_change for r in changes.collect()} == {
        "202401": None, "202402": 1.0, "202403": 1.0}
    assert run(refresh_changed=True) == "success"
    assert amounts() == {"202401": 9.0, "202402": 2.0, "202403": 3.0}
    statuses = Counter(r.status for r in read(spark, output, "run_metrics").collect())
    assert statuses == {"success": 3, "no_new_periods": 1}
    # the stored row that a later value replaced is not lost
    replaced = read(spark, output, "quarantine").collect()
    assert [(r.reason, r.period, r.value) for r in replaced] == [("replaced_records", "202401", "1")]
    assert run(incremental=False) == "success"
    assert amounts()["202401"] == 9.0


def test_a_reopened_month_keeps_what_the_export_does_not_bring(spark, export, tmp_path):
    output = str(tmp_path / "out")
    sent = [value("1"), value("true", element="DE2"), value("3", unit="C")]
    export.values(*sent, value("4", period="202402"))
    assert run_reporting(spark, export.inputs(), output) == "success"
    export.values(value("9", updated="2024-04-01"), value("5", unit="D", updated="2024-04-01"))
    assert run_reporting(spark, export.inputs(), output, Options(refresh_changed=True)) == "success"
    fact = read(spark, output, "facts/fact_service_delivery").collect()
    assert sorted((str(r.year_month), r.data_element_id, r.org_unit_id, r.value) for r in fact) == [
        ("202401", "DE1", "C", "3"), ("202401", "DE1", "D", "5"), ("202401", "DE1", "F", "9"),
        ("202401", "DE2", "F", "true"), ("202402", "DE1", "F", "4")]


def test_a_reopened_month_keeps_the_newest_of_stored_and_sent(spark, export, tmp_path):
    output = str(tmp_path / "out")
    export.values(value("new", updated="2024-03-05"), value("same", unit="C", updated="2024-03-05"),
                  value("1", unit="D", updated="2024-02-10"))
    assert run_reporting(spark, export.inputs(), output) == "success"
    export.values(value("old", updated="2024-02-05"), value("same", unit="C", updated="2024-03-05"),
                  value("2", unit="D", updated="2024-04-01"), value("3", unit="R", updated="2024-04-01"))
    assert run_reporting(spark, export.inputs(), output, Options(refresh_changed=True)) == "success"
    fact = read(spark, output, "facts/fact_service_delivery").collect()
    assert sorted((r.org_unit_id, r.value) for r in fact) == [
        ("C", "same"), ("D", "2"), ("F", "new"), ("R", "3")]
    lost = read(spark, output, "quarantine").collect()
    assert sorted((r.reason, r.orgunit, r.value, r.period) for r in lost) == [
        ("exact_duplicates", "C", "same", "202401"), ("replaced_records", "D", "1", "202401"),
        ("superseded_records", "F", "old", "202401")]
    metrics = {r.input_rows: r for r in read(spark, output, "run_metrics").collect()}[4]
    assert (metrics.fact_rows, metrics.quarantine_rows, metrics.replaced_rows) == (2, 2, 1)


def test_merge_treats_nulls_as_oldest(spark):
    columns = "k string, lastupdated string, created string, value string, only string"
    sent = spark.createDataFrame([("a", None, "c", "v", "x"), ("b", "2", None, None, "x"),
                                  ("c", "1", "c", "v", "x"), (None, "1", "c", "v", "x")], columns)
    stored = spark.createDataFrame([("a", "1", "c", "v"), ("b", "2", None, None), ("d", "1", "c", "v"),
                                    (None, "2", "c", "v")], "k string, lastupdated string, created string, value string")
    merged = incremental.merge_stored(sent, stored, ["k"], ["lastupdated", "created", "value"])
    assert sorted((str(r.k), r.only or "stored", r.merge_outcome) for r in merged.collect()) == [
        ("None", "stored", "kept"), ("None", "x", "superseded_records"),
        ("a", "stored", "kept"), ("a", "x", "superseded_records"), ("b", "stored", "kept"),
        ("b", "x", "exact_duplicates"), ("c", "x", "kept"), ("d", "stored", "kept")]


class Died(Exception):
    pass


def published(spark, output):
    """Everything below an output folder that a reader would look at, without run ids
    and times."""
    found = {}
    for name in ("facts/fact_service_delivery", "facts/period_statistics", "dimensions/dim_period",
                 "dimensions/dim_org_unit", "analytics/monthly_mom_change", "analytics/country_reporting_rate",
                 "quarantine", "run_metrics", "metadata_drift/summary"):
        rows = read(spark, output, name).drop("load_timestamp", "run_id", "completed_at_utc")
        found[name] = sorted(str(row) for row in rows.collect())
    return found


@pytest.mark.parametrize("step", ["marts", "committed"])
def test_a_run_that_died_is_repeated_or_finished(spark, export, tmp_path, step):
    def die(at):
        if at == step:
            raise Died

    first = [value("1"), value("2", unit="C"), value("3", element="GHOST", period="202402")]
    second = first + [value("5", period="202403"), value("9", updated="2024-05-01")]
    quiet = {"max_quarantine_rate": 1.0, "refresh_changed": True}
    outputs = [str(tmp_path / "whole"), str(tmp_path / "broken")]
    for output in outputs:
        export.values(*first)
        run_reporting(spark, export.inputs(), output, Options(**quiet))
        export.values(*second)
        if output == outputs[1]:
            with pytest.raises(Died):
                run_reporting(spark, export.inputs(), output, Options(**quiet, on_step=die))
            if step == "committed":
                # a committed run is finished by the next one, which has nothing left to load
                export.values()
                with pytest.raises(ValueError, match="No rows in"):
                    run_reporting(spark, export.inputs(), output, Options(**quiet))
                continue
            assert read(spark, output, "facts/fact_service_delivery").count() == 2
        run_reporting(spark, export.inputs(), output, Options(**quiet))
    assert published(spark, outputs[0]) == published(spark, outputs[1])
    for output in outputs:
        assert not os.path.exists(f"{output}/_runs") or not os.listdir(f"{output}/_runs")
    if step == "marts":
        assert publish.latest_version(spark, outputs[0]) == publish.latest_version(spark, outputs[1]) == 2


def test_one_of_two_runs_at_the_same_time_is_refused(spark, tmp_path):
    output = str(tmp_path / "out")
    one, two = publish.open_release(spark, output), publish.open_release(spark, output)
    one.publish(one.commit())
    with pytest.raises(publish.ConcurrentRun):
        two.commit()
    assert publish.read_manifest(spark, output)["run_id"] == one.run_id


def test_a_load_opens_no_fact_file_of_other_months(spark, export, tmp_path):
    output = str(tmp_path / "out")
    sent = [value(str(n), unit=unit, period=f"2024{n:02d}") for n in (1, 2, 3) for unit in "CF"]
    export.values(*sent)
    assert run_reporting(spark, export.inputs(), output) == "success"
    for month in ("202401", "202403"):
        folder = f"{output}/facts/fact_service_delivery/year_month={month}"
        for file in os.listdir(folder):
            with open(f"{folder}/{file}", "wb") as broken:
                broken.write(b"unreadable")
    export.values(value("8", period="202402", updated="2024-06-01"), value("4", period="202404"))
    assert run_reporting(spark, export.inputs(), output, Options(refresh_changed=True)) == "success"
    totals = read(spark, output, "analytics/monthly_mom_change").collect()
    assert {str(r.year_month): r.monthly_total for r in totals} == {
        "202401": 2.0, "202402": 10.0, "202403": 6.0, "202404": 4.0}
    assert read(spark, output, "dimensions/dim_period").count() == 4
    statistics = read(spark, output, "facts/period_statistics").collect()
    assert {r.year_month: r.row_count for r in statistics} == {
        "202401": 2, "202402": 2, "202403": 2, "202404": 1}


def test_options_add_marts_by_type_and_rolled_rates(spark, export, tmp_path):
    output = str(tmp_path / "out")
    options = Options(by_aggregation_type=True, rolled_rates=True)
    export.values(value("4"), value(None, unit="C"), value("8", period="202402", unit="C"))
    assert run_reporting(spark, export.inputs(), output, options) == "success"
    export.values(value("6", period="202405"), value(None, period="202405", unit="R"))
    assert run_reporting(spark, export.inputs(), output, options) == "success"
    rates = {r.period: (r.reporting_facilities, r.expected_facilities)
             for name in ("quarterly", "yearly")
             for r in read(spark, output, f"analytics/{name}_reporting_rate").collect()
             if r.country_name == "Land"}
    assert rates == {"2024Q1": (2, 2), "2024Q2": (1, 2), "2024": (2, 3)}
    numbers = [r.number for r in read(spark, output, "facts/facility_numbers").collect()]
    assert sorted(numbers) == [0, 1, 2]
    by_type = read(spark, output, "analytics/quarterly_by_type").collect()
    assert sorted((r.quarter, r.aggregationtype, r.quarterly_amount) for r in by_type) == [
        (1, "SUM", 12.0), (2, "SUM", 6.0)]


def test_lost_statistics_and_folds_are_counted_anew(spark, export, tmp_path):
    output = str(tmp_path / "out")
    export.values(value("1"), value("2", period="202402", unit="C"))
    assert run_reporting(spark, export.inputs(), output) == "success"
    before = published(spark, output)
    for name in ("facts/period_statistics", "facts/fold_series", "facts/fold_facilities/year_month=202401"):
        shutil.rmtree(f"{output}/{name}")
    assert run_reporting(spark, export.inputs(), output) == "no_new_periods"
    export.values(value("3", period="202403"))
    assert run_reporting(spark, export.inputs(), output) == "success"
    totals = read(spark, output, "analytics/monthly_mom_change").collect()
    assert {str(r.year_month): r.monthly_total for r in totals} == {
        "202401": 1.0, "202402": 2.0, "202403": 3.0}
    after = read(spark, output, "facts/period_statistics")
    assert set(before["facts/period_statistics"]) < {str(r) for r in after.collect()}


def test_corrupt_documents_are_quarantined(spark, export, tmp_path):
    output = str(tmp_path / "out")
    lines = export.folder / "lines.json"
    lines.write_text(json.dumps({"dataValues": [value("1"), value("2", unit="C")]}) + "\n{broken\n"
                     + json.dumps({"dataValues": []}) + "\n")
    for name in ("metadata", "reference", "org_units", "programs"):
        path = export.folder / f"{name}.json"
        path.write_text(json.dumps(json.loads(path.read_text())))
    names = ["metadata", "reference", "org_units", "programs", "lines"]
    inputs = Inputs(*[str(export.folder / f"{name}.json") for name in names], lines=True)
    assert run_reporting(spark, inputs, output) == "success"
    row = read(spark, output, "quarantine").first()
    assert (row.reason, row.corrupt_record) == ("corrupt_document", "{broken")
    assert row.source_file.endswith("lines.json")
    assert read(spark, output, "run_metrics").first().corrupt_documents == 1
    lines.write_text("{broken\n")
    with pytest.raises(ValueError, match="No rows in"):
        run_reporting(spark, inputs, output)
    assert read(spark, output, "quarantine").count() == 2


def test_rejects_of_every_source_are_kept(spark, export, tmp_path):
    output = str(tmp_path / "out")
    names = ["metadata", "reference", "org_units", "programs"]
    export.values(value("1"))
    folders = []
    for name in [*names, "data_values"]:
        folder = export.folder / f"{name}_in"
        folder.mkdir()
        (folder / "good.json").write_text((export.folder / f"{name}.json").read_text())
        (folder / "bad.json").write_text(f"{{broken {name}")
        folders.append(str(folder))
    assert run_reporting(spark, Inputs(*folders), output) == "success"
    rows = read(spark, output, "quarantine").collect()
    assert sorted((r.reason, r.corrupt_record) for r in rows) == sorted(
        ("corrupt_document", f"{{broken {name}") for name in [*names, "data_values"])
    assert all(r.source_file.endswith("bad.json") for r in rows)
    assert read(spark, output, "run_metrics").first().corrupt_documents == 5


def test_quarantine_rows_take_one_scan(spark):
    judged = tables.materialize(spark.createDataFrame(
        [("clean", 3, "a"), ("superseded_records", 2, "b"), ("bad_period", 2, "c"), ("clean", 1, "d")],
        "outcome string, copies long, value string"), "judged", ["outcome"])
    found = quarantine_rows(judged)
    assert Counter((r.reason, r.value) for r in found.collect()) == {
        ("exact_duplicates", "a"): 2, ("superseded_records", "b"): 1, ("exact_duplicates", "b"): 1,
        ("bad_period", "c"): 2}
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    many = judged.withColumn("copies", F.when(F.col("value") == "a", 70_001).otherwise(F.col("copies")))
    assert quarantine_rows(many).filter("value = 'a'").count() == 70_000


def test_periods_keep_leading_zeros(spark, tmp_path):
    path = str(tmp_path / "fact")
    tables.write_fact(spark.createDataFrame([("000101", 1)], "year_month string, v int"), path)
    loaded = incremental.loaded_periods(spark, path)
    assert [r.year_month for r in loaded.collect()] == ["000101"]
    again = spark.createDataFrame([("000101", 2)], "year_month string, v int")
    assert incremental.new_periods(again, loaded).count() == 0


def test_a_failed_gate_or_contract_publishes_no_fact(spark, export, tmp_path):
    output = str(tmp_path / "out")
    export.values(value("1"), value("2", element="GHOST"))
    with pytest.raises(GateError, match="max_quarantine_rate: 0.5"):
        run_reporting(spark, export.inputs(), output)
    assert read(spark, output, "quarantine").count() == 1
    export.values(value("-1"))
    with pytest.raises(ContractError, match="numeric ranges violation: numeric_value"):
        run_reporting(spark, export.inputs(), output)
    assert incremental.read_fact(spark, f"{output}/facts/fact_service_delivery") is None


def test_clean_rows_go_before_rejects_are_made(spark):
    rows = [("DE1", "202401", "clean", 1, "1"), ("DE1", "202401", "clean", 3, "2"),
            ("DE1", "202402", "superseded_records", 2, "x"), ("DE1", "bad", "bad_period", 2, None)]
    staged = tables.materialize(spark.createDataFrame(
        [(*row, datetime(2024, 5, 1), "INTEGER") for row in rows],
        "dataelement string, period string, outcome string, copies long, value string, "
        "lastupdated timestamp, value_type string"), "judged")
    found = reporting.rejects_of(staged)
    derived = quarantine_rows(reporting.with_derived(staged))
    assert found.columns == derived.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, derived.collect()))
    assert Counter((r.reason, r.value) for r in found.collect()) == {
        ("exact_duplicates", "2"): 2, ("superseded_records", "x"): 1, ("exact_duplicates", "x"): 1,
        ("bad_period", None): 2}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(copies,1)" in plan and "filter(array" not in plan
