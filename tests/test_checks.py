from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldtally.constants import FACT_CONTRACT
from fieldtally.operators import contract, gates, marts, measures, quality, star

SMALL = {
    "table_name": "fact",
    "primary_grain": ["element", "year_month"],
    "columns": [
        {"name": "element", "type": "string", "nullable": False},
        {"name": "year_month", "type": "string", "nullable": False},
        {"name": "amount", "type": "double", "nullable": True, "min_value": 0, "max_value": 100},
        {"name": "loaded", "type": "timestamp", "nullable": False},
    ],
}
SCHEMA = "element string, year_month string, amount double, loaded timestamp"
NOW = datetime(2024, 2, 1)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def broken(df, rules=SMALL):
    return {(r.rule, r.column_name): r.violating_rows
            for r in contract.contract_violations(df, rules).collect()}


def test_a_valid_table_passes(spark):
    df = table(spark, ("E", "202401", 0.0, NOW), ("E", "202402", 100.0, NOW),
               ("F", "202401", None, NOW))
    assert broken(df) == {}
    contract.enforce_contract(df, SMALL)


def test_grain_violation_raises(spark):
    df = table(spark, *[("E", "202401", 10.0, NOW)] * 3)
    assert broken(df) == {("primary_grain", "element, year_month"): 2}
    with pytest.raises(ValueError, match="grain violation"):
        contract.enforce_contract(df, SMALL)


def test_all_rules_are_reported_together(spark):
    df = table(spark, (None, "202401", -1.0, NOW), (None, "202401", 101.0, None),
               ("E", "202401", float("nan"), NOW))
    assert broken(df) == {
        ("nullability", "element"): 2, ("nullability", "loaded"): 1,
        ("numeric_ranges", "amount"): 3, ("primary_grain", "element, year_month"): 1}
    changed = df.drop("loaded").withColumn("amount", F.col("amount").cast("float"))
    assert ("required_columns", "loaded") in broken(changed)
    assert ("column_types", "amount") in broken(changed)
    assert ("required_columns", "element") in broken(df.drop("element"))


def test_empty_tables_pass_unless_rows_are_required(spark):
    empty = table(spark, ("E", "202401", 1.0, NOW)).filter("false")
    assert broken(empty) == {}
    assert broken(empty, {**SMALL, "min_rows": 1}) == {("min_rows", "*"): 1}


def test_unknown_contract_type(spark):
    rules = {**SMALL, "columns": [{"name": "element", "type": "money", "nullable": True}]}
    with pytest.raises(KeyError):
        contract.contract_violations(table(spark, ("E", "202401", 1.0, NOW)), rules)


def test_contract_file(tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "contract.yml"
    path.write_text(yaml.safe_dump(FACT_CONTRACT))
    assert contract.load_contract(str(path)) == FACT_CONTRACT


def test_profile_and_rates(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    found = {r.column_name: (r.row_count, r.null_count, r.null_rate)
             for r in quality.profile(df).collect()}
    assert found == {"a": (3, 1, 0.3333), "b": (3, 2, 0.6667)}
    assert quality.row_count(df) == 3 and quality.null_count(df, "b") == 2
    assert quality.null_rate(df, "a") == 0.3333
    none = df.filter("false")
    assert quality.null_rate(none, "a") == 0.0
    assert {r.null_rate for r in quality.profile(none).collect()} == {0.0}
    assert tuple(quality.duplicate_rate(none).first()) == (0, 0, 0.0)
    assert tuple(quality.completeness_score(
        none.withColumn("has_reported_value", F.lit(True))).first()) == (0, 0, 0.0)


def test_gates(spark):
    counts = spark.createDataFrame(
        [("clean", 70), ("exact_duplicates", 10), ("unresolved_org_units", 20)],
        "outcome string, row_count long")
    assert tuple(gates.quarantine_rate(counts).first()) == (100, 30, 0.3)
    found = {r.gate: (r.observed, r.passed) for r in gates.run_gates(
        counts, max_unresolved_rate=0.2).collect()}
    assert found == {"max_quarantine_rate": (0.3, False), "min_fact_rows": (70.0, True),
                     "max_unresolved_rate": (0.2, True)}
    with pytest.raises(gates.GateError, match="max_quarantine_rate: 0.3 against 0.25"):
        gates.enforce_gates(gates.run_gates(counts))
    gates.enforce_gates(gates.run_gates(counts, max_quarantine_rate=0.3))
    with pytest.raises(gates.GateError, match="min_fact_rows"):
        gates.enforce_gates(gates.run_gates(counts.filter("false")))


def test_observed_rows(spark):
    df, seen = quality.observe_rows(spark.range(7), "seven")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["row_count"] == 7


def test_dimension_keeps_the_most_recent_row(spark):
    df = spark.createDataFrame(
        [("P", "old", NOW, datetime(2024, 1, 1)), ("P", "new", NOW, datetime(2024, 1, 2)),
         ("P", "undated", NOW, None)],
        "id string, name string, created timestamp, lastupdated timestamp")
    shape = {name: name for name in df.columns}
    assert [r.name for r in star.dimension(df, "id", shape).collect()] == ["new"]
    with pytest.raises(ValueError, match="quarter"):
        star.dim_period(spark.createDataFrame([("202401",)], "year_month string"))


FACT = ("country_name string, data_element_name string, facility_name string, "
        "year_month string, numeric_value double, has_reported_value boolean")


def fact(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def test_month_gaps_by_row_and_by_calendar(spark):
    """November, January (a gap), February; another series has no numbers."""
    df = fact(spark, ("K", "Cases", "A", "202311", 1.0, True), ("K", "Cases", "A", "202401", 4.0, True),
              ("K", "Cases", "B", "202401", 2.0, True), ("K", "Cases", "A", "202402", 9.0, True),
              ("K", "Text", "A", "202401", None, True))

    def shown(mart, column, **options):
        return [getattr(r, column) for r in mart(df, **options).orderBy(
            "data_element_name", "year_month").collect()]

    assert shown(marts.monthly_mom_change, "mom_change") == [None, 5.0, 3.0, None]
    assert shown(marts.monthly_mom_change, "mom_change", calendar=True) == [None, None, 3.0, None]
    assert shown(marts.rolling_3month_avg, "rolling_3month_avg") == [
        1.0, 3.5, pytest.approx(16 / 3), None]
    assert shown(marts.rolling_3month_avg, "rolling_3month_avg", calendar=True) == [
        1.0, 3.5, 7.5, None]


def test_reporting_rates(spark):
    df = fact(spark, ("K", "Cases", "A", "202401", 1.0, True), ("K", "Deaths", "A", "202401", 1.0, False),
              ("K", "Cases", "B", "202401", None, False), ("K", "Cases", "C", "202401", None, None),
              ("U", "Cases", "D", "202401", 1.0, True))
    rates = {r.country_name: (r.reporting_facilities, r.expected_facilities, r.reporting_rate)
             for r in marts.country_reporting_rate(df).collect()}
    assert rates == {"K": (1, 3, 0.3333), "U": (1, 1, 1.0)}
    low = {r.facility_name: r.reporting_score for r in marts.underreporting_facilities(df).collect()}
    assert low == {"B": 0.0, "C": 0.0}  # A sits on the limit of 0.5
    scores = {r.country_name: r.completeness_score
              for r in marts.completeness_comparison(df).collect()}
    assert scores == {"K": 0.25, "U": 1.0}
    assert [r.country_name for r in marts.low_completeness_countries(df).collect()] == ["K"]
    assert marts.low_completeness_countries(df, threshold=0.25).count() == 0


def test_measures_merge_by_aggregation_type(spark):
    fact = spark.createDataFrame(
        [("L", "P", "P", 2024, 1, "202401", 10.0), ("L", "P", "P", 2024, 1, "202401", 20.0),
         ("M", "P", "P", 2024, 1, "202402", 90.0), ("L", "P", "P", 2024, 1, "202403", None),
         ("L", "S", "S", 2024, 1, "202401", 5.0), ("L", "S", "S", 2024, 1, "202402", 7.0),
         ("L", "T", "T", 2024, 1, "202401", 5.0), ("L", "T", "T", 2024, 1, "202402", 3.0),
         ("L", "U", "U", 2024, 1, "202401", 5.0)],
        "country_name string, data_element_id string, data_element_name string, year int, quarter int, "
        "year_month string, numeric_value double")
    elements = spark.createDataFrame([("P", "AVERAGE"), ("S", "LAST"), ("T", "MIN"), ("U", None)],
                                     "data_element_id string, aggregationtype string")
    typed = measures.with_types(measures.fold_measures(fact), elements)
    quarter = {r.data_element_name: r.quarterly_amount for r in measures.typed_quarterly(typed).collect()}
    # every value of an average weighs alike, whatever the month or country it came from
    assert quarter == {"P": 40.0, "S": 7.0, "T": 3.0, "U": 5.0}
    rolled = {(r.data_element_name, r.country_name, r.year_month): r.rolling_amount
              for r in measures.typed_rolling(typed).collect()}
    assert rolled["P", "L", "202403"] == 15.0 and rolled["S", "L", "202402"] == 7.0
    change = {r.data_element_name: r.mom_change for r in measures.typed_mom_change(typed).collect()
              if r.previous_amount is not None and r.data_element_name != "P"}
    assert change == {"S": 2.0, "T": -2.0}
