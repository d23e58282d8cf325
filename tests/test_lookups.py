from datetime import datetime

import pytest

from fieldtally.operators import drift, hierarchy, latest, lookup

NAMES = {"name_found": "name"}


@pytest.fixture
def values(spark):
    return spark.createDataFrame(
        [("A", 1), ("A", 2), ("B", 3), ("N", 4), ("X", 5), (None, 6)], "code string, v int")


@pytest.fixture
def table(spark):
    """B twice, the later one last in time; N known without a name."""
    return spark.createDataFrame(
        [("A", "Anna", datetime(2024, 1, 1)), ("B", "Bert", datetime(2024, 1, 1)),
         ("B", "Berta", datetime(2024, 1, 2)), ("N", None, datetime(2024, 1, 1)),
         (None, "nobody", datetime(2024, 1, 1))],
        "id string, name string, lastupdated timestamp")


@pytest.mark.parametrize("limits", [{}, {"max_rows": 1}, {"max_bytes": 1}])
def test_resolution_splits_and_never_fans_out(values, table, limits):
    """Alike by broadcast and, beyond the size limit, by shuffle."""
    found = lookup.resolve(values, table, "code", NAMES, "name_found", matched="known", **limits)
    assert sorted((r.code, r.v, r.name_found) for r in found.resolved.collect()) == [
        ("A", 1, "Anna"), ("A", 2, "Anna"), ("B", 3, "Berta")]
    rejected = {r.v: r.known for r in found.unresolved.collect()}
    assert rejected == {4: True, 5: False, 6: False}


def test_only_measured_lookups_broadcast(spark, values, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(**limits):
            joined = lookup.attach(values, "code", lookup.lookup_table(table, "id", NAMES, **limits))
            return joined._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan()
        assert "SortMergeJoin" in plan(max_rows=2)
        assert "SortMergeJoin" in plan(max_bytes=10)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_code_splits_when_the_lookup_is_too_large(spark, table):
    """Beyond the broadcast limit adaptive execution spreads the hot partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 2 = 0, 'A', concat('x', id)) as code", "uuid() as v")
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        joined = lookup.attach(rows, "code", lookup.lookup_table(table, "id", NAMES, max_rows=0))
        found = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in plan
    assert sum(r.name_found == "Anna" for r in found) == 30_000 and len(found) == 60_000


def test_hot_codes_meet_a_large_lookup_without_a_shuffle(spark, table):
    """Known or not, or NULL: only the rows of other codes are sorted."""
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "case id % 4 when 0 then 'A' when 1 then 'GHOST' when 2 then null else concat('x', id) end as code",
        "id as v")
    hot = latest.hot_keys(rows, ["code"])
    assert len(hot) == 3
    plain = lookup.resolve(rows, table, "code", NAMES, "name_found", matched="known", max_rows=0)
    found = lookup.resolve(rows, table, "code", NAMES, "name_found", matched="known", spread=True, max_rows=0)
    for name in ("resolved", "unresolved"):
        one, other = getattr(plain, name), getattr(found, name)
        assert one.columns == other.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert "BroadcastHashJoin" in found.unresolved._jdf.queryExecution().executedPlan().toString()
    sorted_rows = lookup.attach_spread(
        rows, "code", lookup.one_per_key(table, "id", NAMES), hot).filter("code like 'x%'").count()
    assert sorted_rows == 15_000


def test_first_reason_wins(spark):
    df = spark.createDataFrame([(None, None), ("e", None), ("e", "c")], "e string, c string")
    found = df.select(lookup.reject_reason({"no_e": "e", "no_c": "c"}).alias("r")).collect()
    assert [r.r for r in found] == ["no_e", "no_c", None]


def test_hierarchy_levels_and_names(spark):
    units = spark.createDataFrame(
        [("a", "Land", "/a"), ("b", "North", "/a/b"), ("c", "Town", "/a/b/c"),
         ("d", "Clinic", "/a/b/c/d"), ("e", "Ward", "/a/b/c/d/e"), ("p", "Lost", None),
         ("q", "Stray", "/zz/b")],
        "id string, name string, path string")
    named = hierarchy.level_names(hierarchy.path_levels(units))
    found = {r.id: (r.country_name, r.region_name, r.district_name, r.facility_name)
             for r in named.collect()}
    assert found == {
        "a": ("Land", None, None, "Land"), "b": ("Land", "North", None, "North"),
        "c": ("Land", "North", "Town", "Town"), "d": ("Land", "North", "Town", "Clinic"),
        "e": ("Land", "North", "Town", "Clinic"), "p": (None, None, None, "Lost"),
        "q": (None, "North", None, "Stray")}
    assert not [name for name in named.columns if name.startswith("lookup")]
    values = spark.createDataFrame([("d",), ("nowhere",)], "orgunit string")
    resolved, unresolved = hierarchy.enrich_with_hierarchy(values, named)
    assert [r.facility_name for r in resolved.collect()] == ["Clinic"]
    assert [r.orgunit for r in unresolved.collect()] == ["nowhere"]


def test_snapshot_drift(spark):
    current = spark.createDataFrame(
        [("1", "one"), ("2", "two"), ("3", None), ("4", "four"), ("4", "four")],
        "id string, name string")
    reference = spark.createDataFrame(
        [("1", "uno"), ("3", "three"), ("4", "four"), ("5", "five"), ("5", "five")],
        "id string, name string")
    found = drift.snapshot_drift(current, reference)
    assert [r.id for r in found["added_data_elements"].collect()] == ["2"]
    assert [r.id for r in found["removed_data_elements"].collect()] == ["5", "5"]
    assert [tuple(r) for r in found["renamed_data_elements"].collect()] == [("1", "uno", "one")]
    safe = drift.renamed(current, reference, null_safe=True).collect()
    assert sorted(r.id for r in safe) == ["1", "3"]
    assert drift.drift_summary(found).first().asDict() == {
        "added_data_elements": 1, "removed_data_elements": 2, "renamed_data_elements": 1}
    none = {label: df.filter("false") for label, df in found.items()}
    assert set(drift.drift_summary(none).first()) == {0}


def test_snapshot_diff_tells_every_change_in_one_pass(spark):
    current = spark.createDataFrame(
        [("a", "A", None, "2"), ("a", "older", "x", "1"), ("b", "B", "x", "1"), ("c", None, "x", "1"),
         ("d", "D", "x", "1"), (None, "N", "x", "1")],
        "id string, name string, code string, lastupdated string")
    reference = spark.createDataFrame(
        [("a", "A", "x", "0"), ("b", "old", "y", "0"), ("c", "C", "x", "0"), ("d", "D", "x", "0"),
         ("e", "E", "x", "0"), (None, "N", "x", "0")],
        "id string, name string, code string, lastupdated string")
    diff = drift.snapshot_diff(current, reference)
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
    found = {(r.diff_key, r.status): [tuple(c) for c in r.changes or []] for r in diff.collect()}
    assert found == {
        ("a", "changed"): [("code", "x", None)], ("b", "changed"): [("name", "old", "B"), ("code", "y", "x")],
        ("c", "changed"): [("name", "C", None)], ("d", "same"): [], ("e", "removed"): [],
        (None, "added"): [], (None, "removed"): []}
    written = drift.drift_tables(diff)
    assert [tuple(r) for r in written["renamed_data_elements"].collect()] == [("b", "old", "B")]
    assert sorted(r.attribute for r in written["changed_data_elements"].collect()) == ["code", "code", "name"]


def test_snapshot_diff_of_nested_and_empty_snapshots(spark):
    schema = "id string, held array<struct<id: string>>"
    one = spark.createDataFrame([("a", [("x",)]), ("b", None)], schema)
    two = spark.createDataFrame([("a", [("y",)]), ("b", None)], schema)
    changed = drift.snapshot_diff(one, two).filter("status = 'changed'").collect()
    assert [(c.old_value, c.new_value) for c in changed[0].changes] == [('[{"id":"y"}]', '[{"id":"x"}]')]
    assert len(changed) == 1
    empty = one.limit(0)
    assert [r.status for r in drift.snapshot_diff(one, empty).collect()] == ["added", "added"]
    assert drift.snapshot_diff(empty, empty).count() == 0
