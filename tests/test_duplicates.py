from collections import Counter
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pytest

from fieldtally.functions.periods import with_period_dates
from fieldtally.operators import dedup, latest, quality

EVENTS = "k string, t int, v string"


def as_counts(df):
    return Counter(tuple(row) for row in df.collect())


def test_exact_duplicates_keep_every_copy(spark):
    df = spark.createDataFrame([("A", "1")] * 3 + [("B", "2")] + [(None, None)] * 2,
                               "id string, value string")
    clean, surplus = dedup.remove_exact_duplicates(df)
    assert as_counts(clean) == Counter([("A", "1"), ("B", "2"), (None, None)])
    assert as_counts(surplus) == Counter([("A", "1")] * 2 + [(None, None)])


def test_one_row_repeated_past_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CHUNK", 100)
    copies = spark.range(1234).select(F.lit("x").alias("k"))
    clean, surplus = dedup.remove_exact_duplicates(copies)
    assert clean.count() == 1 and surplus.count() == 1233
    counted = dedup.collapse_copies(copies)
    assert counted.collect() == [("x", 1234)]
    assert dedup.expand_copies(counted).count() == 1234
    assert dedup.expand_copies(counted.withColumn("copies", F.lit(100).cast("long"))).count() == 100
    assert dedup.expand_copies(counted.withColumn("copies", F.lit(0).cast("long"))).count() == 0


def test_copies_merge_before_the_shuffle(spark):
    plan = dedup.collapse_copies(spark.createDataFrame([("a", 1, "x")], EVENTS))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


rows = st.lists(st.tuples(
    st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 2)),
    st.sampled_from(["x", "y", None])), min_size=1, max_size=25)


def newest(t, v):
    return ((t is not None, t or 0), (v is not None, v or ""))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_latest_wins_like_a_loop(spark, data):
    """Against brute force, with no hot key and with every key hot."""
    distinct = set(data)
    winners = {}
    for key, t, v in distinct:
        if key not in winners or newest(t, v) > newest(*winners[key]):
            winners[key] = (t, v)
    df = spark.createDataFrame(data, EVENTS).distinct()
    every = [row.h for row in df.select(latest.key_hash(["k"]).alias("h")).distinct().collect()]
    for hot in ([], every[:1], every):
        marked = latest.mark_latest(df, ["k"], ["t"], hot=hot).collect()
        assert len(marked) == len(distinct)
        assert {r.k: (r.t, r.v) for r in marked if r.is_latest} == winners
        assert sum(r.is_latest for r in marked) == len(winners)
    kept = latest.latest_per_key(df, ["k"], ["t"]).collect()
    assert {r.k: (r.t, r.v) for r in kept} == winners


def test_hot_keys_are_found_and_others_are_not(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    expected = spark.range(1).select(F.lit(-1).cast("long").alias("k")).select(
        latest.key_hash(["k"])).first()[0]
    assert latest.hot_keys(df, ["k"], share=0.05, least=100) == [expected]
    assert latest.hot_keys(df, ["k"], share=0.5, least=100) == []
    assert latest.hot_keys(df.filter("k = 0"), ["k"]) == []


def test_a_key_with_a_third_of_the_rows(spark):
    """Found by its own share, the winner is right and nothing is lost."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"))
    hot = latest.hot_keys(df, ["k"])
    assert len(hot) == 1
    marked = latest.mark_latest(df, ["k"], ["t"], hot=hot)
    found = marked.groupBy("is_latest").count().collect()
    assert {r.is_latest: r["count"] for r in found} == {True: 40_001, False: 19_999}
    assert marked.filter("is_latest and k = 'hot'").first().t == 59_997


def test_rank_filter_drops_losers_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], EVENTS)
    plan = latest.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1]


def test_near_duplicates_by_any_spelling(spark):
    df = spark.createDataFrame(
        [("D", "202401", "O", "C", "1", datetime(2024, 2, 1)),
         ("D", "202401", "O", "C", "5", datetime(2024, 2, 5)),
         ("D", "202401", "O", "C", "5", datetime(2024, 2, 5)),
         ("D", "202402", "O", "C", "7", None)],
        "dataElement string, period string, orgUnit string, categoryOptionCombo string, "
        "value string, lastUpdated timestamp")
    kept, superseded = dedup.resolve_near_duplicates(df)
    assert sorted(r.value for r in kept.collect()) == ["5", "7"]
    assert sorted(r.value for r in superseded.collect()) == ["1", "5"]
    with pytest.raises(ValueError, match="orgunit"):
        dedup.resolve_near_duplicates(df.drop("orgUnit"))
    with pytest.raises(ValueError, match="lastupdated"):
        dedup.resolve_near_duplicates(df.drop("lastUpdated"))


def test_quality_job_keeps_the_later_value(spark):
    base = dict(dataelement="DE1", period="202401", year_month="202401", orgunit="OU1",
                categoryoptioncombo="COC1", value_type="NUMBER", created=datetime(2024, 1, 1),
                data_element_name="Cases", category_option_combo_name="default",
                country_name="K", region_name="N", district_name="W", facility_name="Clinic")
    first = {**base, "value": "1", "lastupdated": datetime(2024, 2, 1)}
    second = {**base, "value": "5", "lastupdated": datetime(2024, 2, 5)}
    found = quality.run_quality(spark.createDataFrame([first, second, second]))
    kept = found.clean.collect()
    assert [(r.value, r.numeric_value, r.is_late_submission) for r in kept] == [("5", 5.0, False)]
    assert found.superseded.count() == 1 and found.exact_duplicates.count() == 1


def test_quality_job_attaches_attributes_after_the_ranking(spark):
    rows = spark.createDataFrame(
        [("DE1", "202401", "OU1", "C", "1", 1), ("DE1", "202401", "OU1", "C", "5", 2),
         ("DE1", "202401", "OU1", "C", "5", 2), ("DE9", "202401", "OU1", "C", "7", 3),
         (None, "202401", "OU1", "C", "8", 3)],
        "dataelement string, period string, orgunit string, categoryoptioncombo string, "
        "value string, lastupdated int").withColumn(
            "lastupdated", F.timestamp_seconds("lastupdated"))
    names = F.when(F.col("dataelement") == "DE1", "Cases")

    def attach(df):
        return with_period_dates(df).withColumns(
            {"data_element_name": names, "value_type": F.lit("NUMBER")}).filter(
                "data_element_name is not null")

    late = quality.run_quality(rows, attach=attach)
    early = quality.run_quality(attach(rows))
    for one, other in zip(late, early):
        assert one.columns == other.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert [r.value for r in late.clean.collect()] == ["5"]
    window = [line for line in late.clean._jdf.queryExecution().optimizedPlan().toString().splitlines()
              if "Window [" in line]
    assert len(window) == 1
    ranked = late.clean._jdf.queryExecution().sparkPlan().toString()
    assert "data_element_name" not in ranked[ranked.index("Window ["):]
    empty = quality.run_quality(rows.limit(0), attach=attach)
    assert [df.count() for df in empty] == [0, 0, 0]


def test_superseded_rows_are_ranked_once(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", 1, "z")],
                                 "k string, lastupdated int, value string")
    _, superseded = dedup.resolve_near_duplicates(rows, ["k"])
    assert sorted(map(tuple, superseded.collect())) == [("a", 1, "x"), ("a", 2, "y")]
    _, superseded = dedup.resolve_near_duplicates(rows, ["k"])
    plan = superseded._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [row_number") == 1 and plan.count("FileScan") == 1
    surplus = dedup.remove_exact_duplicates(rows)[1]
    assert surplus._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    empty = dedup.resolve_near_duplicates(rows.limit(0), ["k"])
    assert [df.count() for df in empty] == [0, 0]


def test_hot_winners_too_large_for_a_broadcast_join_by_salt(spark, monkeypatch):
    rows = spark.range(400).selectExpr("if(id % 2 = 0, 'hot', concat('k', id % 7)) as k", "id as t", "id as v")
    hot = [row[0] for row in rows.filter("k = 'hot'").select(latest.key_hash(["k"])).distinct().collect()]
    few = latest.mark_latest(rows, ["k"], ["t"], hot)
    monkeypatch.setattr(latest, "WINNER_BYTES", 10)
    many = latest.mark_latest(rows, ["k"], ["t"], hot)
    assert "hot_salt" in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert many.columns == [*rows.columns, "is_latest"]


def shuffles(df):
    """Exchanges of the plan that runs, without those of broadcasts and single rows."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_folding_and_ranking_like_a_loop(spark, data):
    """Against brute force, with no hot key, one and every key hot."""
    winners = {}
    for key, t, v in set(data):
        if key not in winners or newest(t, v) > newest(*winners[key]):
            winners[key] = (t, v)
    expected = Counter({(key, t, v, copies, winners[key] == (t, v)): 1
                        for (key, t, v), copies in Counter(data).items()})
    df = spark.createDataFrame(data, EVENTS)
    every = [row.h for row in df.select(latest.key_hash(["k"]).alias("h")).distinct().collect()]
    for hot in ([], every[:1], every):
        folded = latest.fold_latest(df, ["k"], ["t"], hot=hot)
        assert folded.columns == ["k", "t", "v", "copies", "is_latest"]
        assert as_counts(folded) == expected


def test_rows_move_once_to_be_folded_and_ranked(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y")],
                               "k string, lastupdated int, value string")
    judged = quality.judge(df, ["k"], hot=[])
    assert shuffles(judged) == 1
    assert sorted(map(tuple, judged.select("value", "copies", "outcome").collect())) == [
        ("x", 2, quality.SUPERSEDED), ("y", 1, quality.CLEAN)]


def test_ranked_rows_are_joined_where_they_are(spark):
    """Dealt by a column of the key, rows do not move for a join by it; unless one
    of its values holds much of the table."""
    few = spark.range(1_000).selectExpr("concat('u', id % 50) as unit", "cast(id % 7 as string) as k", "id as t")
    loud = spark.range(40_000).selectExpr(
        "if(id % 2 = 0, 'u1', concat('u', id)) as unit", "cast(id % 30000 as string) as k", "id % 9 as t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rows, moved in ((few, 2), (loud, 3)):
            folded = latest.fold_latest(rows, ["k", "unit"], ["t"], meet="unit")
            assert as_counts(folded) == as_counts(latest.fold_latest(rows, ["k", "unit"], ["t"], hot=[]))
            names = rows.select("unit").distinct().coalesce(1)
            names = spark.createDataFrame(names.collect(), "unit string")
            assert shuffles(folded.join(names, "unit", "left")) == moved
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_repeated_row_of_a_hot_key_folds_before_it_moves(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 2).otherwise(F.col("id")).alias("t"))
    folded = latest.fold_latest(df, ["k"], ["t"])
    assert sorted(map(tuple, folded.filter("k = 'hot'").collect())) == [
        ("hot", 0, 10_000, False), ("hot", 1, 10_000, True)]
    assert folded.filter("k <> 'hot' and copies = 1 and is_latest").count() == 40_000
    assert folded.count() == 40_002
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan
