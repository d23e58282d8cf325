"""Registered queries: each operator over the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from fieldtally import constants as C
from fieldtally.functions import casts, columns, periods
from fieldtally.operators import (
    contract, dedup, drift, gates, hierarchy, latest, lookup, marts, measures,
    quality, rollups, star,
)
from fieldtally.plans import reporting
from fieldtally.sources import documents, incremental, tables
from workload import documents as docs
from workload import fixtures as fx
from workload import jobs

EARLY = "199801"
REGISTRY = {
    "data_element_name": "name", "shortname": "shortname", "code": "code",
    "value_type": "valuetype", "domaintype": "domaintype",
    "aggregationtype": "aggregationtype", "zeroissignificant": "zeroissignificant",
}


def load_time():
    return F.expr("timestamp '2024-03-01 00:00:00'")


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates and times as text and sums rounded, so both engines print alike."""
    def plain(field):
        if isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType)):
            return F.col(field.name).cast("string")
        if field.dataType.typeName() == "double":
            return F.round(field.name, digits)
        return F.col(field.name)

    return df.select(*[plain(field).alias(field.name) for field in df.schema.fields])


# ---- shared steps

def resolved_elements(spark, sf_dir):
    elements = fx.data_elements(spark, sf_dir)
    return lookup.resolve(
        fx.data_values(spark, sf_dir), elements, "dataelement",
        {"data_element_name": "name", "value_type": "valuetype"}, "data_element_name")


def resolved_combos(spark, sf_dir):
    return lookup.resolve(
        resolved_elements(spark, sf_dir).resolved, fx.category_combos(spark, sf_dir),
        "categoryoptioncombo", C.CATEGORY_COMBO_ATTRIBUTES, "category_option_combo_name")


def enriched(spark, sf_dir):
    return hierarchy.enrich_with_hierarchy(
        resolved_combos(spark, sf_dir).resolved, fx.hierarchy(spark, sf_dir))


def written_values(spark, sf_dir):
    return tables.materialize(reporting.raw_values(fx.data_values(spark, sf_dir)), "raw")


def judged_raw(spark, sf_dir, raw=None):
    """Judged values, of ``raw`` if they are written already."""
    raw = written_values(spark, sf_dir) if raw is None else raw
    return reporting.judge_raw(
        raw, fx.data_elements(spark, sf_dir), fx.category_combos(spark, sf_dir),
        fx.hierarchy(spark, sf_dir))


def judged(spark, sf_dir, raw=None):
    return reporting.with_derived(judged_raw(spark, sf_dir, raw))


def clean(spark, sf_dir, raw=None):
    return reporting.clean_rows(judged(spark, sf_dir, raw))


def fact(spark, sf_dir, raw=None):
    return star.build_fact(clean(spark, sf_dir, raw), load_time())


def silenced_fact(spark, sf_dir):
    """The fact with one country silent in the first half of each year."""
    silent = (F.col("country_name") == "AFRICA") & (F.col("quarter") <= 2)
    return fact(spark, sf_dir).withColumn(
        "has_reported_value", F.col("has_reported_value") & ~silent)


def early_fact(spark, rows):
    """Path of a published fact that holds the periods before 199801."""
    path = tables.scratch_path(spark, "fact")
    tables.write_fact(rows.filter(F.col("year_month") < EARLY), path)
    return path


# ---- sources

def src_json_document(spark, sf_dir):
    path = docs.entity_documents(
        fx.org_units(spark, sf_dir), "organisationUnits", docs.ORG_UNIT)
    found = documents.read_documents(spark, path, C.ORG_UNITS_SCHEMA, lines=True)
    return found.select("version", F.size("organisationUnits").alias("units"),
                        F.get("organisationUnits", F.lit(0)).getField("id").alias("first_id"))


def flatten_nested_array(spark, sf_dir):
    path = docs.value_documents(fx.sent_values(spark, sf_dir))
    found = documents.read_documents(spark, path, C.DATA_VALUES_SCHEMA, lines=True)
    return documents.flatten(found, "dataValues").select(
        "dataElement", "orgUnit", "attributeOptionCombo", "value")


def guard_not_empty(spark, sf_dir):
    return documents.require_rows(fx.org_units(spark, sf_dir), "org units").groupBy(
        "level").agg(F.count(F.lit(1)).alias("units"))


def metadata_path(spark, sf_dir):
    return docs.metadata_documents(
        fx.element_registry(spark, sf_dir), fx.category_combos(spark, sf_dir))


def ingest_metadata(spark, sf_dir):
    elements, combos = documents.ingest_metadata(spark, metadata_path(spark, sf_dir), lines=True)
    shared = ["id", "name", "created", "lastupdated"]
    return elements.select(F.lit("element").alias("kind"), *shared, "valuetype").unionByName(
        combos.select(F.lit("combo").alias("kind"), *shared), allowMissingColumns=True)


def ingest_reference_metadata(spark, sf_dir):
    found = documents.ingest_reference_metadata(spark, metadata_path(spark, sf_dir), lines=True)
    return found.drop("categorycombo", "dataelementgroups")


def ingest_org_units(spark, sf_dir):
    path = docs.entity_documents(
        fx.org_units(spark, sf_dir), "organisationUnits", docs.ORG_UNIT)
    return documents.ingest_org_units(spark, path, lines=True).drop("parent", "groups")


def ingest_programs(spark, sf_dir):
    path = docs.entity_documents(fx.programs(spark, sf_dir), "programs", docs.PROGRAM)
    found = documents.ingest_programs(spark, path, lines=True)
    return found.withColumn("dataelements", F.array_join("dataelements", ","))


def ingest_data_values(spark, sf_dir):
    path = docs.value_documents(fx.sent_values(spark, sf_dir))
    return documents.ingest_data_values(spark, path, lines=True)


# ---- columns, periods, casts

def standardize_column_names(spark, sf_dir):
    odd = fx.table(spark, sf_dir, "supplier").toDF(
        " S Suppkey", "Supplier-Name", "nationKey", "ACCT bal ")
    return columns.standardize_names(odd)


def select_existing_columns(spark, sf_dir):
    return columns.select_existing(
        fx.table(spark, sf_dir, "customer"), ["c_mktsegment", "c_phone", "c_custkey"])


def prune_columns(spark, sf_dir):
    return quality.prune_columns(periods.with_period_dates(fx.data_values(spark, sf_dir)))


def period_dates(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case o_orderpriority when '5-LOW' then date_format(o_orderdate, 'yyyy13') "
        "when '4-NOT SPECIFIED' then null else date_format(o_orderdate, 'yyyyMM') end as period")
    return periods.with_period_dates(orders)


def standardize_timestamps(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") as created",
        "case o_orderstatus when 'F' then date_format(o_orderdate, 'yyyy-MM-dd') "
        "when 'P' then concat('pending ', o_orderkey) end as lastupdated")
    return periods.standardize_timestamps(orders, ["created", "lastupdated"])


def late_reporting(spark, sf_dir):
    late = periods.with_late_flag(fx.data_values(spark, sf_dir))
    return late.select("attributeoptioncombo", "period", "lastupdated", "reporting_deadline",
                       "is_late_submission")


def cast_typed_values(spark, sf_dir):
    return casts.with_typed_values(fx.mixed_values(spark, sf_dir))


def missing_value_flags(spark, sf_dir):
    return casts.with_missing_flags(fx.data_values(spark, sf_dir)).select(
        "attributeoptioncombo", "value", "is_null_value", "is_blank_value", "is_zero_value")


def completeness_flags(spark, sf_dir):
    typed = casts.with_typed_values(fx.mixed_values(spark, sf_dir))
    return casts.with_completeness_flags(typed).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "value_type",
        "has_reported_value", "has_valid_numeric_value")


# ---- resolution and hierarchy

def resolve_data_elements(spark, sf_dir):
    return resolved_elements(spark, sf_dir).resolved


def unresolved_data_elements(spark, sf_dir):
    return resolved_elements(spark, sf_dir).unresolved


def resolve_category_combos(spark, sf_dir):
    return resolved_combos(spark, sf_dir).resolved


def unresolved_category_combos(spark, sf_dir):
    return resolved_combos(spark, sf_dir).unresolved


def enrich_org_hierarchy(spark, sf_dir):
    return enriched(spark, sf_dir).resolved


def unresolved_org_units(spark, sf_dir):
    return enriched(spark, sf_dir).unresolved


def resolve_registry(spark, sf_dir):
    """All attributes of a registry that holds some elements twice."""
    lines = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey",
        "if(l_tax > 0.075, 'GHOST', concat('P', l_partkey)) as dataelement")
    found = lookup.resolve(lines, fx.element_registry(spark, sf_dir), "dataelement",
                           REGISTRY, "data_element_name", matched="is_known", spread=True)
    return found.resolved.unionByName(found.unresolved)


def hierarchy_levels(spark, sf_dir):
    return hierarchy.path_levels(fx.org_units(spark, sf_dir))


def hierarchy_names(spark, sf_dir):
    return fx.hierarchy(spark, sf_dir)


# ---- duplicates

def exact_dup_clean(spark, sf_dir):
    return dedup.remove_exact_duplicates(fx.data_values(spark, sf_dir))[0]


def exact_dup_surplus(spark, sf_dir):
    return dedup.remove_exact_duplicates(fx.data_values(spark, sf_dir))[1]


def near_dup_latest(spark, sf_dir):
    return dedup.resolve_near_duplicates(fx.data_values(spark, sf_dir), timestamp="lastUpdated")[0]


def near_dup_superseded(spark, sf_dir):
    return dedup.resolve_near_duplicates(fx.data_values(spark, sf_dir), timestamp="lastUpdated")[1]


def daily_events(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def near_dup_events_latest(spark, sf_dir):
    return dedup.resolve_near_duplicates(
        daily_events(spark, sf_dir), ["user_id", "event_type", "day"], "ts")[0]


def near_dup_events_superseded(spark, sf_dir):
    return dedup.resolve_near_duplicates(
        daily_events(spark, sf_dir), ["user_id", "event_type", "day"], "ts")[1]


def near_dup_hot_events(spark, sf_dir):
    """Latest event per type, where each type holds much of the table."""
    events = fx.table(spark, sf_dir, "events")
    hot = latest.hot_keys(events, ["event_type"], share=0.01, least=10)
    return latest.mark_latest(events, ["event_type"], ["ts"], hot).filter("is_latest").select(
        "event_type", "event_id", "ts")


def duplicate_rate(spark, sf_dir):
    return quality.duplicate_rate(fx.data_values(spark, sf_dir))


# ---- quality job, star schema

def run_quality(spark, sf_dir):
    def attributes(rows):
        known = reporting.attach_lookups(
            periods.with_period_dates(rows), fx.data_elements(spark, sf_dir),
            fx.category_combos(spark, sf_dir), fx.hierarchy(spark, sf_dir))
        return known.filter(lookup.reject_reason(reporting.RESOLUTION_ORDER).isNull())

    return quality.run_quality(fx.data_values(spark, sf_dir), attach=attributes, meet="orgunit")


def dq_clean_fact(spark, sf_dir):
    return run_quality(spark, sf_dir).clean


def dq_exact_duplicates(spark, sf_dir):
    return run_quality(spark, sf_dir).exact_duplicates


def dq_superseded(spark, sf_dir):
    return run_quality(spark, sf_dir).superseded


def fact_build(spark, sf_dir):
    return fact(spark, sf_dir)


def dim_data_element(spark, sf_dir):
    return star.dim_data_element(fx.element_registry(spark, sf_dir))


def dim_org_unit(spark, sf_dir):
    return star.dim_org_unit(fx.hierarchy(spark, sf_dir))


def dim_program(spark, sf_dir):
    return star.dim_program(fx.programs(spark, sf_dir))


def dim_period(spark, sf_dir):
    return star.dim_period(clean(spark, sf_dir))


# ---- marts

def over_fact(mart):
    return lambda spark, sf_dir: mart(fact(spark, sf_dir))


def over_silenced(mart):
    return lambda spark, sf_dir: mart(silenced_fact(spark, sf_dir))


# ---- contract

def contract_schema(spark, sf_dir):
    """The schema of a given table against a contract it breaks twice."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return contract.schema_violations(orders, {"table_name": "orders", "columns": [
        {"name": "o_orderkey", "type": "string"}, {"name": "o_orderstatus", "type": "string"},
        {"name": "o_approved", "type": "boolean"}]})


def nullable_contract(**limits):
    """The fact contract with values, numbers and flags required."""
    changed = []
    for column in C.FACT_CONTRACT["columns"]:
        if column["name"] == "numeric_value":
            column = {**column, "nullable": False, **limits}
        changed.append(column)
    extra = {"name": "value", "type": "string", "nullable": False}
    return {**C.FACT_CONTRACT, "columns": [*changed, extra]}


def contract_nullability(spark, sf_dir):
    return contract.null_violations(fact(spark, sf_dir), nullable_contract())


def contract_ranges(spark, sf_dir):
    return contract.range_violations(
        fact(spark, sf_dir), nullable_contract(min_value=1, max_value=50000))


def contract_grain(spark, sf_dir):
    """Resolved values before duplicates are removed break the grain."""
    rows = fx.data_values(spark, sf_dir).withColumnsRenamed({
        "dataelement": "data_element_id", "orgunit": "org_unit_id",
        "categoryoptioncombo": "category_option_combo_id", "period": "year_month"})
    return contract.grain_violations(rows, C.FACT_CONTRACT)


def contract_violations(spark, sf_dir):
    """Every rule over the fact under a stricter contract."""
    strict = {**nullable_contract(min_value=1, max_value=50000), "min_rows": 1_000_000_000,
              "primary_grain": ["data_element_id", "org_unit_id", "year_month"]}
    rows = tables.materialize(fact(spark, sf_dir), "fact")
    return contract.contract_violations(rows, strict)


def contract_passes(spark, sf_dir):
    """The fact meets its own contract: the count of violations is zero."""
    found = contract.contract_violations(fact(spark, sf_dir), C.FACT_CONTRACT)
    return found.agg(F.count(F.lit(1)).alias("violations"))


# ---- drift

def snapshots(spark, sf_dir):
    return fx.current_snapshot(spark, sf_dir), fx.reference_snapshot(spark, sf_dir)


def drift_added(spark, sf_dir):
    return drift.added(*snapshots(spark, sf_dir))


def drift_removed(spark, sf_dir):
    return drift.removed(*snapshots(spark, sf_dir))


def drift_renamed(spark, sf_dir):
    return drift.renamed(*snapshots(spark, sf_dir))


def drift_summary(spark, sf_dir):
    return drift.drift_summary(drift.snapshot_drift(*snapshots(spark, sf_dir)))


def drift_changed(spark, sf_dir):
    """Every difference of two snapshots: rows by status, and attributes."""
    diff = drift.snapshot_diff(fx.current_versions(spark, sf_dir), fx.reference_versions(spark, sf_dir))
    return diff.filter("status <> 'same'").select(
        "status", F.col("diff_key").alias("id"), F.inline_outer("changes"))


def drift_written(spark, sf_dir):
    """The drift tables as the job writes them, by content."""
    diff = tables.materialize(drift.snapshot_diff(
        fx.current_versions(spark, sf_dir), fx.reference_versions(spark, sf_dir)), "diff")
    written = tables.write_tables(drift.drift_tables(diff), tables.scratch_path(spark, "drift"))
    rows = {
        "added_data_elements": ("cast(null as string)", "concat_ws('|', name, shortname, code)"),
        "removed_data_elements": ("concat_ws('|', name, shortname, code)", "cast(null as string)"),
        "renamed_data_elements": ("old_name", "new_name"),
        "changed_data_elements": ("concat_ws('|', attribute, old_value)", "concat_ws('|', attribute, new_value)"),
    }
    parts = [written[table].selectExpr(f"'{table}' as drift_table", "id", f"{old} as old_value",
                                       f"{new} as new_value") for table, (old, new) in rows.items()]
    return reduce(DataFrame.unionByName, parts)


def ingest_pretty_documents(spark, sf_dir):
    """Nested fields of pretty-printed documents with many rows an array, and the
    documents that cannot be read."""
    elements, _ = documents.parse_metadata(spark, docs.pretty_metadata(spark, sf_dir))
    units = documents.parse_org_units(spark, docs.pretty_org_units(spark, sf_dir))

    def shown(df, entity, one, many):
        return df.select(F.lit(entity).alias("entity"), "id", F.to_json(one).alias("one"),
                         F.to_json(many).alias("many"))

    broken = elements.corrupt.withColumn("entity", F.lit("metadata")).unionByName(
        units.corrupt.withColumn("entity", F.lit("org_units")))
    return shown(elements.rows, "element", "categorycombo", "dataelementgroups").unionByName(
        shown(units.rows, "unit", "parent", "groups")).unionByName(
        broken.select("entity", F.trim(F.regexp_replace("corrupt_record", r"\s+", " ")).alias("id")),
        allowMissingColumns=True)


# ---- profiles, rates, gates

def dq_profile(spark, sf_dir):
    return quality.profile(fact(spark, sf_dir).drop("load_timestamp"))


def completeness_score(spark, sf_dir):
    return quality.completeness_score(fact(spark, sf_dir))


def quarantine_counts(spark, sf_dir):
    return gates.outcome_counts(judged(spark, sf_dir))


def quarantine_rate(spark, sf_dir):
    return gates.quarantine_rate(quarantine_counts(spark, sf_dir))


def quarantine_union(spark, sf_dir):
    staged = tables.materialize(judged_raw(spark, sf_dir), "judged", ["outcome"])
    return gates.quarantine_rows(reporting.with_derived(staged)).select(
        "reason", "dataelement", "period", "orgunit", "categoryoptioncombo",
        "attributeoptioncombo", "value", "lastupdated")


def quarantine_gate(spark, sf_dir):
    return gates.run_gates(quarantine_counts(spark, sf_dir), max_unresolved_rate=0.10)


def stage_row_counts(spark, sf_dir):
    """Rows entering and passing each resolution step, seen by one action."""
    seen = {}
    rows = fx.data_values(spark, sf_dir)
    steps = [
        ("input", None, None, None),
        ("data_elements", fx.data_elements(spark, sf_dir), "dataelement", {"found": "name"}),
        ("category_combos", fx.category_combos(spark, sf_dir), "categoryoptioncombo",
         {"found": "name"}),
        ("org_units", fx.org_units(spark, sf_dir), "orgunit", {"found": "name"}),
    ]
    for stage, table, on, attributes in steps:
        if table is not None:
            rows = lookup.resolve(rows, table, on, attributes, "found").resolved.drop("found")
        rows, seen[stage] = quality.observe_rows(rows, stage)
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(stage, found.get["row_count"]) for stage, found in seen.items()],
        "stage string, row_count bigint")


def run_metrics(spark, sf_dir):
    """Metrics of a run, appended to their table and read back."""
    totals = quarantine_rate(spark, sf_dir).first()
    path = tables.scratch_path(spark, "metrics")
    metrics = tables.run_metrics(
        spark, load_time(), input_rows=totals.input_rows,
        fact_rows=totals.input_rows - totals.quarantine_rows,
        quarantine_rows=totals.quarantine_rows)
    tables.append_run_metrics(metrics, path)
    return tables.read_like(metrics, path)


# ---- incremental loading and sinks

def fact_periods(spark, sf_dir, raw=None):
    """The periods of the fact with their rows: all that these queries need of it."""
    return fact(spark, sf_dir, raw).groupBy("year_month").agg(F.count(F.lit(1)).alias("row_count"))


def incremental_existing_partitions(spark, sf_dir):
    return incremental.loaded_periods(spark, early_fact(spark, fact_periods(spark, sf_dir)))


def incremental_filter_periods(spark, sf_dir):
    raw = written_values(spark, sf_dir)
    loaded = incremental.loaded_periods(spark, early_fact(spark, fact_periods(spark, sf_dir, raw)))
    return incremental.new_periods(periods.with_period_dates(raw), loaded)


def incremental_required(spark, sf_dir):
    """Whether a second and a third load of the same values have work to do."""
    rows = tables.materialize(fact(spark, sf_dir), "fact")
    path = early_fact(spark, rows)
    pending = incremental.new_periods(rows, incremental.loaded_periods(spark, path))
    second = incremental.load_required(pending)
    tables.write_fact(pending, path)
    left = incremental.new_periods(rows, incremental.loaded_periods(spark, path))
    third = incremental.load_required(left)
    return spark.createDataFrame([("second", second), ("third", third)],
                                 "load string, required boolean")


def incremental_changed_periods(spark, sf_dir):
    """Loaded periods to reopen because their values were updated since."""
    raw = written_values(spark, sf_dir)
    rows = fact(spark, sf_dir, raw)
    held = rows.filter(F.col("lastupdated") < F.lit("1999-01-01").cast("timestamp_ntz"))
    path = tables.scratch_path(spark, "fact")
    tables.write_fact(held, path)
    return incremental.changed_periods(
        periods.with_period_dates(raw), incremental.read_fact(spark, path))


SINK_COLUMNS = ["data_element_id", "org_unit_id", "category_option_combo_id", "value",
                "numeric_value", "year_month"]


def sink_parquet_dynamic_overwrite(spark, sf_dir):
    """A second write replaces its own partitions and leaves the others."""
    rows = tables.materialize(fact(spark, sf_dir).select(*SINK_COLUMNS), "rows")
    path = tables.scratch_path(spark, "sink")
    tables.write_parquet(rows, path, ["year_month"], max_records_per_file=250_000)
    later = rows.filter(F.col("year_month") >= EARLY).withColumn("value", F.lit("revised"))
    tables.write_parquet(later, path, ["year_month"])
    return tables.read_like(rows, path)


def sink_csv_roundtrip(spark, sf_dir):
    rows = fact(spark, sf_dir).select(
        "data_element_id", "org_unit_id", "category_option_combo_id", "year_month",
        "numeric_value", "has_reported_value")
    path = tables.scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def sink_fact_partitioned(spark, sf_dir):
    path = tables.scratch_path(spark, "fact")
    tables.write_fact(fact(spark, sf_dir), path)
    return incremental.read_fact(spark, path).drop("load_timestamp")


def sink_named_tables(spark, sf_dir):
    """Dimensions written by name; rows per table read back."""
    folder = tables.scratch_path(spark, "dimensions")
    named = {
        "dim_data_element": dim_data_element(spark, sf_dir),
        "dim_org_unit": dim_org_unit(spark, sf_dir),
        "dim_program": dim_program(spark, sf_dir),
    }
    tables.write_tables(named, folder)
    counts = [
        spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count") for name in named
    ]
    return counts[0].union(counts[1]).union(counts[2])


def sink_marts(spark, sf_dir):
    """The shares of four marts as the job writes them."""
    rows = tables.materialize(silenced_fact(spark, sf_dir), "fact")
    written = tables.write_tables(marts.all_marts(rows), tables.scratch_path(spark, "analytics"))
    shares = {"completeness_comparison": (["country_name"], "completeness_score"),
              "indicator_coverage_matrix": (marts.SERIES, "coverage_score"),
              "underreporting_facilities": (["country_name", "facility_name"], "reporting_score"),
              "country_reporting_rate": (["country_name", "year_month"], "reporting_rate")}
    parts = [written[name].select(F.lit(name).alias("mart"), F.concat_ws("|", *keys).alias("key"),
                                  F.col(score).alias("score"))
             for name, (keys, score) in shares.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def typed_measures(spark, sf_dir):
    """The fold of the fact with types: percentages average, one element keeps its
    last value, one its greatest, the others add up."""
    kind = F.expr("""case id when 'ECONOMY' then 'AVERAGE' when 'PROMO' then 'LAST'
        when 'SMALL' then 'MAX' when 'STANDARD' then 'SUM' end""")
    elements = fx.data_elements(spark, sf_dir).select(
        F.col("id").alias("data_element_id"), kind.alias("aggregationtype"))
    return measures.with_types(measures.fold_measures(fact(spark, sf_dir)), elements)


def sink_amount_marts(spark, sf_dir):
    """The amounts of the other marts as the job writes them."""
    rows = tables.materialize(silenced_fact(spark, sf_dir), "fact")
    found = marts.all_marts(rows)
    amounts = {"monthly_mom_change": ([*marts.SERIES, "year_month"], "mom_change"),
               "rolling_3month_avg": ([*marts.SERIES, "year_month"], "rolling_3month_avg"),
               "quarterly_global_totals": (["year", "quarter", "data_element_name"], "quarterly_total"),
               "low_completeness_countries": (["country_name"], "completeness_score")}
    written = tables.write_tables({name: found[name] for name in amounts},
                                  tables.scratch_path(spark, "analytics"))
    return reduce(DataFrame.unionByName, [
        written[name].select(F.lit(name).alias("mart"), F.concat_ws("|", *keys).alias("key"),
                             F.round(amount, 6).alias("amount"))
        for name, (keys, amount) in amounts.items()])


def reporting_rate_rolled(spark, sf_dir):
    """Quarterly and yearly reporting rates from bitmaps of two loads: facilities of
    the later months are numbered after those known before."""
    fold = tables.materialize(marts.fold_facilities(silenced_fact(spark, sf_dir)), "facilities")
    early = fold.filter(F.col("year_month") < EARLY)
    known = tables.materialize(rollups.number_facilities(early), "numbers")
    numbers = tables.materialize(rollups.number_facilities(fold, known), "numbers")
    bitmaps = tables.materialize(rollups.reporting_bitmaps(early, known).unionByName(
        rollups.reporting_bitmaps(fold.filter(F.col("year_month") >= EARLY), numbers)), "bitmaps")
    return reduce(DataFrame.unionByName, rollups.rate_marts(bitmaps).values())


#: Averages of amounts with two decimals often end in a 5 at the next digit, where
#: the order of additions would decide how they round.
OFF_TIES = 1.3e-7


def over_measures(operator, amounts):
    def query(spark, sf_dir):
        found = operator(typed_measures(spark, sf_dir))
        return found.withColumns({name: F.round(F.col(name) + OFF_TIES, 6) for name in amounts})
    return query


def materialize_roundtrip(spark, sf_dir):
    rows = fact(spark, sf_dir).select(*SINK_COLUMNS)
    return tables.materialize(rows, "roundtrip", ["year_month"])


REGISTERED = {
    query.__name__: query for query in [
        src_json_document, flatten_nested_array, guard_not_empty, ingest_metadata,
        ingest_reference_metadata, ingest_org_units, ingest_programs, ingest_data_values,
        standardize_column_names, select_existing_columns, prune_columns, period_dates,
        standardize_timestamps, late_reporting, cast_typed_values, missing_value_flags,
        completeness_flags, resolve_data_elements, unresolved_data_elements,
        resolve_category_combos, unresolved_category_combos, enrich_org_hierarchy,
        unresolved_org_units, resolve_registry, hierarchy_levels, hierarchy_names,
        exact_dup_clean, exact_dup_surplus, near_dup_latest, near_dup_superseded,
        near_dup_events_latest, near_dup_events_superseded, duplicate_rate, dq_clean_fact,
        dq_exact_duplicates, dq_superseded, fact_build, dim_data_element, dim_org_unit,
        dim_program, dim_period, contract_schema, contract_nullability, contract_ranges,
        contract_grain, contract_violations, contract_passes, drift_added, drift_removed,
        drift_renamed, drift_summary, dq_profile, completeness_score, quarantine_counts,
        quarantine_rate, quarantine_union, quarantine_gate, stage_row_counts, run_metrics,
        incremental_existing_partitions, incremental_filter_periods, incremental_required,
        incremental_changed_periods, sink_parquet_dynamic_overwrite, sink_csv_roundtrip,
        sink_fact_partitioned, sink_named_tables, materialize_roundtrip,
        jobs.job_two_loads, jobs.job_reopened_month, jobs.job_stale_resend, jobs.job_interrupted,
        near_dup_hot_events, sink_marts, sink_amount_marts,
        drift_changed, drift_written, ingest_pretty_documents, reporting_rate_rolled,
    ]
} | {
    "monthly_by_type": over_measures(measures.typed_monthly, ["monthly_amount"]),
    "monthly_change_by_type": over_measures(
        measures.typed_mom_change, ["monthly_amount", "previous_amount", "mom_change"]),
    "rolling_3month_by_type": over_measures(measures.typed_rolling, ["rolling_amount"]),
    "quarterly_by_type": over_measures(measures.typed_quarterly, ["quarterly_amount"]),
    "monthly_mom_change": over_fact(marts.monthly_mom_change),
    "monthly_mom_change_calendar": over_fact(
        lambda rows: marts.monthly_mom_change(rows, calendar=True)),
    "rolling_3month_avg": over_fact(marts.rolling_3month_avg),
    "rolling_3month_avg_calendar": over_fact(
        lambda rows: marts.rolling_3month_avg(rows, calendar=True)),
    "country_reporting_rate": over_silenced(marts.country_reporting_rate),
    "underreporting_facilities": over_silenced(marts.underreporting_facilities),
    "quarterly_global_totals": over_fact(marts.quarterly_global_totals),
    "completeness_comparison": over_silenced(marts.completeness_comparison),
    "coverage_matrix": over_silenced(marts.indicator_coverage_matrix),
    "low_completeness": over_silenced(marts.low_completeness_countries),
}


def registered() -> dict:
    def shown(query):
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: shown(query) for name, query in REGISTERED.items()}
