"""The complete reporting job: documents to star schema, marts and quarantine."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.constants import (
    CATEGORY_COMBO_ATTRIBUTES, DATA_ELEMENT_ATTRIBUTES, DATA_VALUE_COLUMNS, FACT_COLUMNS,
    FACT_CONTRACT, FACT_PARTITION, HIERARCHY_LEVELS, MAX_QUARANTINE_RATE, MIN_FACT_ROWS,
)
from fieldtally.functions.columns import present
from fieldtally.functions.periods import period_start, with_period_dates
from fieldtally.operators.contract import ContractError, enforce_contract
from fieldtally.operators.drift import drift_summary, drift_tables, snapshot_diff
from fieldtally.operators.gates import (
    GateError, enforce_gates, outcome_counts, quarantine_rows, quarantine_union, run_gates,
)
from fieldtally.operators.hierarchy import level_names, path_levels
from fieldtally.operators.lookup import attach, lookup_table, reject_reason
from fieldtally.operators.marts import fold_facilities, fold_series, marts_of_folds
from fieldtally.operators.measures import fold_measures, typed_marts
from fieldtally.operators.quality import CLEAN, judge, with_value_flags
from fieldtally.operators.rollups import number_facilities, rate_marts, reporting_bitmaps
from fieldtally.operators.star import (
    build_fact, dim_data_element, dim_org_unit, dim_period, dim_program,
)
from fieldtally.sources import documents, incremental, publish, tables

FACT = "facts/fact_service_delivery"
PERIOD_STATISTICS = "facts/period_statistics"
# folds of the fact by month: what the marts need of a month
FOLDS = {"facts/fold_series": fold_series, "facts/fold_facilities": fold_facilities}
MEASURE_FOLD = {"facts/fold_measures": fold_measures}
FACILITY_NUMBERS = "facts/facility_numbers"
BITMAPS = "facts/reporting_bitmaps"
BAD_PERIOD = "bad_period"
CORRUPT = "corrupt_document"

# first reason wins, in this order: reason to the attribute that must be there
RESOLUTION_ORDER = {
    "unresolved_data_elements": "data_element_name",
    "unresolved_category_option_combos": "category_option_combo_name",
    "unresolved_org_units": "facility_name",
}


@dataclass(frozen=True)
class Inputs:
    metadata: str
    reference_metadata: str
    org_units: str
    programs: str
    data_values: str
    lines: bool = False


@dataclass(frozen=True)
class Options:
    incremental: bool = True
    refresh_changed: bool = False
    max_quarantine_rate: float = MAX_QUARANTINE_RATE
    max_unresolved_rate: float | None = None
    min_fact_rows: int = MIN_FACT_ROWS
    #: Also write marts that average, add up or keep the last value as the element says.
    by_aggregation_type: bool = False
    #: Also write reporting rates of quarters and years.
    rolled_rates: bool = False
    #: Called as the run gets on, with 'fact', 'marts', 'staged' and 'committed'.
    on_step: Callable[[str], None] = lambda step: None


def build_hierarchy(org_units: DataFrame) -> DataFrame:
    return level_names(path_levels(org_units))


def attach_lookups(values: DataFrame, elements: DataFrame, combos: DataFrame,
                   hierarchy: DataFrame) -> DataFrame:
    """Values with the attributes of element, category combo and organisation
    unit; what is not found stays NULL. One pass, no row is split off yet.

    Units are the largest lookup, and may be joined by shuffle: they come first,
    while rows are narrow."""
    held = {name: source for name, source in DATA_ELEMENT_ATTRIBUTES.items()
            if source in elements.columns}
    names = {f"{level}_name": f"{level}_name" for level in HIERARCHY_LEVELS}
    columns = [*values.columns, *held, *CATEGORY_COMBO_ATTRIBUTES, *names]
    steps = {
        "orgunit": (hierarchy, names),
        "dataelement": (elements, held),
        "categoryoptioncombo": (combos, CATEGORY_COMBO_ATTRIBUTES),
    }
    lookups = tables.side_by_side(
        lambda step: lookup_table(step[0], "id", step[1]), list(steps.values()))
    for on, lookup in zip(steps, lookups):
        values = attach(values, on, lookup)
    return values.select(*columns)


def raw_values(values: DataFrame) -> DataFrame:
    return values.select(*present(values, DATA_VALUE_COLUMNS))


def judge_values(raw: DataFrame, elements: DataFrame, combos: DataFrame,
                 hierarchy: DataFrame) -> DataFrame:
    """Distinct raw values of a written table with their copies, attributes, flags
    and an outcome each.

    One shuffle, of the narrow raw columns only and by unit, folds copies and ranks.
    Lookups hold one row per key, so equal raw rows stay equal; and whether a row resolves
    depends on its business key alone, so rejected rows never compete with accepted
    ones. Attributes are attached last."""
    return with_derived(judge_raw(raw, elements, combos, hierarchy))


def judge_raw(raw: DataFrame, elements: DataFrame, combos: DataFrame,
              hierarchy: DataFrame) -> DataFrame:
    """``judge_values`` without what a row alone decides."""
    known = attach_lookups(judge(raw, meet="orgunit"), elements, combos, hierarchy)
    bad_period = F.when(period_start(F.col("period")).isNull(), F.lit(BAD_PERIOD))
    reason = F.coalesce(bad_period, reject_reason(RESOLUTION_ORDER), F.col("outcome"))
    return known.withColumn("outcome", reason)


def with_derived(judged: DataFrame) -> DataFrame:
    """Period columns, typed values and flags: all that follows from a row itself,
    so it is added after rows have moved."""
    return with_value_flags(with_period_dates(judged))


def clean_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("outcome") == CLEAN).drop("outcome", "copies")


def run_reporting(spark: SparkSession, inputs: Inputs, output: str,
                  options: Options = Options()) -> str:
    """Run the job below ``output``; returns 'success' or 'no_new_periods'.

    Every value of the export that is pending ends in the fact or in the
    quarantine of this run, whatever the status. All tables are published together
    (``sources/publish.py``); a run that fails a check publishes drift and
    quarantine only, one that dies publishes nothing. Staged tables are deleted at
    the end."""
    with tables.run_staging(spark):
        return load(spark, inputs, output, options)


def load(spark: SparkSession, inputs: Inputs, output: str, options: Options) -> str:
    release = publish.open_release(spark, output)
    try:
        status = stage_run(spark, inputs, release, options)
    except (GateError, ContractError, ValueError):
        release.publish(release.commit(failed=True))
        raise
    options.on_step("staged")
    manifest = release.commit()
    options.on_step("committed")
    release.publish(manifest)
    return status


def stage_run(spark: SparkSession, inputs: Inputs, release: publish.Release,
              options: Options) -> str:
    """Write all tables of the run beside the published ones."""
    (elements, combos, reference, org_units, programs), corrupt = read_entities(spark, inputs)
    parsed = documents.parse_data_values(spark, inputs.data_values, inputs.lines)
    values, corrupt = parsed.rows, tables.materialize(corrupt.unionByName(parsed.corrupt), "corrupt")

    diff = tables.materialize(snapshot_diff(elements, reference), "diff")
    drift = release.stage_all(drift_tables(diff), "metadata_drift", evidence=True)
    drift.pop("changed_data_elements")
    release.stage_all({"summary": drift_summary(drift)}, "metadata_drift", evidence=True)

    statistics = incremental.stored_statistics(
        spark, f"{release.output}/{FACT}", f"{release.output}/{PERIOD_STATISTICS}")
    if options.incremental:
        values = pending_values(values, statistics, options.refresh_changed)
    raw = raw_values(values)

    hierarchy = tables.materialize(build_hierarchy(org_units), "hierarchy")
    # outcomes stay mixed: with a folder each, the small ones would be one task's work
    staged = tables.materialize(judge_raw(raw, elements, combos, hierarchy), "judged")
    judged, counts = with_derived(staged), tables.materialize(outcome_counts(staged), "counts")
    # one load time for the whole run
    loaded_at = F.lit(spark.sql("select current_timestamp() as now").first().now)
    fact, lost = build_fact(clean_rows(judged), loaded_at), {}
    if options.refresh_changed:
        fact, lost = merge_reopened(fact, judged, statistics, f"{release.output}/{FACT}")
    if not lost:
        gathered = clean_rows(staged).hint("rebalance", F.col("period"))
        fact = build_fact(with_derived(gathered), loaded_at)
    stage_quarantine(release, staged, corrupt, lost)
    documents.require_rows(parsed.rows, f"{inputs.data_values} dataValues")

    # rows without a readable period never load, so they alone are no reason to run
    if not incremental.load_required(raw.filter(period_start(F.col("period")).isNotNull())):
        stage_metrics(release, counts, corrupt, lost, "no_new_periods")
        return "no_new_periods"
    enforce_gates(run_gates(counts, options.max_quarantine_rate, options.min_fact_rows,
                            options.max_unresolved_rate))
    element_dimension = dim_data_element(elements)
    stage_fact(release, fact, statistics, element_dimension, options, gathered=not lost)
    release.stage_all({
        "dim_data_element": element_dimension,
        "dim_org_unit": dim_org_unit(hierarchy),
        "dim_program": dim_program(programs),
    }, "dimensions")
    stage_metrics(release, counts, corrupt, lost, "success")
    return "success"


def stage_fact(release: publish.Release, fact: DataFrame, statistics: DataFrame,
               element_dimension: DataFrame, options: Options, gathered: bool = False) -> None:
    """The touched periods of the fact and of its folds, and what follows from
    all periods: statistics, the period dimension and the marts. Of periods the run
    does not touch only folds and statistics are read. Rows that are ``gathered`` by
    period are written as they come."""
    spark, output = release.spark, release.output
    fact = release.stage_partitions(fact, FACT, FACT_PARTITION, gathered)
    options.on_step("fact")
    enforce_contract(fact, FACT_CONTRACT)
    fresh = tables.materialize(incremental.partition_statistics(fact), "fresh")
    # as many as there are months in the run
    touched = [row[0] for row in fresh.select(FACT_PARTITION).collect()]

    held = release.stage(
        incremental.replace_periods(statistics, fresh, touched), PERIOD_STATISTICS)

    def whole_fold(name: str) -> DataFrame:
        here = release.stage_partitions(folds[name](fact), name, FACT_PARTITION)
        stored = stored_fold(spark, output, name, folds[name], statistics, here)
        return tables.materialize(incremental.replace_periods(stored, here, touched), "fold")

    folds = FOLDS | (MEASURE_FOLD if options.by_aggregation_type else {})
    series, facilities, *typed = tables.side_by_side(whole_fold, list(folds))
    marts = marts_of_folds(series, facilities)
    if typed:
        marts |= typed_marts(typed[0], element_dimension)
    if options.rolled_rates:
        marts |= rate_marts(stage_bitmaps(release, facilities, touched))
    release.stage_all({"dim_period": dim_period(held)}, "dimensions")
    release.stage_all(marts, "analytics")
    options.on_step("marts")


def stage_bitmaps(release: publish.Release, facilities: DataFrame, touched: list[str]) -> DataFrame:
    """Numbers of all facilities, and the bitmaps of the touched months beside those
    of the others; all months anew if numbers or bitmaps are lost."""
    spark, output = release.spark, release.output
    months = {row[0] for row in facilities.select(FACT_PARTITION).distinct().collect()}
    folders = {unquote(part.split("=", 1)[1])
               for part in publish.folder_names(spark, f"{output}/{BITMAPS}") if "=" in part}
    kept = publish.exists(spark, f"{output}/{FACILITY_NUMBERS}") and months <= folders | set(touched)
    known = spark.read.parquet(f"{output}/{FACILITY_NUMBERS}") if kept else None
    numbers = release.stage(number_facilities(facilities, known), FACILITY_NUMBERS)
    fresh = facilities.filter(F.col(FACT_PARTITION).isin(touched)) if kept else facilities
    here = release.stage_partitions(reporting_bitmaps(fresh, numbers), BITMAPS, FACT_PARTITION)
    if not kept or not folders:
        return here
    stored = spark.read.schema(here.schema).parquet(f"{output}/{BITMAPS}")
    return tables.materialize(incremental.replace_periods(stored, here, touched), "bitmaps")


def stored_fold(spark: SparkSession, output: str, name: str, fold: Callable,
                statistics: DataFrame, like: DataFrame) -> DataFrame:
    """The published fold of the fact, or of the whole stored fact where it is lost."""
    known = {row[0] for row in statistics.select(FACT_PARTITION).collect()}
    folders = {unquote(part.split("=", 1)[1])
               for part in publish.folder_names(spark, f"{output}/{name}") if "=" in part}
    if known <= folders:
        return spark.read.schema(like.schema).parquet(f"{output}/{name}") if folders else like.limit(0)
    return fold(incremental.read_fact(spark, f"{output}/{FACT}"))


def merge_reopened(fact: DataFrame, judged: DataFrame, statistics: DataFrame,
                   fact_path: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact rows to store, and those that lost by reason: stored rows of the
    periods the run touches compete with the rows sent. Only the folders of those
    periods are read."""
    sent = judged.filter(F.col("outcome") == CLEAN).select("year_month").distinct()
    reopened = [row[0] for row in statistics.join(sent, FACT_PARTITION).select(FACT_PARTITION).collect()]
    if not reopened:
        return fact, {}
    stored = fact.sparkSession.read.schema(fact.schema).parquet(fact_path).filter(
        F.col(FACT_PARTITION).isin(reopened))
    merged = tables.materialize(incremental.merge_stored(
        fact, stored, FACT_CONTRACT["primary_grain"], ["lastupdated", "created", "value"]), "merged",
        ["merge_outcome"])
    rows = {outcome: merged.filter(F.col("merge_outcome") == outcome).drop("merge_outcome")
            for outcome in (incremental.KEPT, incremental.REPEATED, incremental.STALE, incremental.REPLACED)}
    return rows.pop(incremental.KEPT), rows


def rejects_of(staged: DataFrame) -> DataFrame:
    """Rejects of rows judged without what a row alone decides, which is added to the
    rejects only."""
    rejects = with_derived(quarantine_rows(staged))
    return rejects.select(*[name for name in rejects.columns if name != "reason"], "reason")


def stage_quarantine(release: publish.Release, staged: DataFrame, corrupt: DataFrame,
                     lost: dict[str, DataFrame]) -> None:
    """Rejects of a run in a folder of their own, with their ``reason``; earlier
    runs keep theirs. The folder can be read when there are none. Rows that lost
    against the stored fact (or were replaced in it) carry its columns."""
    names = {fact: raw for raw, fact in FACT_COLUMNS.items()}
    rejected = rejects_of(staged).unionByName(
        corrupt.withColumn("reason", F.lit(CORRUPT)), allowMissingColumns=True)
    if lost:
        late = quarantine_union({
            reason: df.withColumn("period", F.col(FACT_PARTITION)).withColumnsRenamed(names)
            for reason, df in lost.items()})
        rejected = rejected.unionByName(late, allowMissingColumns=True)
    release.stage(rejected, f"quarantine/run_id={release.run_id}", evidence=True)


def stage_metrics(release: publish.Release, counts: DataFrame, corrupt: DataFrame,
                  lost: dict[str, DataFrame], status: str) -> None:
    """One more row of run metrics. Stored rows that were replaced were counted
    when they were sent, so they are told apart."""
    rows = {row.outcome: row.row_count for row in counts.collect()}
    late = {reason: df.count() for reason, df in lost.items()}
    replaced = late.pop(incremental.REPLACED, 0)
    quarantined = sum(count for outcome, count in rows.items() if outcome != CLEAN)
    clean = rows.get(CLEAN, 0)
    metrics = tables.run_metrics(
        release.spark, status=status, input_rows=quarantined + clean,
        fact_rows=clean - sum(late.values()), quarantine_rows=quarantined + sum(late.values()),
        replaced_rows=replaced, corrupt_documents=corrupt.count())
    release.stage_rows(metrics.withColumn("run_id", F.lit(release.run_id)), "run_metrics")


def read_entities(spark: SparkSession, inputs: Inputs) -> tuple[list[DataFrame], DataFrame]:
    """Data elements, category combos, reference elements, units and programs, which
    drift, lookups and dimensions all read; and the documents of any of them that
    could not be read in full."""
    sources = [
        (documents.parse_metadata, inputs.metadata),
        (documents.parse_reference_metadata, inputs.reference_metadata),
        (documents.parse_org_units, inputs.org_units),
        (documents.parse_programs, inputs.programs),
    ]
    (elements, combos), *others = tables.side_by_side(
        lambda source: source[0](spark, source[1], inputs.lines), sources)
    found = [elements, combos, *others]
    corrupt = reduce(DataFrame.unionByName, [parsed.corrupt for parsed in found])
    return tables.side_by_side(
        lambda parsed: tables.materialize(parsed.rows, "entity"), found), corrupt


def pending_values(values: DataFrame, statistics: DataFrame,
                   refresh_changed: bool = False) -> DataFrame:
    """Values of periods still to load; rows without a period stay, to be
    quarantined. ``refresh_changed`` reopens periods with later updates."""
    loaded = statistics.select(FACT_PARTITION)
    if refresh_changed:
        reopened = incremental.changed_periods(values, statistics)
        loaded = loaded.join(reopened, FACT_PARTITION, "left_anti")
    return incremental.new_periods(values, loaded, keep_null=True)
