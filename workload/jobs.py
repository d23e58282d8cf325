"""The whole reporting job over documents made from the given tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.plans import reporting
from fieldtally.sources import tables
from workload import documents as docs
from workload import fixtures as fx

EARLY = "199801"
REOPENED = "199706"
OPTIONS = {"max_quarantine_rate": 1.0}


def inputs(spark, sf_dir, values: DataFrame | str) -> reporting.Inputs:
    """Documents of all tables; those of values may be written already."""
    elements, combos = fx.data_elements(spark, sf_dir), fx.category_combos(spark, sf_dir)
    metadata = docs.metadata_documents(elements, combos)
    return reporting.Inputs(
        metadata, metadata,
        docs.entity_documents(fx.org_units(spark, sf_dir), "organisationUnits", docs.ORG_UNIT),
        docs.entity_documents(fx.programs(spark, sf_dir), "programs", docs.PROGRAM),
        values if isinstance(values, str) else docs.value_documents(values), lines=True)


def early_and_all(spark, sf_dir) -> tuple[str, str]:
    """Documents of the values before 199801, and of all, written once."""
    path = docs.value_documents(fx.sent_values(spark, sf_dir), F.col("period") < EARLY)
    return f"{path}/first=1", path


def run(spark, sf_dir, values: DataFrame | str, output: str, **options) -> None:
    reporting.run_reporting(spark, inputs(spark, sf_dir, values), output,
                            reporting.Options(**OPTIONS, **options))


def fact_path(output: str) -> str:
    return f"{output}/facts/fact_service_delivery"


def job_two_loads(spark, sf_dir):
    """Rows per load and outcome: the periods before 199801, then everything."""
    output = tables.scratch_path(spark, "job")
    early, sent = early_and_all(spark, sf_dir)
    run(spark, sf_dir, early, output)
    first = [row.run_id for row in spark.read.parquet(f"{output}/run_metrics").select("run_id").collect()]
    run(spark, sf_dir, sent, output)
    rejected = spark.read.parquet(f"{output}/quarantine").select(
        F.when(F.col("run_id").isin(first), "first").otherwise("second").alias("load"),
        F.col("reason").alias("outcome"))
    kept = spark.read.parquet(fact_path(output)).select(
        F.when(F.col("year_month") < EARLY, "first").otherwise("second").alias("load"),
        F.lit("fact").alias("outcome"))
    return rejected.union(kept).groupBy("load", "outcome").agg(F.count(F.lit(1)).alias("row_count"))


def job_reopened_month(spark, sf_dir):
    """The fact after an export corrects one month for half of the units."""
    output = tables.scratch_path(spark, "job")
    sent = fx.sent_values(spark, sf_dir)
    run(spark, sf_dir, sent, output)
    corrected = fx.sent_values(spark, sf_dir, REOPENED).filter(F.col("orgunit").rlike("[02468]$"))
    corrected = corrected.withColumn("value", F.lit("7")).withColumn(
        "lastupdated", F.expr("lastupdated + interval 10 years"))
    run(spark, sf_dir, corrected, output, refresh_changed=True)
    return spark.read.parquet(fact_path(output)).select(
        "data_element_id", "org_unit_id", "category_option_combo_id",
        F.col("year_month").cast("string").alias("year_month"), "value")


def job_stale_resend(spark, sf_dir):
    """The fact and the rejects by reason after an export resends one month: for
    half of the units with earlier updates, for the others with later ones."""
    output = tables.scratch_path(spark, "job")
    sent = fx.sent_values(spark, sf_dir)
    run(spark, sf_dir, sent, output)
    stale = F.col("orgunit").rlike("[02468]$")
    resent = fx.sent_values(spark, sf_dir, REOPENED).withColumns({
        "value": F.when(stale, "7").otherwise("9"),
        "lastupdated": F.when(stale, F.expr("lastupdated - interval 10 years"))
        .otherwise(F.expr("lastupdated + interval 10 years"))})
    run(spark, sf_dir, resent, output, refresh_changed=True)
    fact = spark.read.parquet(fact_path(output)).select(
        F.lit("fact").alias("outcome"),
        F.concat_ws("|", "data_element_id", "org_unit_id", "category_option_combo_id", "year_month")
        .alias("key"), "value", F.lit(1).cast("long").alias("row_count"))
    rejected = spark.read.parquet(f"{output}/quarantine").groupBy(
        F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))
    return fact.unionByName(rejected, allowMissingColumns=True)


class Interrupted(Exception):
    pass


def interrupt(at: str):
    def step(reached):
        if reached == at:
            raise Interrupted(at)
    return step


def job_interrupted(spark, sf_dir):
    """What is published after a first load that died before it was committed, was
    repeated and died once more before its tables were in place, and a second load
    of the rest."""
    output = tables.scratch_path(spark, "job")
    first, sent = early_and_all(spark, sf_dir)
    early = inputs(spark, sf_dir, first)
    for step in ("marts", "committed"):
        try:
            reporting.run_reporting(spark, early, output,
                                    reporting.Options(**OPTIONS, on_step=interrupt(step)))
        except Interrupted:
            continue
        raise AssertionError(f"The run did not reach {step}")
    run(spark, sf_dir, sent, output)

    def part(name, table, key, amount):
        return spark.read.parquet(f"{output}/{table}").select(
            F.lit(name).alias("part"), key.alias("key"), amount.cast("double").alias("amount"))

    metrics = spark.read.parquet(f"{output}/run_metrics").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("fact_rows").alias("fact_rows"),
        F.sum("quarantine_rows").alias("quarantine_rows"), F.count(F.lit(1)).alias("runs"))
    counted = F.array(*[F.struct(F.lit(name).alias("key"), F.col(name).cast("double").alias("amount"))
                        for name in metrics.columns])
    statistics = part("statistics", "facts/period_statistics", F.col("year_month"), F.col("row_count"))
    fact = part("fact", "facts/fact_service_delivery", F.col("year_month").cast("string"), F.lit(1))
    return statistics.unionByName(
        fact.groupBy("part", "key").agg(F.sum("amount").alias("amount"))).unionByName(
        part("monthly", "analytics/monthly_mom_change",
             F.concat_ws("|", "country_name", "data_element_name", "year_month"),
             F.round("monthly_total", 6))).unionByName(
        part("coverage", "analytics/indicator_coverage_matrix",
             F.concat_ws("|", "country_name", "data_element_name"), F.col("coverage_score"))).unionByName(
        metrics.select(F.lit("metrics").alias("part"), F.inline(counted)))
