"""Reporting inputs derived from the given tables.

A line item is a reported value: its part type is the data element, the order
month the period, the customer the facility and its flags the category combo.
Some codes point nowhere, some values are missing, zero or blank, and some rows
are sent twice. ``oracle.py`` states the same inputs in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.operators.lookup import broadcast_if_small
from fieldtally.plans.reporting import build_hierarchy

VALUE_TYPE = """
    case p_type when 'STANDARD' then 'INTEGER_POSITIVE'
        when 'SMALL' then 'INTEGER_ZERO_OR_POSITIVE' when 'PROMO' then 'NUMBER'
        when 'ECONOMY' then 'PERCENTAGE' when 'MEDIUM' then 'BOOLEAN' else 'TEXT' end
"""
REPORTED_VALUE = """
    case when l_discount > 0.095 then null when l_tax < 0.005 then '0'
        when l_quantity = 13 then ''
        when p_type = 'MEDIUM' then if(l_quantity <= 25, 'true', 'false')
        when p_type in ('PROMO', 'ECONOMY')
            then cast(cast(l_extendedprice as decimal(15, 2)) as string)
        else cast(cast(l_quantity as int) as string) end
"""
# text of mixed quality read as a number or a flag
MIXED_TEXT = """
    case l_linenumber when 1 then cast(cast(l_quantity as int) as string)
        when 2 then concat(' ', cast(l_quantity as int), ' ')
        when 3 then concat('-', cast(l_quantity as int), '.7')
        when 4 then concat('n', cast(l_quantity as int))
        when 5 then concat(cast(l_quantity as int), '00000000')
        when 6 then if(l_quantity <= 25, 'true', 'FALSE')
        else if(l_quantity <= 25, '', null) end
"""
MIXED_TYPE = """
    case concat(l_returnflag, l_linestatus) when 'RF' then 'INTEGER'
        when 'RO' then 'INTEGER_POSITIVE' when 'AF' then 'NUMBER'
        when 'AO' then 'PERCENTAGE' when 'NF' then 'BOOLEAN' else 'TEXT' end
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def data_elements(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_type").distinct().selectExpr(
        "p_type as id", "concat('Indicator ', p_type) as name", f"{VALUE_TYPE} as valuetype")


def element_registry(spark, sf_dir):
    """Every part as a data element, some in two versions."""
    parts = table(spark, sf_dir, "part")
    versions = parts.withColumn("version", F.explode(F.expr("sequence(1, if(p_size <= 5, 2, 1))")))
    return versions.selectExpr(
        "concat('P', p_partkey) as id",
        "if(version = 1, p_name, concat('old ', p_name)) as name",
        "p_brand as shortname", "concat(p_brand, '-', p_partkey) as code",
        f"{VALUE_TYPE} as valuetype", "'AGGREGATE' as domaintype",
        "if(p_type = 'ECONOMY', 'AVERAGE', 'SUM') as aggregationtype",
        "p_size > 25 as zeroissignificant",
        "timestamp_ntz '2024-01-01 00:00:00' as created",
        "if(version = 1, timestamp_ntz '2024-02-01 08:30:00', "
        "timestamp_ntz '2024-01-15 00:00:00') as lastupdated")


def category_combos(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    return flags.selectExpr("concat(l_returnflag, l_linestatus) as id",
                            "concat('Combo ', l_returnflag, l_linestatus) as name")


def org_units(spark, sf_dir):
    """Region, nation, nation segment and customer; overdrawn customers are
    not registered."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))
    segment = "concat('S', n_nationkey, c_mktsegment)"
    levels = [
        region.selectExpr("concat('R', r_regionkey) as id", "r_name as name", "1 as level",
                          "concat('/R', r_regionkey) as path"),
        nation.selectExpr("concat('N', n_nationkey) as id", "n_name as name", "2 as level",
                          "concat('/R', n_regionkey, '/N', n_nationkey) as path"),
        customer.select("n_nationkey", "n_regionkey", "n_name", "c_mktsegment").distinct()
        .selectExpr(f"{segment} as id", "concat(c_mktsegment, ' of ', n_name) as name",
                    "3 as level",
                    f"concat('/R', n_regionkey, '/N', n_nationkey, '/', {segment}) as path"),
        customer.filter("c_acctbal >= -500").selectExpr(
            "concat('C', c_custkey) as id", "c_name as name", "4 as level",
            f"concat('/R', n_regionkey, '/N', n_nationkey, '/', {segment}, '/C', c_custkey) "
            "as path"),
    ]
    units = levels[0].union(levels[1]).union(levels[2]).union(levels[3])
    return units.selectExpr(
        "id", "name", "concat('short ', name) as shortname", "concat('code ', id) as code",
        "level", "path", "timestamp_ntz '2023-06-01 00:00:00' as created",
        "timestamp_ntz '2023-07-01 12:00:00' as lastupdated")


def hierarchy(spark, sf_dir):
    return build_hierarchy(org_units(spark, sf_dir))


def programs(spark, sf_dir):
    """One program per nation and customer segment, covering all part types."""
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return customer.select("n_nationkey", "n_name", "c_mktsegment").distinct().selectExpr(
        "concat('PR', n_nationkey, c_mktsegment) as id",
        "concat(c_mktsegment, ' program ', n_name) as name", "c_mktsegment as shortname",
        "c_mktsegment as healtharea", "n_name as country",
        "'MONTHLY' as reportingfrequency",
        "array('ECONOMY', 'PROMO', 'STANDARD') as dataelements",
        "timestamp_ntz '2023-01-01 00:00:00' as created",
        "timestamp_ntz '2023-02-01 00:00:00' as lastupdated")


def sent_values(spark, sf_dir, month: str | None = None):
    """One row per line item (of one month, if given), with its order as ``parcel``
    and the number of times it was sent.

    What a line item and its part decide is computed before the line items meet
    their orders, and they stay dealt by order after that. The orders of one month
    are broadcast if few, so no other line items move."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yyyyMM') as period",
        "concat('C', o_custkey) as orgunit", "o_orderdate as created")
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    if month:
        few = broadcast_if_small(orders.filter(F.col("period") == month), "orders")
        lineitem = lineitem.join(few, of_order)
    values = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "if(p_size = 50, 'GHOST_DE', p_type) as dataelement",
        "if(l_tax > 0.075, 'GHOST_COC', concat(l_returnflag, l_linestatus)) "
        "as categoryoptioncombo",
        f"{REPORTED_VALUE} as value", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_shipdate as lastupdated", "if(l_discount < 0.005, 2, 1) as sent",
        *(["period", "orgunit", "created"] if month else []))
    return (values if month else values.join(orders, of_order)).selectExpr(
        "dataelement", "period", "orgunit", "categoryoptioncombo",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as attributeoptioncombo",
        "value", "concat('clerk', l_suppkey) as storedby", "created", "lastupdated",
        "'false' as followup", "sent", "l_orderkey as parcel")


def data_values(spark, sf_dir):
    sent = sent_values(spark, sf_dir)
    return sent.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("sent")))).drop(
        "sent", "parcel", "copy")


def mixed_values(spark, sf_dir):
    """Every line item as text of mixed quality with a value type."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        f"{MIXED_TEXT} as value", f"{MIXED_TYPE} as value_type")


def current_snapshot(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size <> 9").selectExpr(
        "concat('P', p_partkey) as id", "p_name as name", "p_brand as shortname")


def reference_snapshot(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size <> 3").selectExpr(
        "concat('P', p_partkey) as id",
        "if(p_size in (1, 2), concat('old ', p_name), p_name) as name", "p_brand as shortname")


def current_versions(spark, sf_dir):
    """Elements of one snapshot, some in two versions of which the later counts."""
    parts = table(spark, sf_dir, "part").filter("p_size <> 9").withColumn(
        "version", F.explode(F.expr("sequence(1, if(p_size = 7, 2, 1))")))
    return parts.selectExpr(
        "concat('P', p_partkey) as id", "if(version = 1, p_name, 'older') as name",
        "p_brand as shortname", "if(p_size = 6, null, p_type) as code",
        "if(version = 1, timestamp_ntz '2024-02-01 00:00:00', timestamp_ntz '2024-01-01 00:00:00') "
        "as lastupdated")


def reference_versions(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size <> 3").selectExpr(
        "concat('P', p_partkey) as id",
        "case when p_size in (1, 2) then concat('old ', p_name) when p_size = 8 then null else p_name end as name",
        "if(p_size = 5, null, p_brand) as shortname", "if(p_size in (2, 4), 'X', p_type) as code",
        "timestamp_ntz '2023-01-01 00:00:00' as lastupdated")
