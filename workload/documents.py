"""Write the derived inputs as nested documents, one per line."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.sources.tables import scratch_path
from workload import fixtures as fx

#: Rows of a document, about.
MANY = 100
STAMP = "yyyy-MM-dd'T'HH:mm:ss"


def element(df: DataFrame, fields: dict[str, str]):
    """A struct with document field names, of the columns there are; timestamps
    as text."""
    def field(source: str):
        if df.schema[source].dataType.typeName().startswith("timestamp"):
            return F.date_format(source, STAMP)
        return F.col(source)

    return F.struct(*[field(source).alias(name) for name, source in fields.items()
                      if source in df.columns])


def write_documents(documents: DataFrame, name: str, by: list[str] | None = None) -> str:
    path = scratch_path(documents.sparkSession, name)
    documents.write.partitionBy(*by or []).json(path, compression="gzip")
    return path


DATA_ELEMENT = {
    "id": "id", "name": "name", "shortName": "shortname", "code": "code",
    "valueType": "valuetype", "domainType": "domaintype",
    "aggregationType": "aggregationtype", "zeroIsSignificant": "zeroissignificant",
    "created": "created", "lastUpdated": "lastupdated",
}
ORG_UNIT = {
    "id": "id", "name": "name", "shortName": "shortname", "code": "code", "level": "level",
    "path": "path", "created": "created", "lastUpdated": "lastupdated",
}
PROGRAM = {
    "id": "id", "name": "name", "shortName": "shortname", "healthArea": "healtharea",
    "country": "country", "reportingFrequency": "reportingfrequency",
    "dataElements": "dataelements", "created": "created", "lastUpdated": "lastupdated",
}
DATA_VALUE = {
    "dataElement": "dataelement", "period": "period", "orgUnit": "orgunit",
    "categoryOptionCombo": "categoryoptioncombo",
    "attributeOptionCombo": "attributeoptioncombo", "value": "value",
    "storedBy": "storedby", "created": "created", "lastUpdated": "lastupdated",
    "followup": "followup",
}


def metadata_documents(elements: DataFrame, combos: DataFrame) -> str:
    """Each element or combo travels in a document of its own; the other
    array of that document is empty."""
    combo = F.struct(F.col("id"), F.col("name"),
                     F.lit("2024-01-01T00:00:00").alias("created"),
                     F.lit("2024-01-02T00:00:00").alias("lastUpdated"))
    first = elements.select(
        F.lit("2024-02-01").alias("date"), F.array(element(elements, DATA_ELEMENT))
        .alias("dataElements"))
    second = combos.select(
        F.lit("2024-02-01").alias("date"), F.array(combo).alias("categoryOptionCombos"))
    return write_documents(first.unionByName(second, allowMissingColumns=True), "metadata")


def entity_documents(df: DataFrame, payload: str, fields: dict[str, str]) -> str:
    documents = df.select(F.lit("1").alias("version"),
                          F.array(element(df, fields)).alias(payload))
    return write_documents(documents, payload)


def write_pretty(rows: DataFrame, payload: str, bucket: str, name: str) -> str:
    """Pretty-printed documents, a file per bucket of rows; and one that ends too
    early."""
    documents = rows.groupBy(bucket).agg(F.collect_list("item").alias(payload))
    text = documents.select(bucket, F.to_json(
        F.struct(F.lit("1").alias("version"), F.col(payload)), {"pretty": "true"}).alias("value"))
    broken = rows.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias(bucket), F.lit(f'{{\n  "{payload}": [').alias("value"))
    path = scratch_path(rows.sparkSession, name)
    text.unionByName(broken).write.partitionBy(bucket).text(path)
    return path


def pretty_metadata(spark, sf_dir) -> str:
    parts = fx.table(spark, sf_dir, "part")
    item = F.expr("""named_struct('id', concat('P', p_partkey), 'name', p_name,
        'categoryCombo', named_struct('id', concat('CC', p_size), 'name', concat('Combo ', p_size)),
        'dataElementGroups', transform(sequence(1, p_size % 3), n -> named_struct(
            'id', concat('G', n), 'name', concat(p_brand, ' ', n))))""")
    rows = parts.select(F.expr(f"p_partkey div {MANY}").alias("bucket"), item.alias("item"))
    combo = spark.range(1).select(
        F.lit(-2).cast("long").alias("bucket"),
        F.lit('{"version": "1", "categoryOptionCombos": [{"id": "COC", "name": "default"}]}').alias("value"))
    path = write_pretty(rows, "dataElements", "bucket", "pretty_metadata")
    combo.write.mode("append").partitionBy("bucket").text(path)
    return path


def pretty_org_units(spark, sf_dir) -> str:
    customer = fx.table(spark, sf_dir, "customer")
    item = F.expr("""named_struct('id', concat('C', c_custkey), 'name', c_name,
        'parent', if(c_acctbal < 0, null, named_struct('id', concat('N', c_nationkey), 'name', c_mktsegment)),
        'groups', array(named_struct('id', c_mktsegment, 'name', concat('Group ', c_mktsegment))))""")
    return write_pretty(customer.select(F.expr(f"c_custkey div {MANY}").alias("bucket"), item.alias("item")),
                        "organisationUnits", "bucket", "pretty_units")


def value_documents(sent: DataFrame, first: Column | None = None) -> str:
    """Documents of at most about ``MANY`` values of a unit and period; a value
    sent twice appears twice. One document has no array and one an empty array.

    Rows with a ``parcel`` stay with it: rows that met by it are counted and grouped
    where they are, in one pass and without a shuffle. A hash of the value's own key
    deals a parcel to as many documents as its number of values asks for, so one that
    holds much of the table is no group of its own. Without parcels a unit and
    period is dealt so, by the numbers of a map-side combined count.

    With ``first``, values for which it holds lie in the folder ``first=1`` and the
    others in ``first=0``: an export of the former is part of the export of all."""
    key = ["orgunit", "period"]
    if first is not None:
        sent, key = sent.withColumn("first", F.coalesce(first.cast("int"), F.lit(0))), [*key, "first"]
    if "parcel" in sent.columns:
        held = F.count(F.lit(1)).over(Window.partitionBy("parcel"))
        dealt, place = sent.withColumn("documents", F.ceil(held / MANY)), ["parcel", *key]
    else:
        counts = sent.groupBy("orgunit", "period").agg(F.count(F.lit(1)).alias("values_held")).filter(
            F.col("values_held") > MANY).select(
            F.col("orgunit").alias("large_orgunit"), F.col("period").alias("large_period"),
            F.ceil(F.col("values_held") / MANY).alias("documents"))
        dealt, place = sent.join(counts, (F.col("orgunit") == F.col("large_orgunit"))
                                 & (F.col("period") == F.col("large_period")), "left"), key
    dealt = dealt.withColumn(
        "document", F.pmod(F.xxhash64("attributeoptioncombo"), F.coalesce("documents", F.lit(1))))
    copies = F.array_repeat(element(sent, DATA_VALUE), F.col("sent"))
    documents = dealt.groupBy(*place, "document").agg(
        F.flatten(F.collect_list(copies)).alias("dataValues"))
    kind = documents.schema["dataValues"].dataType
    bare = sent.sparkSession.range(0, 2, 1, 1).select(
        F.when(F.col("id") == 0, F.array().cast(kind)).alias("dataValues"), F.lit(1).alias("first"))
    folder = ["first"] if first is not None else []
    return write_documents(documents.select("dataValues", *folder).union(
        bare.select("dataValues", *folder)).select(
        F.lit("dataValueSet").alias("responseType"), "dataValues", *folder), "dataValues", folder)
