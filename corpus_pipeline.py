"""The corpus pipeline: stages over documents, each written and read again.

toxicity      drops documents with a toxic passage score of 0.5 or more
near_copies   keeps one document of each class of near copies
pii           replaces personal data in the texts
mixing        repeats documents so that languages near their target weights;
              no rate falls below 1, so no document is lost
byte_bpe      gives the token ids of each document

Defined results: a null text counts as empty and is never toxic; documents without
doc_id, empty texts and repeated rows pass every stage that does not name them (equal
texts are near copies, of which one stays); an empty table gives an empty table; extra
columns come back unchanged until the last stage, which returns doc_id and ids,
whatever their names are.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm import byte_bpe, mixing, near_copies, pii, toxicity
from fieldtally.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A language's target share is its present share to this power.
FLATTEN = 0.7


def shielded(stage: Stage) -> Stage:
    """A stage that sees only doc_id and text under their names: whatever other
    columns the documents have come back as they were, also those named like a
    result of the stage."""
    def run_shielded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {name: name if name in ("doc_id", "text") else f"document_column_{i}"
                 for i, name in enumerate(docs.columns)}
        done = stage(spark, docs.toDF(*names.values()), sf_dir)
        return done.select(*[F.col(held).alias(name) for name, held in names.items()])

    return run_shielded


@shielded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).where("predicted = 0").select(*docs.columns)


@shielded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.without_copies(docs)


@shielded
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs, pii.train(pii.labelled_table(spark)))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().join(
        docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")
    rates = mixing.mix(docs, labelled, flatten=FLATTEN, least=1.0)
    return mixing.repeat_documents(docs, rates)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_languages),
    ("byte_bpe", encode),
]

#: The stages learn models and hash weighted samples, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
