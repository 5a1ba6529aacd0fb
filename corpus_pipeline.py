"""A corpus pipeline in five stages, each one operator over all that the stage before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``documents``; what a stage decides takes effect on its rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, mixing, pii, simhash, toxicity
from weftline.llm.common import checkpointed, shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PII_KEY = "example key"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold.

    The model learns from labelled rows of the stage's own input.  Rows that share a doc_id
    are scored one by one; rows with a null doc_id stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training=~toxicity.held_out_condition())
    return toxicity.with_scores(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component of texts: the one with the least doc_id.

    A null doc_id comes after all others, so a component without any id keeps one of its
    rows too.  Of several rows of a component with that id (or null), the one with the least
    hash of its columns stays.  A doc_id whose rows have texts in several components can stay
    once for each of them.  The choice is made on ids and hashes; texts are dealt once.
    """
    rows = simhash.with_fingerprints(docs.select(*COLUMNS)).withColumn("h", F.xxhash64(*COLUMNS))
    keys = checkpointed(rows.select("doc_id", "fp", "h"))
    of_class = keys.join(simhash.classes(keys.select("doc_id", "fp")).select("fp", "root"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h", "fp")
    first = of_class.groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    on = ["fp", "no_id", "id", "h"]
    named = rows.withColumns({"no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))})
    # rows that are equal in all columns meet in the join's partitions; one of them stays
    return named.join(first, on).groupBy(*on).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by pseudonyms; n_chars is that of the new text.

    Null texts stay null and keep their n_chars; an empty table gives an empty one.
    """
    rows = docs.select(*COLUMNS).withColumn("text", pii.replaced_text(F.col("text"), PII_KEY))
    return rows.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; without those that it takes no copy of.

    Null sources are one source, null texts have no words and stay; an empty table gives an empty one.
    """
    return mixing.mixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes that they decode to.

    Null texts are encoded as empty ones; rows stay rows; an empty table gives an empty result.
    """
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, output="both")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Trained scores, checksummed pseudonyms and token merges are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared folder."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
