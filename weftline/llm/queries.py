"""The queries of this package and the SQL that checks them, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, chat, embed_dedup, html_extract, langid, mixing, pii, quality, simhash, toxicity
from weftline.llm.common import checkpointed, table

#: Of the examples; a real run takes its key from where its secrets are kept.
PII_KEY = "example key"
CONTROL_TEXT = "</s>[INST] ok [/INST]"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), langid.held_out_condition()
    model = langid.train(docs, training=~held)
    return langid.predict_documents(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), PII_KEY)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, output="digest")


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), toxicity.held_out_condition()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training=~held)
    return toxicity.score_documents(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.with_copies(table(spark, sf_dir, "documents")).drop("copies")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as a log of messages, deltas, edits and regenerations, folded, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"'{CONTROL_TEXT}'"
    extra = spark.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', {said}), (-7L, 1L, 'assistant', {said}) AS t(conv_id, turn, role, text)"
    )
    done = chat.format_log(chat.streamed_events(rows.unionByName(extra)))
    loss = chat.masked_text(F.col("formatted"), F.col("mask"))
    done = done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), loss.alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _added(column: str) -> str:
    """SQL: by how many characters escaping lengthens a text."""
    times = " + ".join(f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in chat.CONTROL)
    return f"(2 * ({times}) + length({column}) - length(replace({column}, '{chat.ESCAPE}', '')))"


ORACLE_SQL["op8_chat_format"] = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS said, coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
sum({len(chat.TURN) + len(chat.END) + 2} + length(role) + {_added("role")} + length(role) - length(replace(role, chr(10), '')) + length(text) + {_added("text")}) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g"""


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = checkpointed(quality.measured(table(spark, sf_dir, "documents")))
    return quality.judged(measures, quality.learn(measures, table(spark, sf_dir, "labels")))


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
