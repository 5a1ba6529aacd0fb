"""Trajectories for the query catalogue, made from the driver's tables.

``events`` has no tool use, so ``D`` reads each user's events as one episode with calls,
results, messages and reasoning, with missing, repeated and dangling ids among them.  Its
SQL is the same for Spark and for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.model import SCHEMAS, Trajectories, empty, events_of, no_diagnostics, null_of, records_of, struct_of, text_block, visible

_ID = "'c' || CAST(CAST(floor(p / 4) AS BIGINT) AS STRING)"
#: Common table expressions: one row for each event.
D = f"""b AS (SELECT user_id AS rid, event_id AS eid, event_type AS et, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS p FROM events),
d AS (SELECT rid, eid, CAST(p AS BIGINT) AS pos,
  CASE et WHEN 'view' THEN 'tool_call' WHEN 'click' THEN 'tool_result' WHEN 'purchase' THEN 'assistant_message' WHEN 'signup' THEN 'user_message' ELSE 'reasoning' END AS event_type,
  CASE eid % 8 WHEN 0 THEN 'bash' WHEN 1 THEN ' Read_File ' WHEN 2 THEN 'browser_open' WHEN 3 THEN 'str_replace' WHEN 4 THEN 'WRITE' WHEN 5 THEN 'mystery' WHEN 6 THEN '' ELSE 'web_search' END AS tool,
  CASE WHEN et = 'view' AND eid % 3 = 0 THEN {_ID} WHEN et = 'click' AND eid % 2 = 0 THEN {_ID} END AS cid,
  eid % 7 <> 0 AS trainable,
  'evt_' || CAST(CAST(CASE WHEN eid % 50 = 0 AND p > 0 THEN p - 1 ELSE p END AS BIGINT) AS STRING) AS id,
  CASE WHEN eid % 50 = 0 AND p > 0 THEN CAST(p AS BIGINT) - 1 ELSE CAST(p AS BIGINT) END AS idx,
  CASE WHEN eid % 40 = 0 THEN 'missing' WHEN p > 0 THEN 'evt_' || CAST(CAST(p AS BIGINT) - 1 AS STRING) END AS parent,
  CASE WHEN et = 'view' AND eid % 4 = 0 THEN 'evt_' || CAST(CAST(p AS BIGINT) + 1 AS STRING) END AS child,
  CASE WHEN eid % 60 = 0 THEN 'art_x' WHEN eid % 6 = 0 THEN 'art_0' END AS artifact,
  CASE WHEN eid % 5 <> 0 THEN 'preserve' END AS policy
  FROM b)"""


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        f"WITH {D.replace('FROM events', 'FROM {events}')} SELECT * FROM d",
        events=spark.read.parquet(f"{sf_dir}/events.parquet")
    )


def trajectories(spark: SparkSession, sf_dir: str, named_results: bool = False, links: bool = False) -> Trajectories:
    """``D`` as trajectories; results name their tool if ``named_results``, events have parents and children if ``links``."""
    d = rows_of(spark, sf_dir)
    call, result = F.col("event_type") == "tool_call", F.col("event_type") == "tool_result"
    none = empty("map<string,string>")
    action = F.when(
        call,
        struct_of(
            "action", kind=F.lit("generic_tool"), tool_name=F.col("tool"), tool_call_id=F.col("cid"),
            arguments=F.concat(F.lit('{"n":'), F.col("eid"), F.lit("}")), call_style=F.lit("native_tool_call"),
            side_effect_level=F.lit("unknown"), metadata=none
        )
    ).when(
        result & F.col("cid").isNotNull(),
        struct_of(
            "action", kind=F.lit("generic_tool"), tool_call_id=F.col("cid"), arguments=F.lit("{}"),
            call_style=F.lit("native_tool_call"), side_effect_level=F.lit("unknown"), metadata=none
        )
    )
    said = F.map_concat(
        F.when(F.col("cid").isNotNull(), F.create_map(F.lit("tool_call_id"), F.col("cid"))).otherwise(none),
        F.create_map(F.lit("tool_name"), F.col("tool")) if named_results else none
    )
    observation = F.when(
        result,
        struct_of(
            "observation", kind=F.lit("tool_json"), stdout=F.concat(F.lit("out"), F.col("eid")),
            content=empty(SCHEMAS["content"]), artifact_ids=empty("array<string>"), metadata=said
        )
    )
    content = F.when(call | result, empty(SCHEMAS["content"])).otherwise(
        F.array(text_block(F.concat(F.lit("t"), F.col("eid"))))
    )
    listed = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(empty("array<string>"))
    none_list = empty("array<string>")
    events = d.select(
        "rid", F.concat(F.lit("rec_"), "rid").alias("record_id"), "pos", F.col("id").alias("event_id"), "idx", "event_type",
        F.when(result, "tool").when(
            F.col("event_type") == "user_message", "user"
        ).otherwise("assistant").alias("role"), content.alias("content"), action.alias("action"), observation.alias("observation"),
        (listed("parent") if links else none_list).alias("parents"), (
            listed("child") if links else none_list
        ).alias("children"), (
            listed("artifact") if links else none_list
        ).alias("artifacts"),
        F.when(
            F.col("eid") % 3 != 1,
            struct_of("provenance", source_field=F.lit("events"), parser=F.lit("derived"), confidence=F.lit(0.9))
        ).alias("provenance"),
        visible(trainable=F.col("trainable"), policy=F.col("policy")).alias("visibility"),
    )
    reward = F.when(F.col("rid") % 3 == 0, "0.5").when(F.col("rid") % 3 == 1, "-1")
    success = F.when(F.col("rid") % 4 == 0, "true").when(F.col("rid") % 4 == 1, "false")
    meta = F.map_filter(F.create_map(F.lit("reward"), reward, F.lit("success"), success), lambda k, v: v.isNotNull())
    artifact = F.array(
        F.struct(
            F.lit("art_0").alias("artifact_id"), F.lit("terminal_log").alias("kind"), F.lit("x").alias("content"),
            null_of("string").alias("sha256"), null_of("bigint").alias("size_bytes"),
            null_of("string").alias("created_by")
        )
    )
    records = d.select("rid").distinct().select(
        "rid", F.concat(F.lit("rec_"), "rid").alias("record_id"), artifact.alias("artifacts"), meta.alias("metadata")
    )
    return Trajectories(records_of(records), events_of(events), no_diagnostics(d))


def conversation_rows(spark: SparkSession, sf_dir: str, suffix: str = "''", extra: str = "") -> DataFrame:
    """Conversations as raw rows ``(rid, raw)``; ``suffix`` is SQL appended to assistant texts, ``extra`` more fields of the row."""
    return spark.sql(
        f"""SELECT rid, to_json(named_struct('messages', m{extra})) AS raw FROM (
        SELECT conv_id AS rid, transform(array_sort(collect_list(struct(turn, role, text))), x -> named_struct('role', x.role, 'content', x.text)) AS m
        FROM (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN text || {suffix.replace('{', '{{').replace('}', '}}')} ELSE text END AS text FROM {{conversations}}) GROUP BY conv_id)""",
        conversations=spark.read.parquet(f"{sf_dir}/conversations.parquet"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as native-tool trajectories: a user message, then one assistant message with a call for each line, then the answers."""
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    return spark.sql(
        """SELECT o_orderkey AS rid, to_json(named_struct('trajectory_id', 'o' || o_orderkey, 'repo', o_orderpriority, 'trajectory', concat(
          array(named_struct('role', 'user', 'content', o_orderpriority, 'tool_calls', CAST(NULL AS ARRAY<STRUCT<id: STRING, function: STRUCT<name: STRING, arguments: STRING>>>), 'tool_call_id', CAST(NULL AS STRING))),
          array(named_struct('role', 'assistant', 'content', '', 'tool_calls', transform(lines, x -> named_struct('id', 'l' || x.n, 'function', named_struct('name', 'part', 'arguments', '{{"p":' || x.p || '}}'))), 'tool_call_id', CAST(NULL AS STRING))),
          transform(lines, x -> named_struct('role', 'tool', 'content', 'q' || x.q, 'tool_calls', CAST(NULL AS ARRAY<STRUCT<id: STRING, function: STRUCT<name: STRING, arguments: STRING>>>), 'tool_call_id', 'l' || x.n))))) AS raw
        FROM {orders} JOIN (SELECT l_orderkey, array_sort(collect_list(named_struct('n', l_linenumber, 'p', l_partkey, 'q', CAST(l_quantity AS INT)))) AS lines FROM {lineitem} GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
        orders=read("orders"), lineitem=read("lineitem"),
    )
