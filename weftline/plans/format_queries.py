"""More of the catalogue: parsers of single formats, passes over their rows, declarative formats, files and streams.

Rows are made from the driver's tables in the shapes that each reader expects; the checking
SQL starts from the same tables and says in its own terms what must come out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import Trajectories, shared_folder
from weftline.operators import lowering, passes
from weftline.plans import pipeline
from weftline.plans.catalogue import TURNS, query, table
from weftline.plans.derived import D, conversation_rows, trajectories
from weftline.sources import files, frontends, spec
from weftline.sources.callbacks import process_rows
from weftline.streaming import convert as stream

#: Every conversation as a list m of (turn, role, text), for both engines' use below.
_TALK = """SELECT conv_id AS rid, transform(array_sort(collect_list(struct(turn, role, text))), x -> named_struct({turn})) AS m
FROM {{conversations}} GROUP BY conv_id"""


def _rows(spark: SparkSession, sf_dir: str, turn: str, fields: str) -> DataFrame:
    """``(rid, raw)``: a JSON object of the given SQL fields for each conversation, whose turns are m."""
    talk = _TALK.format(turn=turn)
    sql = f"SELECT rid, to_json(named_struct({fields})) AS raw FROM ({talk})"
    return spark.sql(sql, conversations=table(spark, sf_dir, "conversations"))


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", X.content_text(F.col("content")))


# -- benchmark conversations with verifiers ----------------------------------------------------


def _verified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every third record has "content" for "value" in its turns, so detection differs
    fields = """'conversations', from_json(to_json(transform(m, x -> CASE WHEN rid % 3 = 0 THEN map('from', x.f, 'content', x.v) ELSE map('from', x.f, 'value', x.v) END)), 'array<map<string,string>>'),
    'instance_id', CASE WHEN rid % 5 <> 0 THEN 'i' || rid END, 'repo', 'r' || rid % 7, 'base_commit', 'c', 'problem_statement', 'p' || rid,
    'pass', CASE WHEN rid % 4 < 2 THEN rid % 4 = 0 END, 'verifier', CASE WHEN rid % 2 = 0 THEN named_struct('passed', rid % 4 = 0, 'score', rid / 10.0D, 'command', 'run') END, 'extra', 'e' || rid"""
    return _rows(
        spark, sf_dir,
        "'f', CASE x.role WHEN 'assistant' THEN 'gpt' WHEN 'user' THEN 'human' ELSE x.role END, 'v', x.text", fields
    )


_VERIFIED_ID = "CASE WHEN rid % 5 <> 0 THEN 'i' || rid ELSE 'row-' || rid END"


@query(f"""WITH {TURNS} SELECT rid, CAST(pos AS BIGINT) AS pos, {_VERIFIED_ID} || '-evt-' || pos AS event_id, {_VERIFIED_ID} || '-ep-0' AS episode_id,
role || '_message' AS event_type, role, text, 'conversations[' || pos || ']' AS source_field FROM c""")
def q_verified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with from and value (or content) become message events."""
    events = frontends.convert(_verified_rows(spark, sf_dir), "codex-swebenchpro")[0].events
    return _text(events).select(
        "rid", "pos", "event_id", "episode_id", "event_type", "role", "text", "provenance.source_field"
    )


@query(f"""SELECT DISTINCT conv_id AS rid, {_VERIFIED_ID.replace('rid', 'conv_id')} AS record_id, {_VERIFIED_ID.replace('rid', 'conv_id')} AS task_id, 'p' || conv_id AS instruction, 'r' || (conv_id % 7) AS repo,
CASE conv_id % 4 WHEN 0 THEN true WHEN 1 THEN NULL END AS passed, CASE conv_id % 4 WHEN 0 THEN 'success' WHEN 3 THEN NULL ELSE 'unknown' END AS status,
CASE WHEN conv_id % 2 = 0 THEN conv_id % 4 = 0 END AS verified, CASE WHEN conv_id % 2 = 0 THEN conv_id / 10.0 END AS score, 'e' || conv_id AS extra FROM conversations""")
def q_verified_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task, outcome, verifier and the fields that no other place holds."""
    r = frontends.convert(_verified_rows(spark, sf_dir), "codex-swebenchpro")[0].records
    return r.select(
        "rid", "record_id", "task.task_id", "task.instruction", "task.repo", "outcome.passed", "outcome.status",
        F.col("outcome.verifier.passed").alias("verified"), "outcome.verifier.score", F.col("metadata")["extra"].alias("extra"),
    )


@query("""SELECT DISTINCT conv_id AS rid, round(least(1.0, CASE WHEN conv_id % 3 = 0 THEN 0.0 ELSE 1.0 END + 0.1 * (2 + CASE WHEN conv_id % 5 <> 0 THEN 1 ELSE 0 END
+ CASE WHEN conv_id % 4 < 2 THEN 1 ELSE 0 END + CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END) / 8), 6) AS score FROM conversations""")
def q_verified_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of turns in the format, and a tenth for the fields of a trial."""
    score = frontends.detect_verified(F.try_parse_json("raw"))
    return _verified_rows(spark, sf_dir).select("rid", F.bround(score, 6).alias("score"))


# -- reasoning conversations ---------------------------------------------------------------------


def _reasoning_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = """'from', CASE x.role WHEN 'assistant' THEN 'gpt' WHEN 'user' THEN 'human' ELSE x.role END, 'value', CASE WHEN x.role = 'assistant' AND x.turn % 2 = 1 THEN '༄' || x.text ELSE x.text END"""
    tools = """CASE WHEN rid % 2 = 0 THEN '[{{"name":"t' || rid || '","description":"d"}},{{"function":{{"name":"f","parameters":{{"a":1}}}}}}]' END"""
    fields = f"""'id', CASE WHEN rid % 4 <> 0 THEN 'h' || rid END, 'conversations', m, 'tools', {tools}, 'category', CASE WHEN rid % 3 = 0 THEN 'cat' END, 'subcategory', '', 'task', 'do ' || rid"""
    return _rows(spark, sf_dir, turn, fields)


@query(f"""WITH {TURNS}, t AS (SELECT conv_id AS rid, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations),
x AS (SELECT c.*, c.role = 'assistant' AND t.turn % 2 = 1 AS thinks FROM c JOIN t ON c.rid = t.rid AND c.pos = t.pos)
SELECT rid, CAST(pos AS BIGINT) AS pos, 'evt_' || pos AS event_id, CASE WHEN thinks THEN 'reasoning' ELSE role || '_message' END AS event_type,
CASE WHEN thinks THEN '༄' ELSE '' END || text AS text, thinks AS contains_reasoning, CASE WHEN thinks THEN 'metadata_only' END AS policy FROM x""")
def q_reasoning_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns that open with the reasoning mark become reasoning events under a policy."""
    events = frontends.convert(_reasoning_rows(spark, sf_dir), "hermes-agent")[0].events
    return _text(events).select(
        "rid", "pos", "event_id", "event_type", "text", "visibility.contains_reasoning", "visibility.policy"
    )


@query("""SELECT DISTINCT conv_id AS rid, CASE WHEN conv_id % 4 <> 0 THEN 'h' || conv_id ELSE 'hermes-row-' || conv_id END AS record_id, 'do ' || conv_id AS instruction,
CASE WHEN conv_id % 3 = 0 THEN 'cat' END AS category, CASE WHEN conv_id % 2 = 0 THEN 't' || conv_id || ':d:,f::{"a":1}' ELSE '' END AS tools FROM conversations""")
def q_reasoning_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks and the tool list, given as JSON text in two shapes."""
    r = frontends.convert(_reasoning_rows(spark, sf_dir), "hermes-agent")[0].records
    none = F.lit("")
    tool = lambda x: F.concat_ws(
        ":", x["name"], F.coalesce(x["description"], none), F.coalesce(x["input_schema"], none)
    )
    return r.select(
        "rid", "record_id", "task.instruction", "task.category",
        F.array_join(F.transform("tools", tool), ",").alias("tools")
    )


@query("""WITH n AS (SELECT conv_id AS rid, count(*) AS n FROM conversations GROUP BY conv_id) SELECT rid, least(1.0, 0.65 + CASE WHEN n >= 3 THEN 0.1 ELSE 0 END
+ CASE WHEN rid % 2 = 0 THEN 0.2 ELSE 0 END + CASE WHEN rid % 3 = 0 THEN 0.03 ELSE 0 END) AS score FROM n""")
def q_reasoning_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of turns, tools, category and task, at most 1."""
    score = frontends.detect_reasoning(F.try_parse_json("raw"))
    return _reasoning_rows(spark, sf_dir).select("rid", F.bround(score, 6).alias("score"))


# -- coding logs ---------------------------------------------------------------------------------


def _log_rows(spark: SparkSession, sf_dir: str, messages: bool = True) -> DataFrame:
    """Every assistant text with a tool use beside it; the messages as JSON text."""
    turn = """'role', x.role, 'content', CASE WHEN x.role = 'assistant' THEN array(named_struct('type', 'text', 'text', x.text, 'id', CAST(NULL AS STRING), 'name', CAST(NULL AS STRING), 'input', CAST(NULL AS STRUCT<k: INT>)),
    named_struct('type', 'tool_use', 'text', CAST(NULL AS STRING), 'id', 'u' || x.turn, 'name', 'bash', 'input', named_struct('k', 1))) ELSE array(named_struct('type', 'text', 'text', x.text, 'id', CAST(NULL AS STRING), 'name', CAST(NULL AS STRING), 'input', CAST(NULL AS STRUCT<k: INT>))) END"""
    tools = """'[{{"name":"bash","description":"first"}},{{"name":"bash","description":"second"}},{{"function":{{"name":"edit","parameters":{{"p":1}}}}}}]'"""
    said = "'messages_json', to_json(m)" if messages else "'messages_json', '[]', 'assistant_response', CASE WHEN rid % 3 <> 0 THEN 'reply ' || rid ELSE '  ' END"
    return _rows(
        spark, sf_dir, turn, f"{said}, 'tools_json', {tools}, 'gitdiff', CASE WHEN rid % 2 = 0 THEN 'diff ' || rid END"
    )


_LOG_EVENTS = """SELECT rid, CAST(pos AS BIGINT) AS pos, 'evt-' || rid || '-' || pos AS event_id, role || '_message' AS event_type, text,
CASE WHEN role = 'assistant' THEN 'bash' END AS tool_name, CASE WHEN role = 'assistant' THEN 'u' || turn END AS call_id, CASE WHEN role = 'assistant' THEN '{"k":1}' END AS arguments FROM x"""
_LOG_TURNS = "x AS (SELECT conv_id AS rid, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, text FROM conversations)"


def _log_columns(events: DataFrame) -> DataFrame:
    a = F.col("action")
    return events.select(
        "rid", "pos", "event_id", "event_type", F.get("content", F.lit(0))["text"].alias("text"),
        a["tool_name"].alias("tool_name"), a["tool_call_id"].alias("call_id"), a["arguments"].alias("arguments"),
    )


@query(
    f"WITH {_LOG_TURNS} {_LOG_EVENTS} UNION ALL SELECT rid, count(*), 'evt-' || rid || '-' || count(*), 'file_patch', NULL, NULL, NULL, '{{}}' FROM x WHERE rid % 2 = 0 GROUP BY rid"
)
def q_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a JSON text with embedded tool uses; the diff is a patch event after them."""
    events = frontends.convert(_log_rows(spark, sf_dir), "claude-code")[0].events
    return _log_columns(events)


@query("""SELECT DISTINCT conv_id AS rid, 'bash:first:,edit::{"p":1}' AS tools FROM conversations""")
def q_log_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tool of each name."""
    none = F.lit("")
    tool = lambda x: F.concat_ws(
        ":", x["name"], F.coalesce(x["description"], none), F.coalesce(x["input_schema"], none)
    )
    found = frontends.convert(_log_rows(spark, sf_dir), "claude-code")[0].records
    return found.select("rid", F.array_join(F.transform("tools", tool), ",").alias("tools"))


def _raw(rows: DataFrame) -> Trajectories:
    """Records that no frontend has parsed."""
    from weftline.model import events_of, no_diagnostics, records_of

    records = rows.select("rid", F.col("rid").cast("string").alias("record_id"), F.lit("raw").alias("level"), "raw")
    return Trajectories(
        records_of(records), events_of(records.where("false").select("rid", "record_id")), no_diagnostics(rows)
    )


@query(f"WITH {_LOG_TURNS} {_LOG_EVENTS}")
def q_log_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pass over raw records makes the same message events."""
    return _log_columns(passes.parse_coding_log(_raw(_log_rows(spark, sf_dir))).events)


@query(
    "SELECT DISTINCT conv_id AS rid, conv_id || '-response' AS event_id, 'reply ' || conv_id AS text FROM conversations WHERE conv_id % 3 <> 0"
)
def q_log_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without messages, the assistant's response is the one event."""
    t = passes.parse_coding_log(_raw(_log_rows(spark, sf_dir, messages=False)))
    return _text(t.events).select("rid", "event_id", "text")


@query(
    "SELECT DISTINCT conv_id AS rid, 'DATA001' AS code, 'assistant_response' AS field FROM conversations WHERE conv_id % 3 = 0"
)
def q_log_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.parse_coding_log(_raw(_log_rows(spark, sf_dir, messages=False)))
    return t.diagnostics.select("rid", "code", "field")


# -- native calls as a pass --------------------------------------------------------------------


@query("""WITH x AS (SELECT conv_id AS rid, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, role, text FROM conversations),
e AS (SELECT rid, i, 0 AS k, role || '_message' AS event_type, text, NULL AS call_id, NULL AS arguments FROM x
UNION ALL SELECT rid, i, 1, 'tool_call', '', 'k' || turn, '{"t":' || turn || '}' FROM x WHERE role = 'assistant')
SELECT rid, CAST(row_number() OVER (PARTITION BY rid ORDER BY i, k) - 1 AS BIGINT) AS pos, event_type, text, call_id, arguments FROM e""")
def q_native_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages with native calls become message and call events."""
    call = """CASE WHEN x.role = 'assistant' THEN array(named_struct('id', 'k' || x.turn, 'function', named_struct('name', 'run', 'arguments', '{{"t":' || x.turn || '}}'))) END"""
    rows = _rows(spark, sf_dir, f"'role', x.role, 'content', x.text, 'tool_calls', {call}", "'messages', m")
    events = _text(passes.parse_native_calls(_raw(rows)).events)
    return events.select(
        "rid", "pos", "event_type", "text", F.col("action.tool_call_id").alias("call_id"),
        F.col("action.arguments").alias("arguments")
    )


# -- outcomes, checks, targets -------------------------------------------------------------------


def _trial_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trial = """CASE WHEN rid % 3 = 0 THEN named_struct('resolved', rid % 2 = 0, 'command', 'make', 'test_output', 'o' || rid) END"""
    return _rows(
        spark, sf_dir, "'role', x.role, 'content', x.text",
        f"'messages', m, 'trial', {trial}, 'has_empty_response', rid % 5 = 0, 'reward', rid % 4 - 1"
    )


@query("""SELECT DISTINCT conv_id AS rid, CAST(conv_id % 4 - 1 AS DOUBLE) AS reward, CASE WHEN conv_id % 3 = 0 THEN conv_id % 2 = 0 END AS verified, CASE WHEN conv_id % 3 = 0 THEN CASE WHEN conv_id % 2 = 0 THEN 1.0 ELSE 0.0 END END AS score,
CASE WHEN conv_id % 3 = 0 THEN 'make' END AS command, CASE WHEN conv_id % 3 = 0 THEN 'o' || conv_id END AS output, CASE WHEN conv_id % 5 = 0 THEN 'empty_response' END AS failure_reason FROM conversations""")
def q_verifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verifier and failure reason from the raw row."""
    t = passes.normalize_outcome(frontends.convert(_trial_rows(spark, sf_dir), "agenttrove")[0])
    v = F.col("outcome.verifier")
    return t.records.select(
        "rid", "outcome.reward", v["passed"].alias("verified"), v["score"].alias("score"),
        v["command"].alias("command"), v["output"].alias("output"), "outcome.failure_reason"
    )


@query(f"WITH {D} SELECT rid, id AS event_id, 'VERIFY004' AS code, 'warning' AS severity FROM d WHERE eid % 3 = 1")
def q_verify_unsourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict checks: events without provenance."""
    t = passes.verify(trajectories(spark, sf_dir), strict=True)
    return t.diagnostics.where("field = 'provenance'").select("rid", "event_id", "code", "severity")


@query(
    f"WITH {D} SELECT rid, id AS event_id, 'VERIFY004' AS code FROM d WHERE event_type = 'assistant_message' AND eid % 2 = 0"
)
def q_verify_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict checks: assistant messages that say nothing."""
    t = trajectories(spark, sf_dir)
    blank = F.transform(
        "content",
        lambda b: b.withField(
            "text", F.when(F.substring(b["text"], -1, 1).cast("int") % 2 == 0, F.lit("  \n")).otherwise(b["text"])
        )
    )
    t = t.with_(
        events=t.events.withColumn(
            "content", F.when(F.col("event_type") == "assistant_message", blank).otherwise(F.col("content"))
        )
    )
    return passes.verify(t, strict=True).diagnostics.where("field = 'content'").select("rid", "event_id", "code")


@query(
    f"WITH {D} SELECT rid, CAST(row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS BIGINT) AS n FROM d WHERE event_type IN ('user_message', 'assistant_message')"
)
def q_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages alone, numbered anew by a slice that keeps all."""
    t = trajectories(spark, sf_dir)
    t = t.with_(events=t.events.where("event_type in ('user_message', 'assistant_message')"))
    return passes.slice_training(t, keep_non_trainable=True).events.select("rid", F.col("idx").alias("n"))


@query(f"""WITH {D}, x AS (SELECT rid, 'info' AS severity FROM d WHERE event_type = 'reasoning' UNION ALL SELECT rid, 'warning' FROM d WHERE event_type = 'tool_call' AND cid IS NULL),
r AS (SELECT u.rid, CASE WHEN max(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) = 1 THEN 'lossy' WHEN count(severity) > 0 THEN 'partial' ELSE 'exact' END AS status FROM (SELECT DISTINCT rid FROM d) u LEFT JOIN x ON u.rid = x.rid GROUP BY u.rid)
SELECT 'openai-tools' AS target, status, count(*) AS n_records FROM r GROUP BY status UNION ALL SELECT 'openhands', status, count(*) FROM r GROUP BY status""")
def q_fan_out_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several targets of one set of records, with the statuses of each."""
    found = lowering.lower_all(trajectories(spark, sf_dir), ["openai-tools", "openhands"])
    counts = [
        lowering.status_counts(x).select(F.lit(n).alias("target"), "status", "n_records") for n, x in found.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    f"WITH {D} SELECT rid, 'warning[PAIR001]: a call without a result' || chr(10) || '  --> rec_' || rid || ':' || id AS line FROM d WHERE event_type = 'tool_call' AND rid % 2 = 0"
)
def q_diagnostic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostics as text: calls of records that have no results."""
    t = trajectories(spark, sf_dir)
    lonely = t.with_(events=t.events.where("rid % 2 = 0 and event_type <> 'tool_result'"))
    return pipeline.diagnostic_lines(passes.pair_tool_results(lonely))


# -- declarative formats ---------------------------------------------------------------------------

FORMAT = spec.load_spec("""
apiVersion: weftline/v0.1
kind: TrajectoryFormat
metadata: {name: trials, version: 0.1.0}
source: {kind: jsonl, framework: trials, default_dataset: talks}
detect:
  min_score: 0.5
  rules:
    - {field_exists: $.id, score: 0.1}
    - {field_missing: $.gone, score: 0.1}
    - {field_is_list: $.messages, score: 0.1}
    - {field_is_dict: $.meta, score: 0.1}
    - {field_is_string: $.note, score: 0.1}
    - {any_field_exists: [$.nothing, $.note], score: 0.1}
    - {all_fields_exist: [$.id, $.note], score: 0.1}
    - {text_contains: {field: $.note, values: [seven]}, score: 0.2}
vars:
  turns: $.messages
  options: {transform: parse_json, input: $.options, fallback: {level: none}}
  kind: {const: chat}
source_overrides: {row_id: $.id}
task:
  task_id: {template: "{kind}-task"}
  instruction: {transform: extract_text, input: $.parts}
  category: $.meta.category
  subcategory: {var: options.level}
outcome:
  status: {first_of: [$.meta.status, {const: unknown}]}
  passed: $.meta.passed
tool_registry:
  from: $.tools
  as: tool
  item: {name: tool.name, description: {transform: to_string, input: tool.n}}
episodes:
  - events:
      - foreach: {var: turns}
        as: turn
        index_as: i
        emit:
          event_id: {template: "e{i:03d}"}
          idx: {var: i}
          event_type: {transform: role_to_event_type, input: turn.role}
          role: {transform: role_to_message_role, input: turn.role}
          content: [turn.content, {type: thinking, thinking: turn.role}]
          action: {kind: {const: generic_tool}, tool_name: turn.role, tool_call_id: {template: "c{i}"}, call_style: {const: inferred}}
""")


def _format_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = """'id', 'x' || rid, 'messages', m, 'note', CASE WHEN rid % 7 = 0 THEN 'seven' || rid WHEN rid % 2 = 0 THEN 'no' END, 'parts', array(named_struct('text', 'a' || rid), named_struct('text', 'b')),
    'options', CASE WHEN rid % 3 = 0 THEN '{{"level":"l' || rid || '"}}' ELSE 'not json' END, 'meta', named_struct('category', 'c' || rid % 5, 'status', CASE WHEN rid % 2 = 0 THEN 'success' WHEN rid % 3 = 0 THEN 'odd' END, 'passed', CASE WHEN rid % 2 = 0 THEN 'yes' ELSE 'no' END),
    'tools', array(named_struct('name', 'n' || rid, 'n', rid), named_struct('name', CAST(NULL AS STRING), 'n', 2))"""
    return _rows(spark, sf_dir, "'role', x.role, 'content', x.text", fields)


@query("""SELECT DISTINCT conv_id AS rid, round(0.4 + CASE WHEN conv_id % 7 = 0 OR conv_id % 2 = 0 THEN 0.3 ELSE 0 END + CASE WHEN conv_id % 7 = 0 THEN 0.2 ELSE 0 END, 6) AS score,
CASE WHEN conv_id % 7 = 0 OR conv_id % 2 = 0 THEN 'MATCH' ELSE 'LOW' END AS verdict FROM conversations""")
def q_dsl_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight kinds of detection rules."""
    v = F.try_parse_json("raw")
    return _format_rows(spark, sf_dir).select(
        "rid", F.bround(spec.detection(FORMAT, v), 6).alias("score"), spec.verdict(FORMAT, v).alias("verdict")
    )


@query(
    """SELECT DISTINCT conv_id AS rid, 'x' || conv_id AS record_id, 'talks' AS dataset, 'chat-task' AS task_id, 'a' || conv_id || chr(10) || 'b' AS instruction, 'c' || (conv_id % 5) AS category FROM conversations"""
)
def q_dsl_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, constants, templates, texts of parts and paths in a task."""
    r = spec.compile_spec(FORMAT).parse(_format_rows(spark, sf_dir)).records
    return r.select("rid", "record_id", "source.dataset", "task.task_id", "task.instruction", "task.category")


@query(
    """SELECT DISTINCT conv_id AS rid, CASE WHEN conv_id % 2 = 0 THEN 'success' ELSE 'unknown' END AS status, conv_id % 2 = 0 AS passed FROM conversations"""
)
def q_dsl_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = spec.compile_spec(FORMAT).parse(_format_rows(spark, sf_dir)).records
    return r.select("rid", "outcome.status", "outcome.passed")


@query(
    """SELECT DISTINCT conv_id AS rid, 'n' || conv_id || ':' || conv_id || ',tool_1:2' AS tools FROM conversations"""
)
def q_dsl_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tools of a list; one without a name gets its number."""
    r = spec.compile_spec(FORMAT).parse(_format_rows(spark, sf_dir)).records
    return r.select(
        "rid",
        F.array_join(F.transform("tools", lambda x: F.concat_ws(":", x["name"], x["description"])), ",").alias("tools")
    )


@query(
    f"""WITH {TURNS} SELECT rid, CAST(pos AS BIGINT) AS idx, printf('e%03d', pos) AS event_id, 'generic_tool' AS kind, role AS tool_name, 'c' || pos AS call_id, 'inferred' AS call_style, text || chr(10) || role AS text FROM c"""
)
def q_dsl_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emitted actions, and content from a list of expressions."""
    e = _text(spec.compile_spec(FORMAT).parse(_format_rows(spark, sf_dir)).events)
    a = F.col("action")
    return e.select(
        "rid", "idx", "event_id", a["kind"].alias("kind"), a["tool_name"].alias("tool_name"),
        a["tool_call_id"].alias("call_id"), a["call_style"].alias("call_style"), "text"
    )


@query("""SELECT DISTINCT conv_id AS rid, CASE WHEN conv_id % 3 = 0 THEN 'l' || conv_id ELSE 'none' END AS level, 'a' || conv_id || chr(10) || 'b' AS parts, CAST(conv_id AS VARCHAR) AS said,
'["x' || conv_id || '",1]' AS listed, '{"k":"x' || conv_id || '"}' AS object FROM conversations""")
def q_dsl_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parse_json with a fallback, extract_text, to_string, lists and objects of expressions."""
    s = spec.Scope(F.col("v"))
    value = lambda e: F.try_variant_get(s.value(e), "$", "string")
    rows = _format_rows(spark, sf_dir).select("rid", F.try_parse_json("raw").alias("v"))
    options = s.value({"transform": "parse_json", "input": "$.options", "fallback": {"level": "none"}})
    return rows.select(
        "rid", F.try_variant_get(options, "$.level", "string").alias("level"), value(
            {"transform": "extract_text", "input": "$.parts"}
        ).alias("parts"),
        value(
            {"transform": "to_string", "input": "$.tools[0].n"}
        ).alias("said"), F.to_json(s.value(["$.id", 1])).alias("listed"), F.to_json(
            s.value({"k": "$.id"})
        ).alias("object"),
    )


CHECKED = spec.load_spec("""
apiVersion: weftline/v0.1
kind: TrajectoryFormat
metadata: {name: checked-actions}
source: {kind: jsonl}
episodes:
  - events:
      - foreach: $.messages
        as: turn
        emit: {action: {kind: {path: turn.kind}, call_style: {const: inferred}}}
""")


@query(
    """SELECT conv_id AS row_index, 'action.kind: user' AS error FROM conversations WHERE role = 'user' AND turn % 2 = 1 GROUP BY conv_id"""
)
def q_dsl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an action of an unknown kind go to quarantine."""
    rows = _rows(
        spark, sf_dir, "'kind', CASE WHEN x.role = 'user' AND x.turn % 2 = 1 THEN x.role ELSE 'terminal' END",
        "'messages', m"
    )
    frontends.register_frontend(spec.compile_spec(CHECKED))
    return frontends.convert(rows, "checked-actions")[1].select("row_index", "error")


@query("""WITH n AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id), t AS (SELECT count(*) AS turns FROM conversations)
SELECT '$' AS path, 'OBJECT' AS kinds, count(*) AS n, NULL AS most_items FROM n UNION ALL SELECT '$.messages', 'ARRAY', count(*), max(n) FROM n
UNION ALL SELECT '$.messages[]', 'OBJECT', turns, NULL FROM t UNION ALL SELECT '$.messages[].role', 'STRING', turns, NULL FROM t UNION ALL SELECT '$.messages[].content', 'STRING', turns, NULL FROM t""")
def q_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of paths of rows."""
    found = spec.probe_tree(conversation_rows(spark, sf_dir))
    return found.withColumn("most_items", F.col("most_items").cast("bigint"))


@query(
    """SELECT DISTINCT conv_id AS rid, f.name, conv_id % 2 = 0 AND f.name = 'chat_rewards' AS matches FROM conversations CROSS JOIN (SELECT unnest(['chat_rewards', 'verified_trials', 'coding_log', 'native_calls', 'reasoning_chat']) AS name) f"""
)
def q_shipped_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the shipped formats on conversations, every second with a reward."""
    rows = conversation_rows(spark, sf_dir, extra=", 'reward', CASE WHEN rid % 2 = 0 THEN 1.5D END")
    v = F.try_parse_json("raw")
    names = sorted(p.stem for p in spec.FORMATS.glob("*.yaml"))
    hits = F.array(
        *[F.struct(F.lit(n).alias("name"), (spec.detection(spec.shipped(n), v) >= 0.6).alias("matches")) for n in names]
    )
    return rows.select("rid", F.explode(hits).alias("h")).select("rid", "h.*")


# -- files ------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


_EVENT_ROWS = "SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS rid, event_id, event_type, CAST(CASE WHEN event_id % 3 <> 0 THEN user_id END AS BIGINT) AS user_id FROM events"


def _read_back(rows: DataFrame) -> DataFrame:
    v = F.try_parse_json("raw")
    return rows.select(
        "rid", X.get(v, "$.event_id", "bigint").alias("event_id"), X.string(v, "$.event_type").alias("event_type"),
        X.get(v, "$.user_id", "bigint").alias("user_id")
    )


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id")
    )
    return rows.coalesce(1).sortWithinPartitions("event_id")  # one file, whose lines are in order


@query(_EVENT_ROWS)
def q_read_write_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON lines, without keys of nulls, and read with their index."""
    path = _folder(spark, "lines") + ".jsonl"
    files.write_rows(_event_rows(spark, sf_dir), path)
    return _read_back(files.read_rows(spark, path))


@query(_EVENT_ROWS)
def q_read_write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "table") + ".parquet"
    files.write_rows(_event_rows(spark, sf_dir), path)
    return _read_back(files.read_rows(spark, path))


@query(_EVENT_ROWS)
def q_read_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A .json file that holds lines."""
    path = _folder(spark, "lines") + ".json"
    files.write_rows(_event_rows(spark, sf_dir), path, "jsonl", keep_nulls=True)
    return _read_back(files.read_rows(spark, path))


@query(
    "SELECT DISTINCT conv_id AS rid FROM conversations WHERE conv_id < (SELECT count(DISTINCT conv_id) FROM conversations)"
)
def q_read_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A .json file that is one array: its elements in order."""
    path = _folder(spark, "array") + ".json"
    ids = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    whole = ids.agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("conv_id").alias("id"))))).alias("value"))
    whole.write.text(path)
    rows = files.read_rows(spark, path)
    return rows.where(F.col("rid") == X.get(F.try_parse_json("raw"), "$.id", "bigint")).select("rid")


@query(
    """SELECT CAST(event_id AS BIGINT) AS row_index, 'malformed JSON' AS error, '{bad' AS raw_data FROM events WHERE event_id % 3 = 0"""
)
def q_quarantine_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output, written and read."""
    raw = F.when(F.col("event_id") % 3 == 0, "{bad").otherwise('{"messages":[{"role":"user","content":"x"}]}')
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), raw.alias("raw"))
    path = _folder(spark, "quarantine") + ".jsonl"
    files.write_rows(frontends.convert(rows, "agenttrove")[1], path)
    return spark.read.json(path).select("row_index", "error", "raw_data")


@query(
    """SELECT event_id AS rid, event_id % 2 = 0 AS ok, CASE WHEN event_id % 2 = 1 THEN 'odd number' END AS error FROM events"""
)
def q_checked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own check: rows that fail it go to the side output."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), F.col("props").alias("raw"))
    good, bad = frontends.quarantined(rows, F.col("rid") % 2 == 1, F.lit("odd number"), "check")
    return good.select(
        "rid", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")
    ).union(bad.select("row_index", F.lit(False), "error"))


def _halved(row: dict) -> dict | None:
    if row["k"] % 5 == 0:
        return None
    if row["k"] % 2:
        raise ValueError("odd")
    return {"half": row["k"] // 2}


_K = "SELECT event_id AS rid, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"


@query(
    f"WITH x AS ({_K}) SELECT rid, k // 2 AS half, NULL AS error FROM x WHERE k % 5 <> 0 AND k % 2 = 0 UNION ALL SELECT rid, NULL, 'ValueError: odd' FROM x WHERE k % 5 <> 0 AND k % 2 <> 0"
)
def q_process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python function over records: results, and what it raised."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), F.col("props").alias("raw"))
    good, bad = process_rows(rows, _halved)
    half = X.get(F.try_parse_json("raw"), "$.half", "bigint").alias("half")
    none = F.lit(None)
    return good.select("rid", half, none.cast("string").alias("error")).union(
        bad.select("row_index", none.cast("bigint"), "error")
    )


# -- streams ----------------------------------------------------------------------------------------


@query(f"""WITH {TURNS} SELECT conv, CAST(pos AS BIGINT) AS pos, event_id, event_type, role FROM (
SELECT rid AS conv, pos, printf('evt_%04d', pos) AS event_id, role || '_message' AS event_type, role FROM c CROSS JOIN (SELECT unnest([0, 1]) AS copy))""")
def q_stream_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as lines, each twice, read as a stream, parsed and passed in micro-batches: equal lines stay apart."""
    folder = _folder(spark, "stream")
    rows = conversation_rows(spark, sf_dir, extra=", 'original_source', CAST(rid AS STRING)").select("raw")
    rows.union(rows).write.text(f"{folder}/in")

    def sink(t: Trajectories, bad: DataFrame, n: int) -> None:
        events = t.events.join(
            t.records.select("rid", F.col("source.original_source").cast("bigint").alias("conv")), "rid"
        )
        events.select(
            "conv", "pos", "event_id", "event_type", "role"
        ).write.mode("overwrite").parquet(f"{folder}/out/batch={n}")

    stream.run(
        stream.read_lines(spark, f"{folder}/in"), "agenttrove", sink, "minimal", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("conv", "pos", "event_id", "event_type", "role")
