"""Frontends: rows of known trace formats to trajectories.

A frontend has a detection score (a Column over the row as a VARIANT) and a parser of
``(rid, raw)`` rows, raw being JSON text.  Nothing here throws on a malformed row: what can't
be parsed gives a diagnostic and no events, or ends in quarantine (see ``quarantined``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import SCHEMAS, Trajectories, diagnostics_of, empty, events_of, no_diagnostics, null_of, records_of, struct_of, text_block, visible

CONVERSATIONS = ("messages", "conversations", "conversation")
#: The glyph that opens reasoning in one format.
REASONING_MARK = "༄"
#: What embedded calls look like in the texts of coding logs (fixed values).
CALL_MARKS = ("<tool_call>", "<function", "<invoke", "<tool_use>", "```tool")


# -- turns ------------------------------------------------------------------------------


def normal_role(role: Column) -> Column:
    r = F.lower(X.strip(role))
    return F.when(r.isin("human", "user"), "user").when(r.isin("gpt", "assistant"), "assistant").when(
        r.isin("system", "tool", "developer"), r
    ).otherwise("unknown")


def turn_role(turn: Column) -> Column:
    """The first of from, role, speaker that is a string."""
    return F.coalesce(*[X.string(turn, f"$.{k}") for k in ("from", "role", "speaker")])


def _list_text(parts: Column) -> Column:
    return F.array_join(
        F.filter(F.transform(parts, lambda p: F.coalesce(X.string(p), X.string(p, "$.text"))), lambda x: x.isNotNull()),
        "\n"
    )


def turn_text(turn: Column) -> Column:
    """The first of value, content, text that is a string, else the texts of a list ``content``; empty if there is none."""
    return F.coalesce(
        *[X.string(turn, f"$.{k}") for k in ("value", "content", "text")], _list_text(X.items(turn, "$.content")),
        F.lit("")
    )


def message_types(role: Column) -> tuple[Column, Column]:
    """(event type, message role) of a normalized role."""
    known = role.isin("user", "assistant", "tool", "system", "developer")
    kind = F.when(role == "developer", "system_message").when(
        known, F.concat(role, F.lit("_message"))
    ).otherwise("unparsed_fragment")
    return kind, F.when(known, role).otherwise("unknown")


def texts(text: Column) -> Column:
    return F.when(text != "", F.array(text_block(text))).otherwise(empty(SCHEMAS["content"]))


def _other_blocks(turn: Column, doubled: bool) -> Column:
    """Blocks of a list ``content`` beside its text: images, typed texts and, if ``doubled``, every text again."""
    parts = F.coalesce(X.items(turn, "$.content"), F.array().cast("array<variant>"))
    kind = lambda p: F.coalesce(X.string(p, "$.type"), F.lit("text"))
    if doubled:
        wanted = F.filter(parts, lambda p: F.coalesce(X.string(p), X.string(p, "$.text")).isNotNull())
        return F.transform(wanted, lambda p: text_block(F.coalesce(X.string(p), X.string(p, "$.text"))))
    wanted = F.filter(
        parts, lambda p: (kind(p) == "image_url") | ((kind(p) != "text") & X.string(p, "$.text").isNotNull())
    )
    block = lambda p: F.when(
        kind(p) == "image_url",
        F.struct(
            F.lit("image").alias("type"), null_of("string").alias("text"),
            F.to_json(X.get(p, "$.image_url")).alias("json")
        )
    ).otherwise(text_block(X.string(p, "$.text")))
    return F.transform(wanted, block)


# -- the contract -----------------------------------------------------------------------


@dataclass(frozen=True)
class Frontend:
    name: str
    detect: Callable[[Column], Column]
    parse: Callable[[DataFrame, str | None], Trajectories]
    #: Why a row can't become a record, null if it can; such rows go to quarantine.
    rejects: Callable[[Column], Column] | None = None


def _score(*hits: tuple[Column, float]) -> Column:
    return reduce(lambda a, x: a + F.when(x[0], float(x[1])).otherwise(0.0), hits, F.lit(0.0))


def _has(v: Column, *names: str) -> list[Column]:
    return [X.exists(X.get(v, f"$.{n}")) for n in names]


def _count(tests: list[Column]) -> Column:
    return reduce(lambda a, t: a + t.cast("int"), tests, F.lit(0)).cast("double")


def _filled(v: Column, name: str) -> Column:
    """There is a value that is not empty or false."""
    said = X.said(v, f"$.{name}")
    return X.exists(X.get(v, f"$.{name}")) & ~said.isin("", "[]", "{}", "false", "0")


def _rows(df: DataFrame) -> DataFrame:
    """``(rid, raw, v)``; v, the row as a VARIANT, is parsed here unless the caller has it."""
    v = F.col("v") if "v" in df.columns else F.try_parse_json("raw")
    return df.select(F.col("rid").cast("bigint").alias("rid"), F.col("raw").cast("string").alias("raw"), v.alias("v"))


def _source(framework: str, dataset: str | None, default: str | None = None, **more: Column) -> Column:
    return struct_of(
        "source", dataset=F.lit(dataset or default), framework=F.lit(framework), row_index=F.col("rid"), **more
    )


def _assembled(rows: DataFrame, events: DataFrame, diagnostics: list[DataFrame]) -> Trajectories:
    t = Trajectories(records_of(rows), events_of(events), no_diagnostics(rows))
    return t.with_(diagnostics=diagnostics)


# -- F2, F3: conversations with rewards ---------------------------------------------------


def detect_rewarded(v: Column) -> Column:
    talk, marks = _has(v, *CONVERSATIONS), _has(v, "original_source", "original_teacher", "reward")
    base = _count(talk + marks) / 6
    any_of = lambda tests: reduce(lambda a, b: a | b, tests)
    return F.when(~any_of(talk), 0.0).otherwise(
        F.bround(F.when(any_of(marks), F.least(F.lit(1.0), base + 0.4)).otherwise(base * 0.6), 3)
    )


def parse_rewarded(df: DataFrame, dataset: str | None = None) -> Trajectories:
    rows = _rows(df).withColumn("turns", F.coalesce(*[X.filled_items(F.col("v"), f"$.{n}") for n in CONVERSATIONS]))
    v = F.col("v")
    rows = rows.withColumn("record_id", X.number("rec_%06d", F.col("rid")))
    good = rows.where("turns is not null")
    turn = F.col("turn")
    kind, role = message_types(normal_role(turn_role(turn)))
    events = good.select("rid", "record_id", F.posexplode("turns").alias("pos", "turn")).select(
        "rid", "record_id", F.col("pos").cast("bigint").alias("pos"),
        X.number("evt_%04d", F.col("pos")).alias("event_id"), F.col("pos").alias("idx"), kind.alias("event_type"),
        role.alias("role"), F.concat(texts(turn_text(turn)), _other_blocks(turn, False)).alias("content"),
        struct_of(
            "provenance", parser=F.lit("agenttrove"), source_field=F.concat(F.lit("turns["), F.col("pos"), F.lit("]")),
            confidence=F.lit(1.0)
        ).alias("provenance"),
        F.to_json("turn").alias("raw")
    )
    reward = X.said(v, "$.reward").try_cast("double")
    records = good.select(
        "rid", "record_id", F.lit("parsed").alias("level"),
        _source(
            "agenttrove", dataset, original_source=X.said(v, "$.original_source"),
            original_teacher=X.said(v, "$.original_teacher")
        ).alias("source"),
        F.when(X.exists(X.get(v, "$.task_id")), struct_of("task", task_id=X.said(v, "$.task_id"))).alias("task"),
        X.said(v, "$.model").alias("model"),
        F.when(reward.isNotNull(), struct_of("outcome", status=F.lit("unknown"), reward=reward)).alias("outcome"), "raw"
    )
    return _assembled(
        records, events, [diagnostics_of(rows.where("turns is null"), "agenttrove", "DATA002", "messages", "error")]
    )


# -- F4, F5: benchmark conversations with verifiers -----------------------------------------


_TRIAL_FIELDS = ("repo", "issue_id", "base_commit", "instance_id", "pass", "fail", "verifier", "model_name_or_path")


def _present(v: Column, name: str) -> Column:
    """The key is there, even with null."""
    return X.get(v, f"$.{name}").isNotNull()


def _from_value(turn: Column) -> Column:
    return _present(turn, "from") & _present(turn, "value")


def detect_verified(v: Column) -> Column:
    first = F.slice(X.items(v, "$.conversations"), 1, 10)
    dicts = F.filter(first, X.is_object)
    n = F.size(dicts)
    share = F.size(F.filter(dicts, _from_value)) / n
    present = _count([_present(v, f) for f in _TRIAL_FIELDS])
    return F.coalesce(
        F.when(n > 0, F.when(present > 0, F.least(F.lit(1.0), share + 0.1 * present / 8)).otherwise(share)), F.lit(0.0)
    )


def _truth(x: Column, v: Column) -> Column:
    """Python's truth of a value that exists."""
    return F.when(X.exists(v), ~x.isin("", "false", "0", "0.0", "[]", "{}"))


def parse_verified(df: DataFrame, dataset: str | None = None) -> Trajectories:
    rows, v = _rows(df), F.col("v")
    given = lambda n: F.when(_filled(v, n), X.said(v, f"$.{n}"))
    rows = rows.withColumn(
        "record_id",
        F.coalesce(given("instance_id"), given("id"), F.concat(F.lit("row-"), F.col("rid")), F.lit("unknown"))
    )
    turns = rows.select("rid", "record_id", F.posexplode(X.items(v, "$.conversations")).alias("pos", "turn"))
    good, turn = turns.where(X.is_object(F.col("turn"))), F.col("turn")
    kind, role = message_types(normal_role(turn_role(turn)))
    events = good.select(
        "rid", "record_id", F.concat("record_id", F.lit("-ep-0")).alias("episode_id"),
        F.col("pos").cast("bigint").alias("idx"), F.concat("record_id", F.lit("-evt-"), F.col("pos")).alias("event_id"),
        kind.alias("event_type"), role.alias("role"),
        F.concat(texts(turn_text(turn)), _other_blocks(turn, True)).alias("content"),
        struct_of(
            "provenance", parser=F.lit("codex-swebenchpro"),
            source_field=F.concat(F.lit("conversations["), F.col("pos"), F.lit("]")), confidence=F.lit(1.0)
        ).alias("provenance"),
        F.to_json("turn").alias("raw")
    )
    events = events.withColumn("pos", F.row_number().over(Window.partitionBy("rid").orderBy("idx")).cast("bigint") - 1)
    said = lambda n: X.said(v, f"$.{n}")
    truth = lambda n: _truth(said(n), X.get(v, f"$.{n}"))
    # "pass or resolved": the second where the first is false
    passed = F.coalesce(
        F.when(truth("pass"), F.lit(True)), truth("resolved"),
        F.when(~X.exists(X.get(v, "$.resolved")) & ~X.exists(X.get(v, "$.pass")), ~truth("fail"))
    )
    judge = X.get(v, "$.verifier")
    verifier = F.when(
        X.is_object(judge),
        struct_of(
            "verifier", passed=X.get(judge, "$.passed", "boolean"), score=X.said(judge, "$.score").try_cast("double"),
            command=X.said(judge, "$.command"), output=X.said(judge, "$.output")
        )
    ).when(X.exists(judge), struct_of("verifier", passed=passed, output=said("verifier")))
    outcome = F.when(
        reduce(lambda a, b: a | b, _has(v, "pass", "fail", "resolved", "verifier")),
        struct_of(
            "outcome", status=F.when(passed, "success").when(~passed, "failure").otherwise("unknown"), passed=passed,
            verifier=verifier
        )
    )
    task = F.when(
        reduce(lambda a, b: a | b, _has(v, "repo", "issue_id", "base_commit", "instance_id", "problem_statement")),
        struct_of(
            "task", task_id=F.coalesce(given("instance_id"), F.col("record_id")), instruction=said("problem_statement"),
            benchmark=F.lit("swebench-pro"), repo=said("repo"), base_commit=said("base_commit")
        )
    )
    known = (
        "conversations", "instance_id", "id", "repo", "issue_id", "base_commit", "problem_statement", "pass", "fail",
        "resolved", "verifier", "model_name_or_path"
    )
    rest = F.map_filter(F.from_json("raw", "map<string,string>"), lambda k, x: ~k.isin(*known) & x.isNotNull())
    records = rows.select(
        "rid", "record_id", F.lit("parsed").alias("level"), _source("codex", dataset).alias("source"),
        task.alias("task"), said("model_name_or_path").alias("model"), outcome.alias("outcome"), "raw",
        F.coalesce(rest, empty("map<string,string>")).alias("metadata")
    )
    return _assembled(
        records, events,
        [diagnostics_of(turns.where(~X.is_object(F.col("turn"))), "codex-swebenchpro", "DATA002", "conversations")]
    )


# -- F6, F7: coding logs --------------------------------------------------------------------


_LOG_FIELDS = ("messages_json", "tools_json", "gitdiff", "claude_log", "assistant_response")
LOG_ARTIFACT_CHARS = 64


def detect_coding_log(v: Column) -> Column:
    filled = [X.exists(X.get(v, f"$.{n}")) & ~X.said(v, f"$.{n}").isin("", "[]") for n in _LOG_FIELDS]
    return _count(filled) / len(_LOG_FIELDS)


def _json_field(v: Column, name: str) -> Column:
    """A field that is a value or the JSON text of one."""
    at = X.get(v, f"$.{name}")
    return F.when(X.is_string(at), F.try_parse_json(X.string(at))).otherwise(at)


def log_tools(v: Column) -> Column:
    """Tool specs of ``tools_json``, the first of each name."""
    named = F.filter(
        F.transform(
            X.items(_json_field(v, "tools_json")),
            lambda x: F.struct(
                F.coalesce(X.string(x, "$.name"), X.string(x, "$.function.name")).alias("name"),
                F.coalesce(X.string(x, "$.description"), X.string(x, "$.function.description")).alias("description"),
                F.coalesce(
                    *[
                        F.to_json(F.when(X.is_object(X.get(x, p)), X.get(x, p))) for p in (
                            "$.input_schema", "$.parameters", "$.function.parameters"
                        )
                    ]
                ).alias("input_schema")
            )
        ),
        lambda s: s["name"].isNotNull()
    )
    start = F.array().cast(SCHEMAS["tools"])
    return F.coalesce(
        F.aggregate(
            named, start,
            lambda a, s: F.when(F.exists(a, lambda x: x["name"] == s["name"]), a).otherwise(F.concat(a, F.array(s)))
        ),
        start
    )


def _log_blocks(content: Column) -> Column:
    """Content of a log message: a text, or typed blocks (uses and results stay JSON)."""
    parts = X.items(content)
    one = lambda p: F.when(X.is_string(p), text_block(X.string(p))).when(
        X.string(p, "$.type").isin("text", "thinking", "reasoning"),
        text_block(F.coalesce(X.string(p, "$.text"), X.string(p, "$.thinking"), F.lit("")), "text")
    ).otherwise(F.struct(F.lit("json").alias("type"), null_of("string").alias("text"), F.to_json(p).alias("json")))
    return F.when(
        X.is_string(content), texts(X.string(content))
    ).when(X.is_list(content), F.transform(parts, one)).otherwise(empty(SCHEMAS["content"]))


def coding_log_events(rows: DataFrame, parser: str) -> DataFrame:
    """Message events of ``(rid, record_id, v)``; an embedded call is an inferred action of its message."""
    listed = X.filled_items(_json_field(F.col("v"), "messages_json"), "$")
    turns = rows.select("rid", "record_id", F.posexplode(listed).alias("pos", "m"))
    m = F.col("m")
    content = X.get(m, "$.content")
    kind, role = message_types(normal_role(F.coalesce(X.string(m, "$.role"), F.lit("unknown"))))
    uses = F.filter(
        F.coalesce(X.items(content), F.array().cast("array<variant>")), lambda p: X.string(p, "$.type") == "tool_use"
    )
    last_use = F.try_element_at(uses, F.lit(-1))
    marked = reduce(
        lambda a, k: a | F.contains(F.coalesce(X.string(content), F.lit("")), F.lit(k)), CALL_MARKS, F.lit(False)
    )
    embedded = (role == "assistant") & (
        (F.size(uses) > 0) | F.exists(
            F.coalesce(X.items(content), F.array().cast("array<variant>")),
            lambda p: X.string(p, "$.type") == "tool_result"
        ) | marked
    )
    action = F.when(
        embedded,
        struct_of(
            "action", kind=F.lit("generic_tool"), tool_name=X.string(last_use, "$.name"),
            tool_call_id=X.string(last_use, "$.id"),
            arguments=F.coalesce(F.to_json(X.get(last_use, "$.input")), F.lit("{}")), call_style=F.lit("inferred"),
            side_effect_level=F.lit("unknown"), metadata=F.create_map(F.lit("confidence"), F.lit("0.7"))
        )
    )
    blocks = _log_blocks(content)
    return turns.select(
        "rid", "record_id", F.concat(F.lit("ep-"), F.col("record_id")).alias("episode_id"),
        F.col("pos").cast("bigint").alias("pos"),
        F.concat(F.lit("evt-"), F.col("record_id"), F.lit("-"), F.col("pos")).alias("event_id"),
        F.col("pos").cast("bigint").alias("idx"), kind.alias("event_type"), role.alias("role"), blocks.alias("content"),
        action.alias("action"),
        F.when(role == "tool", struct_of("observation", kind=F.lit("tool_json"), content=blocks)).alias("observation"),
        F.when(embedded, struct_of("provenance", parser=F.lit(parser), confidence=F.lit(0.7))).alias("provenance")
    )


def parse_coding_log(df: DataFrame, dataset: str | None = None) -> Trajectories:
    rows = _rows(df).withColumn("record_id", F.col("rid").cast("string"))
    v = F.col("v")
    listed = X.filled_items(_json_field(v, "messages_json"), "$")
    flat = F.filter(
        F.array(
            *[
                F.struct(F.lit(r).alias("role"), X.string(v, f"$.{f}").alias("content")) for f,
                r in (("system_prompt", "system"), ("user_prompt", "user"), ("assistant_response", "assistant"))
            ]
        ),
        lambda x: F.coalesce(x["content"], F.lit("")) != ""
    )
    # rows without messages get them from the flat fields
    rows = rows.withColumn(
        "v2", F.when(listed.isNull(), F.try_parse_json(F.to_json(F.struct(flat.alias("messages_json"))))).otherwise(v)
    )
    events = coding_log_events(rows.select("rid", "record_id", F.col("v2").alias("v")), "claude-code")
    n = F.size(F.coalesce(listed, F.array().cast("array<variant>")))
    n = F.when(n > 0, n).otherwise(F.size(flat))
    diff, log = X.said(v, "$.gitdiff"), X.said(v, "$.claude_log")
    patch_id, patch_event = F.concat(
        F.lit("art-"), F.col("record_id"), F.lit("-gitdiff")
    ), F.concat(F.lit("evt-"), F.col("record_id"), F.lit("-"), n)
    patches = rows.where(F.coalesce(diff, F.lit("")) != "").select(
        "rid", "record_id", F.concat(F.lit("ep-"), F.col("record_id")).alias("episode_id"),
        n.cast("bigint").alias("pos"), patch_event.alias("event_id"), n.cast("bigint").alias("idx"),
        F.lit("file_patch").alias("event_type"), F.array(patch_id).alias("artifacts"),
        patch_id.alias("patch_artifact_id"),
        struct_of(
            "action", kind=F.lit("file_patch"), arguments=F.lit("{}"), call_style=F.lit("none"),
            side_effect_level=F.lit("unknown"), metadata=empty("map<string,string>")
        ).alias("action")
    )
    made = lambda i, kind, x, by: F.struct(
        i.alias("artifact_id"), F.lit(kind).alias("kind"), x.alias("content"), F.sha2(x, 256).alias("sha256"),
        F.octet_length(x).cast("bigint").alias("size_bytes"), by.alias("created_by")
    )
    keep = F.filter(
        F.array(
            F.when(F.coalesce(diff, F.lit("")) != "", made(patch_id, "patch", diff, patch_event)),
            F.when(
                F.length(log) >= LOG_ARTIFACT_CHARS,
                made(
                    F.concat(F.lit("art-"), F.col("record_id"), F.lit("-claude-log")), "terminal_log", log,
                    null_of("string")
                )
            )
        ),
        lambda a: a.isNotNull()
    )
    short = F.when(
        (F.length(log) > 0) & (F.length(log) < LOG_ARTIFACT_CHARS), F.create_map(F.lit("claude_log"), log)
    ).otherwise(empty("map<string,string>"))
    records = rows.select(
        "rid", "record_id", F.lit("parsed").alias("level"), _source("claude-code", dataset).alias("source"),
        log_tools(v).alias("tools"), keep.alias("artifacts"), "raw", short.alias("metadata")
    )
    all_events = events_of(events).unionByName(events_of(patches))
    blank = events.where((F.col("role") == "assistant") & X.is_blank(X.content_text(F.col("content"))))
    return _assembled(
        records, all_events, [diagnostics_of(blank, "claude-code", "DATA001", event_id=null_of("string"))]
    )


# -- F8, F9: native tool calls ----------------------------------------------------------------


def detect_native(v: Column) -> Column:
    return _count([X.is_list(X.get(v, "$.trajectory")), *_has(v, "trajectory_id", "model_patch", "repo")]) / 4


def native_message_events(rows: DataFrame, parser: str) -> DataFrame:
    """Events of ``(rid, record_id, turns)``: a message, or a text and its calls, or a result; ids and idx are dense.

    A nested explode: every message becomes an array of event structs, one text and one for
    each call.
    """
    turns = rows.select("rid", "record_id", F.posexplode("turns").alias("m", "turn")).where(X.is_object(F.col("turn")))
    turn = F.col("turn")
    role = normal_role(F.coalesce(X.string(turn, "$.role"), F.lit("")))
    kind, ir_role = message_types(role)
    calls = F.filter(F.coalesce(X.items(turn, "$.tool_calls"), F.array().cast("array<variant>")), X.is_object)
    with_calls = (role == "assistant") & (
        F.size(F.coalesce(X.items(turn, "$.tool_calls"), F.array().cast("array<variant>"))) > 0
    )
    text = turn_text(turn)

    def part(kind: Column, content: Column, action: Column, raw: Column) -> Column:
        return F.struct(
            kind.alias("event_type"), content.alias("content"), action.cast(SCHEMAS["action"]).alias("action"),
            raw.alias("raw")
        )

    def call(c: Column) -> Column:
        arguments = X.get(c, "$.function.arguments")
        given = X.string(arguments)
        parsed = F.try_parse_json(given)
        # well-formed text stays as written
        said = F.when(X.is_object(arguments), F.to_json(arguments)).when(
            given.isNotNull(), F.when(parsed.isNotNull(), given).otherwise(F.to_json(F.struct(given.alias("_raw"))))
        ).otherwise("{}")
        action = struct_of(
            "action", kind=F.lit("generic_tool"), tool_name=X.string(c, "$.function.name"),
            tool_call_id=X.said(c, "$.id"), arguments=said, call_style=F.lit("native_tool_call"),
            side_effect_level=F.lit("unknown"), metadata=empty("map<string,string>")
        )
        return part(F.lit("tool_call"), empty(SCHEMAS["content"]), action, F.to_json(c))

    answer = X.said(turn, "$.tool_call_id")
    result = part(
        F.lit("tool_result"), texts(text),
        F.when(
            answer.isNotNull(),
            struct_of(
                "action", kind=F.lit("generic_tool"), tool_call_id=answer, arguments=F.lit("{}"),
                call_style=F.lit("native_tool_call"), side_effect_level=F.lit("unknown"),
                metadata=empty("map<string,string>")
            )
        ),
        F.to_json(turn)
    )
    message = part(kind, texts(text), null_of(SCHEMAS["action"]), F.to_json(turn))
    parts = F.when(role == "tool", F.array(result)).when(
        with_calls,
        F.concat(F.filter(F.array(F.when(text != "", message)), lambda x: x.isNotNull()), F.transform(calls, call))
    ).otherwise(F.array(message))
    flat = turns.select("rid", "record_id", "m", ir_role.alias("role"), F.posexplode(parts).alias("i", "e"))
    pos = F.row_number().over(Window.partitionBy("rid").orderBy("m", "i")).cast("bigint") - 1
    flat = flat.withColumn("pos", pos)
    return events_of(
        flat.select(
            "rid", "record_id", F.concat("record_id", F.lit("-ep-0")).alias("episode_id"), "pos",
            F.concat("record_id", F.lit("-evt-"), F.col("pos")).alias("event_id"), F.col("pos").alias("idx"),
            F.col("e.event_type").alias("event_type"), "role", F.col("e.content").alias("content"),
            F.col("e.action").alias("action"), F.col("e.raw").alias("raw"),
            struct_of(
                "provenance", parser=F.lit(parser),
                source_field=F.when(
                    F.col("e.event_type") == "tool_call", "trajectory.tool_calls"
                ).otherwise("trajectory"),
                confidence=F.lit(1.0)
            ).alias("provenance")
        )
    )


def parse_native(df: DataFrame, dataset: str | None = None) -> Trajectories:
    rows, v = _rows(df), F.col("v")
    own = X.said(v, "$.trajectory_id")
    rows = rows.withColumn(
        "record_id", F.coalesce(own, F.concat(F.lit("openhands-row-"), F.col("rid")), F.lit("unknown"))
    ).withColumn("turns", X.items(v, "$.trajectory"))
    patch = X.said(v, "$.model_patch")
    patch_id = F.when(patch.isNotNull(), F.concat("record_id", F.lit("-patch")))
    artifact = F.array(
        F.struct(
            patch_id.alias("artifact_id"), F.lit("patch").alias("kind"), patch.alias("content"),
            null_of("string").alias("sha256"), null_of("bigint").alias("size_bytes"),
            null_of("string").alias("created_by")
        )
    )
    records = rows.select(
        "rid", "record_id", F.lit("parsed").alias("level"), _source("openhands", dataset).alias("source"),
        struct_of("task", repo=X.said(v, "$.repo")).alias("task"),
        struct_of("outcome", status=F.lit("unknown"), final_patch_artifact_id=patch_id).alias("outcome"),
        F.when(patch.isNotNull(), artifact).otherwise(empty(SCHEMAS["artifact_list"])).alias("artifacts"), "raw"
    )
    bad = rows.where(X.get(v, "$.trajectory").isNotNull() & ~X.is_list(X.get(v, "$.trajectory")))
    return _assembled(
        records, native_message_events(rows.select("rid", "record_id", "turns"), "openhands"),
        [diagnostics_of(bad, "openhands", "DATA002", "trajectory")]
    )


# -- F10, F11: reasoning conversations ---------------------------------------------------------


def tool_list(v: Column) -> Column:
    """The ``tools`` field as a list: JSON text, a list, a wrapper of one, or a single object."""
    at = _json_field(v, "tools")
    return F.when(X.is_list(at), X.items(at)).when(
        X.is_object(at),
        F.coalesce(*[X.items(at, f"$.{k}") for k in ("tools", "functions", "definitions")], F.array(at))
    )


def detect_reasoning(v: Column) -> Column:
    turns = X.filled_items(v, "$.conversations")
    first = F.coalesce(_from_value(F.get(turns, F.lit(0))), F.lit(False))
    several = F.coalesce(F.size(F.filter(F.slice(turns, 1, 10), _from_value)) >= 3, F.lit(False))
    return F.least(
        F.lit(1.0),
        _score(
            (turns.isNotNull(), 0.3), (first, 0.3), (first & several, 0.1), (X.exists(X.get(v, "$.tools")), 0.15),
            (F.coalesce(F.size(tool_list(v)) > 0, F.lit(False)), 0.05), (_filled(v, "category"), 0.03),
            (_filled(v, "subcategory"), 0.02), (_filled(v, "task"), 0.05)
        )
    )


def parse_reasoning(df: DataFrame, dataset: str | None = None) -> Trajectories:
    rows, v = _rows(df), F.col("v")
    row_id = F.nullif(X.said(v, "$.id"), F.lit(""))
    rows = rows.withColumn("record_id", F.coalesce(row_id, F.concat(F.lit("hermes-row-"), F.col("rid"))))
    turns = rows.select("rid", "record_id", F.posexplode(X.items(v, "$.conversations")).alias("pos", "turn"))
    good, turn = turns.where(X.is_object(F.col("turn"))), F.col("turn")
    role_name = normal_role(turn_role(turn))
    kind, role = message_types(role_name)
    text = turn_text(turn)
    thinks = (role_name == "assistant") & text.startswith(REASONING_MARK)
    events = good.select(
        "rid", "record_id", F.col("pos").cast("bigint").alias("idx"),
        F.concat(F.lit("evt_"), F.col("pos")).alias("event_id"),
        F.when(thinks, "reasoning").otherwise(kind).alias("event_type"), role.alias("role"),
        texts(text).alias("content"),
        F.when(
            thinks,
            visible(
                contains_reasoning=F.lit(True), redaction_status=F.lit("metadata_only"), policy=F.lit("metadata_only")
            )
        ).otherwise(visible()).alias("visibility"),
        struct_of(
            "provenance", source_field=F.concat(F.lit("conversations["), F.col("pos"), F.lit("]")),
            confidence=F.lit(1.0)
        ).alias("provenance"),
        F.to_json("turn").alias("raw")
    )
    events = events.withColumn("pos", F.row_number().over(Window.partitionBy("rid").orderBy("idx")).cast("bigint") - 1)
    given = lambda n: F.when(_filled(v, n), X.said(v, f"$.{n}"))
    spec = lambda x, i: F.struct(
        F.coalesce(X.string(x, "$.name"), X.string(x, "$.function.name"), F.concat(F.lit("tool_"), i)).alias("name"),
        F.coalesce(X.string(x, "$.description"), X.string(x, "$.function.description")).alias("description"),
        F.coalesce(
            F.to_json(F.when(X.is_object(X.get(x, "$.parameters")), X.get(x, "$.parameters"))),
            F.to_json(F.when(X.is_object(X.get(x, "$.function.parameters")), X.get(x, "$.function.parameters")))
        ).alias("input_schema")
    )
    records = rows.select(
        "rid", "record_id", F.lit("parsed").alias("level"), _source("hermes-agent", dataset).alias("source"),
        struct_of(
            "task", task_id=row_id, instruction=given("task"), category=given("category"),
            subcategory=given("subcategory")
        ).alias("task"),
        F.coalesce(F.transform(tool_list(v), spec), empty(SCHEMAS["tools"])).alias("tools"),
        X.said(v, "$.model_name").alias("model"), "raw"
    )
    return _assembled(
        records, events,
        [diagnostics_of(turns.where(~X.is_object(F.col("turn"))), "hermes-agent", "DATA002", "conversations")]
    )


# -- registry ------------------------------------------------------------------------------------


FRONTENDS: dict[str, Frontend] = {
    f.name: f
    for f in (
        Frontend("agenttrove", detect_rewarded, parse_rewarded),
        Frontend("codex-swebenchpro", detect_verified, parse_verified),
        Frontend("claude-code", detect_coding_log, parse_coding_log),
        Frontend("openhands", detect_native, parse_native),
        Frontend("hermes-agent", detect_reasoning, parse_reasoning),
    )
}


def register_frontend(frontend: Frontend) -> None:
    FRONTENDS[frontend.name] = frontend


def frontend(name: str) -> Frontend:
    if name not in FRONTENDS:
        raise KeyError(f"unknown frontend: {name}; known: {', '.join(FRONTENDS)}")
    return FRONTENDS[name]


def detection_scores(df: DataFrame) -> DataFrame:
    """``(rid, frontend, score, rank)``: every frontend's score of every row, best first, ties in order of registration."""
    scores = F.array(
        *[
            F.struct(
                F.lit(i).alias("nth"), F.lit(f.name).alias("frontend"),
                F.coalesce(f.detect(F.col("v")), F.lit(0.0)).alias("score")
            ) for i,
            f in enumerate(FRONTENDS.values())
        ]
    )
    ranked = F.array_sort(
        F.transform(
            "s",
            lambda x: F.struct(
                (-x["score"]).alias("k"), x["nth"].alias("nth"), x["frontend"].alias("frontend"),
                x["score"].alias("score")
            )
        )
    )
    return _rows(df).select("rid", scores.alias("s")).select("rid", F.posexplode(ranked).alias("rank", "x")).select(
        "rid", "x.frontend", "x.score", (F.col("rank") + 1).alias("rank")
    )


def best_frontend(df: DataFrame) -> DataFrame:
    """``(rid, frontend, score)`` of the best match of every row."""
    return detection_scores(df).where("rank = 1").drop("rank")


def quarantined(df: DataFrame, bad: Column, error: Column, stage: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, side output ``(row_index, record_id, error, raw_data, stage)``)."""
    flagged = df.withColumn("__bad", F.coalesce(bad, F.lit(True)))
    record_id = F.col("record_id") if "record_id" in df.columns else null_of("string")
    side = flagged.where("__bad").select(
        F.col("rid").alias("row_index"), record_id.alias("record_id"), error.cast("string").alias("error"),
        F.col("raw").alias("raw_data"), F.lit(stage).alias("stage")
    )
    return flagged.where("not __bad").drop("__bad"), side


def convert(
    df: DataFrame, name: str, dataset: str | None = None, stage: str = "batch"
) -> tuple[Trajectories, DataFrame]:
    """Parse ``(rid, raw)`` rows; rows that are no JSON objects go to quarantine."""
    checked = df.select("rid", "raw", F.try_parse_json("raw").alias("v"))
    chosen, is_object = frontend(name), X.is_object(F.col("v"))
    error = F.when(F.col("v").isNull(), "malformed JSON").when(~is_object, "not an object")
    bad_row = ~is_object
    if chosen.rejects is not None:
        reason = chosen.rejects(F.col("v"))
        error, bad_row = F.coalesce(error, reason), bad_row | reason.isNotNull()
    good, bad = quarantined(checked, bad_row, error, stage)
    return chosen.parse(good, dataset), bad
