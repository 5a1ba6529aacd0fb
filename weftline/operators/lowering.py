"""Lowering: trajectories to the row formats of training and evaluation, with a loss report.

One plan for all targets.  Every event gives an array of messages and an array of losses;
both come from one exchange on the record.  What a call was answered is looked up by a
window over (record, call id): the last result of an id answers all calls of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import IR_VERSION, Trajectories, null_of

CALLS = ("tool_call", "terminal_command", "file_write", "file_patch", "browser_action")
#: Events without a place in any target (fixed values); ``tool_message`` is left out without a word.
UNPLACED = (
    "todo_update", "state_snapshot", "verification", "reward", "error", "unparsed_fragment", "memory_read",
    "memory_write", "agent_handoff", "subtask_spawn", "subtask_result", "file_read", "terminal_output",
    "browser_observation"
)
OBSERVED = ("tool_result", "terminal_output", "browser_observation")
DEFAULT_NAMES = {
    "terminal_command": "terminal", "file_write": "file_write", "file_patch": "file_patch",
    "browser_action": "browser_action"
}

MESSAGE = "struct<role:string,content:string,call_id:string,call_name:string,call_arguments:string,answers:string>"
LOSS = "struct<severity:string,code:string,field:string,event_id:string>"


@dataclass(frozen=True)
class Context:
    """Options; they are constants of the plan."""

    include_reasoning: bool = False
    reasoning_policy: str | None = None
    tool_policy: str = "structured"
    content_fallback: bool = False


@dataclass(frozen=True)
class Lowered:
    """``rows``: one for each record, with ``status``, ``n_losses`` and ``n_messages``; ``messages``: one row each; ``losses``: one row each."""

    rows: DataFrame
    messages: DataFrame
    losses: DataFrame


@dataclass(frozen=True)
class _Target:
    id_prefix: str = "call_"
    system: str = "system"
    user: str = "user"
    assistant: str = "assistant"
    tool: str = "tool"
    empty_id_is_none: bool = True  # an empty call id counts as missing
    reasoning: str = "option"  # option, never, policy
    reasoning_severity: str = "info"
    plan_loss: bool = True
    missing_id_loss: tuple[str, ...] = CALLS
    looked_up: tuple[str, ...] = CALLS
    results: str = "once"  # once, never, always
    name_fallback: str = "default"  # default, event, unknown
    escape: bool = False


def _message(
    role: str | Column, content: Column, call_id: Column | None = None, name: Column | None = None,
    arguments: Column | None = None, answers: Column | None = None
) -> Column:
    none = null_of("string")
    values = (
        role if isinstance(role, Column) else F.lit(role), content, call_id if call_id is not None else none,
        name if name is not None else none, arguments if arguments is not None else none,
        answers if answers is not None else none
    )
    return F.struct(
        *[
            x.cast("string").alias(n) for x,
            n in zip(values, ("role", "content", "call_id", "call_name", "call_arguments", "answers"))
        ]
    )


def _loss(severity: str, code: str, field: str | Column) -> Column:
    return F.struct(
        F.lit(severity).alias("severity"), F.lit(code).alias("code"),
        (field if isinstance(field, Column) else F.lit(field)).alias("field"), F.col("event_id").alias("event_id")
    )


def _list(kind: str, *items: Column) -> Column:
    """The items that are not null."""
    return F.filter(F.array(*items), lambda x: x.isNotNull()) if items else F.array().cast(f"array<{kind}>")


def _given(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def _is(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def _prepared(events: DataFrame, target: _Target, ctx: Context) -> DataFrame:
    """Events with text, call id in use, looked-up answer and whether a result comes out by itself."""
    own = F.col("action.tool_call_id")
    usable = _given(own) if target.empty_id_is_none else own
    fallback = F.concat(F.lit(target.id_prefix), F.col("event_id"))
    call_id = F.when(_is(*CALLS) & F.col("action").isNotNull(), F.coalesce(_given(own), fallback))
    result_id = F.when(_is("tool_result"), _given(own))
    observed = X.observation_text(F.col("observation"))
    if ctx.content_fallback:
        observed = F.coalesce(observed, _given(X.content_text(F.col("content"))))
    df = events.select(
        "rid", "record_id", "ep_pos", "pos", "event_id", "event_type", "action", "observation",
        X.content_text(F.col("content")).alias("text"), observed.alias("observed"), usable.isNull().alias("id_missing"),
        F.coalesce(call_id, result_id).alias("key"), F.struct("ep_pos", "pos").alias("at")
    )
    df = df.repartition("rid")  # serves the windows here and the grouping by record after them
    same = Window.partitionBy("rid", "key")
    before = same.orderBy("ep_pos", "pos").rowsBetween(Window.unboundedPreceding, -1)
    answer = F.max_by(
        F.struct(F.coalesce("observed", F.lit("")).alias("text"), "observation"),
        F.when(_is("tool_result"), F.col("at"))
    ).over(same)
    df = df.withColumn("answer", F.when(F.col("key").isNotNull(), answer)).withColumn(
        "earlier", F.coalesce(F.count("*").over(before), F.lit(0))
    )
    return df


def _pieces(target: _Target, ctx: Context, name: str) -> tuple[Column, Column]:
    """(messages, losses) of an event."""
    shown = (lambda x: X.xml_escaped(x)) if target.escape else (lambda x: x)
    text, action = F.col("text"), F.col("action")
    says = lambda role, t=text: F.when(t != "", _message(role, shown(t)))
    include = ctx.include_reasoning and target.reasoning != "never" or (
        target.reasoning == "policy" and ctx.reasoning_policy in ("preserve", "summarize", "metadata_only")
    )
    arguments = F.coalesce(action["arguments"], F.lit("{}"))
    named = action["tool_name"]
    fallback = F.col("event_type")
    if target.name_fallback == "default":
        fallback = F.create_map(*[F.lit(x) for kv in DEFAULT_NAMES.items() for x in kv])[F.col("event_type")]
        fallback = F.coalesce(fallback, F.lit("unknown"))
    elif target.name_fallback == "unknown":
        fallback = F.when(_is("tool_call"), "unknown").otherwise(F.col("event_type"))
    tool = F.coalesce(named if target.name_fallback == "default" else _given(named), fallback)
    key = F.col("key")
    has_action = action.isNotNull()
    looked = F.when(_is(*target.looked_up), F.col("answer.text"))
    observed = _given(F.col("observed"))
    reply = F.coalesce(looked, observed)
    if name == "sft":
        reply = F.when(_is("tool_call"), looked).otherwise(observed)
    call_text = _given(text) if name not in ("sft",) else F.when(_is("tool_call"), _given(text))
    if name == "sft":
        tool = F.when(_is("terminal_command"), "terminal").otherwise(tool)
        command = F.coalesce(F.get_json_object(arguments, "$.command"), F.lit(""))
        arguments = F.when(_is("terminal_command"), F.to_json(F.struct(command.alias("command")))).otherwise(arguments)
        has_action = has_action | _is("terminal_command")
        key = F.coalesce(key, F.concat(F.lit("call_"), F.col("event_id")))
    wrapped = None
    if name == "hermes-xml":
        wrapped = F.concat(F.lit("༄"), tool, F.lit("("), arguments, F.lit(")༄"))
    elif name == "sharegpt":
        wrapped = F.concat(F.lit("[Tool Call: "), tool, F.lit("("), arguments, F.lit(")]"))
    if name == "sharegpt":
        inline = ctx.tool_policy == "inline"
        calls = _list(
            MESSAGE, F.when(has_action, _message(target.assistant, F.concat_ws("\n", _given(text), wrapped))),
            F.when(
                has_action & observed.isNotNull(), _message(target.user, F.concat(F.lit("[Tool Result]: "), observed))
            )
        ) if inline else _list(MESSAGE)
    elif name == "hermes-xml":
        own_id = _given(action["tool_call_id"])
        back = F.coalesce(F.when(own_id.isNotNull(), F.col("answer.text")), observed)
        calls = _list(
            MESSAGE, F.when(has_action, _message(target.assistant, F.concat_ws("\n", _given(shown(text)), wrapped))),
            F.when(has_action & back.isNotNull(), _message(target.tool, shown(back)))
        )
    else:
        calls = _list(
            MESSAGE, F.when(has_action, _message(target.assistant, call_text, key, tool, arguments)),
            F.when(has_action & reply.isNotNull(), _message(target.tool, reply, answers=key))
        )
    result = _message(
        target.tool, shown(F.coalesce("observed", F.lit(""))), answers=None if name == "hermes-xml" else key
    )
    results = {
        "once": F.when(key.isNotNull() & (F.col("earlier") == 0), result), "always": result, "never": null_of(MESSAGE)
    }[target.results]
    thinking = {"hermes-xml": lambda t: F.concat(F.lit("\n"), shown(t), F.lit("\n</think>"))}.get(name, shown)
    planning = {"hermes-xml": lambda t: F.concat(F.lit("<plan>\n"), shown(t), F.lit("\n</plan>"))}.get(name, shown)
    thought = F.when(text != "", _message(target.assistant, thinking(text))) if include else null_of(MESSAGE)
    plan = F.when(text != "", _message(target.assistant, planning(text))) if include else null_of(MESSAGE)
    messages = (
        F.when(_is("reasoning"), _list(MESSAGE, thought))
        .when(_is("plan"), _list(MESSAGE, plan))
        .when(_is("system_message"), _list(MESSAGE, says(target.system)))
        .when(_is("user_message"), _list(MESSAGE, says(target.user)))
        .when(_is("assistant_message", "finish"), _list(MESSAGE, says(target.assistant)))
        .when(_is(*CALLS), calls)
        .when(_is("tool_result"), _list(MESSAGE, results))
        .otherwise(F.array().cast(f"array<{MESSAGE}>"))
    )
    lost = F.lit(not include)
    several = F.size("observation.artifact_ids") > 1
    unplaced = tuple(k for k in UNPLACED if name != "hermes-xml" or k not in ("terminal_output", "browser_observation"))
    dropped = ctx.tool_policy != "inline" if name == "sharegpt" else False
    losses = _list(
        LOSS,
        F.when(_is("reasoning") & lost, _loss(target.reasoning_severity, "LOWER003", "reasoning")),
        F.when(_is("plan") & lost & F.lit(target.plan_loss), _loss("info", "LOWER004", "plan")),
        F.when(
            _is(*(target.missing_id_loss or ("-",))) & F.col("action").isNotNull() & F.col("id_missing"),
            _loss("warning", "LOWER001", "tool_call_id")
        ),
        F.when(_is(*CALLS) & F.col("action").isNotNull() & F.lit(dropped), _loss("warning", "LOWER007", "tool_calls")),
        F.when(
            _is("tool_result") & _given(action["tool_call_id"]).isNotNull() & F.lit(dropped),
            _loss("info", "LOWER007", "tool_result")
        ),
        F.when(
            _is("terminal_output", "browser_observation") & F.lit(name == "hermes-xml") & several,
            _loss("warning", "LOWER006", "observation")
        ),
        F.when(_is(*unplaced), _loss("info", "LOWER005", F.col("event_type"))),
    )
    return messages, losses


_TARGETS: dict[str, _Target] = {
    "sft": _Target(
        reasoning_severity="warning", empty_id_is_none=False, missing_id_loss=("tool_call",), looked_up=("tool_call",),
        results="never", name_fallback="unknown"
    ),
    "openai-tools": _Target(reasoning="never"),
    "anthropic-tools": _Target(id_prefix="toolu_", system="user"),
    "hermes-xml": _Target(
        system="system", user="human", assistant="gpt", reasoning="policy", reasoning_severity="warning",
        plan_loss=False, missing_id_loss=(), results="always", name_fallback="event", escape=True
    ),
    "openhands": _Target(system="user", reasoning="never"),
    "sharegpt": _Target(
        system="human", user="human", assistant="gpt", plan_loss=False, missing_id_loss=(), results="never",
        name_fallback="event"
    ),
}


def status_of(losses: Column) -> Column:
    """From an array of losses: unsupported, lossy, partial or exact."""
    any_ = lambda *s: F.exists(losses, lambda x: x["severity"].isin(*s))
    return F.when(any_("error", "fatal"), "unsupported").when(any_("warning"), "lossy").when(
        F.size(losses) > 0, "partial"
    ).otherwise("exact")


def _in_order(column: str) -> Column:
    return F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ep_pos", "pos", column))), lambda x: x[column]))


def _record_fields(t: Trajectories) -> DataFrame:
    return t.records.select(
        "rid", "record_id", "source", "outcome", "tools", "artifacts", F.col("metadata").alias("record_metadata")
    )


def lower(t: Trajectories, name: str, ctx: Context = Context()) -> Lowered:
    """Lower to a registered target; an unknown one is a KeyError before anything runs."""
    if name not in TARGETS:
        raise KeyError(f"unknown target: {name}; known: {', '.join(sorted(TARGETS))}")
    return TARGETS[name](t, name, ctx)


def _lower_messages(t: Trajectories, name: str, ctx: Context) -> Lowered:
    target = _TARGETS[name]
    messages, losses = _pieces(target, ctx, name)
    per_event = _prepared(t.events, target, ctx).withColumn("m", messages).withColumn("l", losses)
    spoke = _is("assistant_message") | (_is(*CALLS)) | (_is("finish") & (F.col("text") != ""))
    grouped = per_event.groupBy("rid").agg(
        _in_order("m").alias("messages"), _in_order("l").alias("losses"), F.bool_or(_is(*CALLS)).alias("has_calls"),
        F.bool_or(spoke).alias("spoke")
    )
    none = lambda kind: F.array().cast(f"array<{kind}>")
    rows = _record_fields(t).join(grouped, "rid", "left").withColumn(
        "messages", F.coalesce("messages", none(MESSAGE))
    ).withColumn("losses", F.coalesce("losses", none(LOSS)))
    whole = lambda severity, code, field, event=None: F.struct(
        F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(field).alias("field"),
        (event if event is not None else null_of("string")).alias("event_id")
    )
    if name == "sft":
        rows = rows.withColumn(
            "losses",
            F.when(F.coalesce("spoke", F.lit(False)), F.col("losses")).otherwise(
                F.concat("losses", F.array(whole("warning", "LOWER003", "messages")))
            )
        )
    if name == "openhands":
        foreign = F.filter("artifacts", lambda a: a["kind"].isin("screenshot", "webpage", "binary", "dataset_row"))
        rows = rows.withColumn(
            "losses",
            F.concat(
                F.transform(foreign, lambda a: whole("warning", "LOWER006", "artifact", a["created_by"])),
                F.col("losses")
            )
        )
    status = status_of(F.col("losses"))
    if name == "sharegpt":
        status = F.when(
            F.coalesce("has_calls", F.lit(False)), "partial" if ctx.tool_policy == "inline" else "lossy"
        ).otherwise(status)
    rows = rows.withColumn("status", status)
    metadata = F.struct(
        F.col("record_id").alias("trajectory_id"), _given(F.col("source.dataset")).alias("source_dataset"),
        _given(F.col("source.framework")).alias("source_framework"), F.col("outcome.reward").alias("reward"),
        F.col("outcome.passed").alias("passed")
    )
    function = lambda m: F.struct(m["call_name"].alias("name"), m["call_arguments"].alias("arguments"))
    chat = F.transform(
        "messages",
        lambda m: F.struct(
            m["role"].alias("role"), m["content"].alias("content"),
            F.when(
                m["call_id"].isNotNull(),
                F.array(
                    F.struct(m["call_id"].alias("id"), F.lit("function").alias("type"), function(m).alias("function"))
                )
            ).alias("tool_calls"),
            m["answers"].alias("tool_call_id")
        )
    )
    turns = F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value")))
    tools = lambda schema: F.to_json(
        F.transform(
            "tools",
            lambda x: F.struct(
                x["name"].alias("name"), _given(x["description"]).alias("description"),
                _given(x["input_schema"]).alias(schema)
            )
        )
    )
    patch = F.coalesce(
        F.get(F.filter("artifacts", lambda a: (a["kind"] == "patch") & (a["content"] != "")), F.lit(0))["content"],
        F.get(
            F.filter("artifacts", lambda a: a["artifact_id"] == F.col("outcome.final_patch_artifact_id")), F.lit(0)
        )["content"],
        F.lit("")
    )
    repo = F.coalesce(_given(F.col("record_metadata")["repo"]), F.col("source.dataset"), F.lit(""))
    block = lambda kind, **f: F.struct(
        F.lit(kind).alias("type"),
        *[f.get(k, null_of("string")).alias(k) for k in ("text", "id", "name", "input", "tool_use_id", "content")]
    )
    typed = F.transform(
        "messages",
        lambda m: F.struct(
            F.when(m["answers"].isNotNull(), "user").otherwise(m["role"]).alias("role"),
            F.when(
                m["answers"].isNotNull(), F.array(block("tool_result", tool_use_id=m["answers"], content=m["content"]))
            ).when(
                m["call_id"].isNotNull(),
                F.filter(
                    F.array(
                        F.when(m["content"].isNotNull(), block("text", text=m["content"])),
                        block("tool_use", id=m["call_id"], name=m["call_name"], input=m["call_arguments"])
                    ),
                    lambda b: b.isNotNull()
                )
            ).otherwise(F.array(block("text", text=m["content"]))).alias("content")
        )
    )
    output = {
        "sft": {"messages": chat, "metadata": metadata},
        "openai-tools": {"messages": chat},
        "anthropic-tools": {"messages": typed, "tools": F.when(F.size("tools") > 0, tools("input_schema"))},
        "hermes-xml": {"conversations": turns, "tools": tools("parameters")},
        "openhands": {"trajectory_id": F.col("record_id"), "repo": repo, "trajectory": chat, "model_patch": patch},
        "sharegpt": {"conversations": turns, "metadata": metadata},
    }[name]
    report = [F.size("losses").cast("bigint").alias("n_losses"), F.size("messages").cast("bigint").alias("n_messages")]
    flat = rows.select("rid", "record_id", F.posexplode("messages").alias("n", "m")).select(
        "rid", "record_id", F.col("n").cast("bigint").alias("n"), "m.*"
    )
    lost = rows.select("rid", "record_id", F.explode("losses").alias("l")).select("rid", "record_id", "l.*")
    return Lowered(
        rows.select(
            "rid", "record_id", "status", *report, F.struct(*[c.alias(k) for k, c in output.items()]).alias("output")
        ),
        flat, lost
    )


def anthropic_results(t: Trajectories) -> DataFrame:
    """``(rid, event_id, blocks)``: the text blocks of every observed result, its exit code as the last one."""
    o = F.col("observation")
    parts = F.concat(
        X.observation_parts(o),
        _list("string", F.when(o["exit_code"].isNotNull(), F.concat(F.lit("Exit code: "), o["exit_code"])))
    )
    return t.events.where(_is("tool_result") & o.isNotNull()).select(
        "rid", "event_id",
        F.transform(parts, lambda x: F.struct(F.lit("text").alias("type"), x.alias("text"))).alias("blocks")
    )


def steps(t: Trajectories) -> DataFrame:
    """One row for each step: an action event, what it says, and the next observation before the next action."""
    step = _is(*CALLS)
    seg = F.count_if(step).over(
        Window.partitionBy("rid", "ep_pos").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    df = t.events.withColumn("__seg", seg)
    following = F.min_by(
        "observation", F.when(_is(*OBSERVED), F.col("pos"))
    ).over(Window.partitionBy("rid", "ep_pos", "__seg"))
    df = df.withColumn("next", following).where(step)
    a = F.col("action")
    return df.select(
        "rid", "record_id", "ep_pos", "pos", F.col("event_id").alias("step_id"),
        F.col("event_type").alias("action_type"), a["tool_name"].alias("tool_name"),
        a["tool_call_id"].alias("tool_call_id"), a["arguments"].alias("arguments"),
        F.when(a.isNull(), X.content_text(F.col("content"))).alias("raw_content"),
        _given(X.content_text(F.col("content"))).alias("state_text"), F.col("observation").alias("state_observation"),
        F.col("next").alias("observation")
    )


def _lower_steps(t: Trajectories, name: str, ctx: Context) -> Lowered:
    found = steps(t)
    one = F.struct(
        "step_id",
        F.struct(F.col("state_text").alias("text"), F.col("state_observation").alias("observation")).alias("state"),
        F.struct(
            F.col("action_type").alias("event_type"), "tool_name", "tool_call_id", "arguments", "raw_content"
        ).alias("action"),
        "observation",
        F.struct(null_of("boolean").alias("is_progress"), null_of("string").alias("failure_type")).alias("label")
    )
    grouped = found.groupBy("rid").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("ep_pos", "pos", F.to_json(one).alias("step")))), lambda x: x["step"]
        ).alias("steps")
    )
    rows = _record_fields(t).join(grouped, "rid", "left").withColumn(
        "steps", F.coalesce("steps", F.array().cast("array<string>"))
    )
    o = F.col("outcome")
    outcome = F.when(
        o.isNotNull(),
        F.struct(
            o["status"].alias("status"), o["reward"].alias("reward"), o["passed"].alias("passed"),
            o["failure_reason"].alias("failure_reason")
        )
    )
    metadata = F.struct(
        F.lit(IR_VERSION).alias("ir_version"), F.size("steps").alias("step_count"),
        F.col("source.dataset").alias("source_dataset"), F.col("source.framework").alias("source_framework")
    )
    out = rows.select(
        "rid", "record_id", F.lit("exact").alias("status"), F.lit(0).cast("bigint").alias("n_losses"),
        F.size("steps").cast("bigint").alias("n_messages"),
        F.struct(
            F.col("record_id").alias("trajectory_id"), "steps", outcome.alias("outcome"), metadata.alias("metadata")
        ).alias("output")
    )
    nothing = rows.where(F.lit(False)).select(
        "rid", "record_id", *[null_of("string").alias(c) for c in ("severity", "code", "field", "event_id")]
    )
    return Lowered(out, found, nothing)


TARGETS: dict[str, Callable[[Trajectories, str, Context], Lowered]] = {
    **dict.fromkeys(_TARGETS, _lower_messages), "process-supervision": _lower_steps
}


def register_target(name: str, f: Callable[[Trajectories, str, Context], Lowered]) -> None:
    TARGETS[name] = f


def status_counts(lowered: Lowered) -> DataFrame:
    """``(status, n_records, n_losses)`` over a run."""
    return lowered.rows.groupBy("status").agg(F.count("*").alias("n_records"), F.sum("n_losses").alias("n_losses"))


def lower_all(t: Trajectories, names: list[str], ctx: Context = Context()) -> dict[str, Lowered]:
    """Several targets of one parse; persist the events first if they are costly."""
    return {
        n: lower(
            t, n,
            Context(True, ctx.reasoning_policy, ctx.tool_policy, ctx.content_fallback) if n == "hermes-xml" else ctx
        ) for n in names
    }
