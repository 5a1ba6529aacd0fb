"""Passes over trajectories: each takes and returns ``Trajectories``, lazily.

All work is windows over one episode or joins on (rid, ep_pos, id), so a single exchange on
the record serves several of them; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import EVENT_FIELDS, SCHEMAS, Trajectories, diagnostics_of, empty, events_of, null_of, struct_of, text_block, visible

EPISODE = ("rid", "ep_pos")


def in_order() -> WindowSpec:
    return Window.partitionBy(*EPISODE).orderBy("pos")


def so_far() -> WindowSpec:
    return in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


#: What tools do, by lower-cased name (fixed values).
TOOLS = {
    ("terminal", "workspace_write"): (
        "execute_bash", "run_command", "bash", "shell", "terminal", "execute_command", "run_bash", "exec_bash",
        "execute_shell", "run_shell", "command", "cmd", "subprocess", "os_exec",
    ),
    ("file_write", "workspace_write"): (
        "write_file", "edit_file", "str_replace_editor", "create_file", "write", "save_file", "create_or_update_file",
        "apply_patch", "insert_content", "replace_in_file", "patch_file", "modify_file", "overwrite_file", "append_file",
    ),
    ("file_patch", "workspace_write"): (
        "apply_diff", "diff_edit", "str_replace", "insert", "replace", "patch", "edit_file_diff", "sed_edit",
    ),
    ("file_read", "read_only"): (
        "read_file", "cat", "view_file", "open_file", "get_file", "read", "head_file", "tail_file", "view", "show_file",
        "less", "more", "type",
    ),
    ("browser", "network"): (
        "browser_click", "browser_type", "browser_scroll", "browser_hover", "browser_navigate", "browser_screenshot",
        "browser_search", "browser_back", "browser_forward", "browser_reload", "browser_select_option", "browser_drag",
        "browser_tab_new", "browser_tab_close", "browser_tab_switch", "browser_wait", "browser", "web_search",
        "web_navigate", "web_click", "web_type", "web_scroll", "browse", "navigate",
    ),
}
#: The narrower table of one native-tool source (fixed values); kinds by exact name, effects by lower-cased name.
NATIVE_KINDS = {
    "run": "terminal",
    "run_ipython": "terminal",
    "execute_bash": "terminal",
    "str_replace_editor": "file_write",
    "file_editor": "file_write",
    "browser": "browser",
    "browse": "browser",
    "think": "planner",
    "finish": "finish",
}
NATIVE_EFFECTS = {
    "read_only": ("read", "view", "cat", "ls", "glob", "grep", "find", "head", "tail"),
    "none": ("think", "plan", "finish"),
    "network": ("browser", "browse"),
}
#: Events that stand for a call, and for a result (fixed values).
CALLS = (
    "tool_call", "terminal_command", "file_read", "file_write", "file_patch", "browser_action", "memory_read",
    "memory_write", "agent_handoff", "subtask_spawn"
)
RESULTS = ("tool_result", "terminal_output", "browser_observation", "subtask_result", "tool_message")


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def classified(name: Column) -> tuple[Column, Column, Column]:
    """(kind, side effect, normalized name) of a tool name."""
    normal = F.lower(X.strip(name))
    kinds = {n: kind for (kind, _), names in TOOLS.items() for n in names}
    effects = {n: effect for (_, effect), names in TOOLS.items() for n in names}
    browser = normal.startswith("browser_")
    kind = F.coalesce(_lookup(kinds, normal), F.when(browser, "browser"), F.lit("generic_tool"))
    effect = F.coalesce(_lookup(effects, normal), F.when(browser, "network"), F.lit("unknown"))
    return kind, effect, normal


def native_kind(name: Column) -> Column:
    return F.coalesce(_lookup(NATIVE_KINDS, name), F.lit("generic_tool"))


def native_effect(name: Column) -> Column:
    table = {n: effect for effect, names in NATIVE_EFFECTS.items() for n in names}
    return F.coalesce(_lookup(table, F.lower(name)), F.lit("workspace_write"))


def _given(x: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(x, F.lit(""))


def _with_level(t: Trajectories, changed: DataFrame, level: str) -> DataFrame:
    """Records with ``level`` set where ``changed`` (one row for each rid) says so."""
    return t.records.join(changed.withColumn("__set", F.lit(True)), "rid", "left").withColumn(
        "level", F.when(F.col("__set"), level).otherwise(F.col("level"))
    ).drop("__set")


def canonicalize_tools(t: Trajectories) -> Trajectories:
    """Classify unclassified tool calls by name; a record is canonical if one of its calls was."""
    a = F.col("action")
    open_ = (F.col("event_type") == "tool_call") & (a.isNull() | (a["kind"] == "generic_tool"))
    name = F.coalesce(_given(a["tool_name"]), F.col("metadata")["tool_name"], F.col("metadata")["tool.name"])
    kind, effect, normal = classified(F.col("__name"))
    meta = F.map_from_entries(
        F.concat(
            F.map_entries(
                F.map_filter(
                    F.coalesce(a["metadata"], empty("map<string,string>")),
                    lambda k, v: ~k.isin("tool.name.raw", "normalized_name")
                )
            ),
            F.map_entries(F.create_map(F.lit("tool.name.raw"), F.col("__name"), F.lit("normalized_name"), normal))
        )
    )
    new = struct_of(
        "action", kind=kind, tool_name=normal, tool_call_id=a["tool_call_id"],
        arguments=F.coalesce(a["arguments"], F.lit("{}")), call_style=F.coalesce(a["call_style"], F.lit("unknown")),
        side_effect_level=effect, metadata=meta
    )
    marked = t.events.withColumn("__name", F.when(open_, _given(name)))
    changed = marked.where("__name is not null").select("rid").distinct()
    events = marked.withColumn("action", F.when(F.col("__name").isNotNull(), new).otherwise(a)).drop("__name")
    return t.with_(records=_with_level(t, changed, "canonical"), events=events)


def result_call_id(e: Callable[[str], Column] = F.col) -> Column:
    """The call id that a result says it answers."""
    return F.coalesce(
        _given(e("observation")["metadata"]["tool_call_id"]), _given(e("metadata")["tool_call_id"]),
        _given(F.get_json_object(e("raw"), "$.tool_call_id"))
    )


def paired(events: DataFrame) -> DataFrame:
    """Events with ``phase`` (1 by id, 2 by adjacency, 3 by framework fields, null unpaired), ``partner`` (of a call) and ``callers`` (of a result).

    1. a call meets the last result of its episode that names its id;
    2. one still open meets the next open result without an id before the next call;
    3. the i-th open call meets the i-th open result of the same tool_use_id, then of the same
       tool name.  Windows alone: the rows of a key in an episode hold both sides.

    Events are told apart by position, never by id: ids can repeat or be null.
    """
    call, result = F.col("event_type") == "tool_call", F.col("event_type") == "tool_result"
    own = F.when(call, _given(F.col("action")["tool_call_id"])).when(result, result_call_id())
    df = events.withColumn("__seg", F.count_if(call).over(so_far())).withColumn("__id", own)
    by_id = Window.partitionBy(*EPISODE, "__id")
    at = F.struct("pos", "event_id")
    last = F.max(F.when(result, at)).over(by_id)
    calls = F.count_if(call).over(by_id)
    named = F.col("__id").isNotNull()
    df = df.withColumn("__p1", F.when(call & named, last)).withColumn(
        "__c1",
        F.when(
            result & named & (calls > 0) & (F.col("pos") == last["pos"]),
            F.transform(
                F.array_sort(F.collect_list(F.when(call, at)).over(by_id)),
                lambda x: x["event_id"]
            )
        )
    )
    done = F.col("__p1").isNotNull() | F.col("__c1").isNotNull()
    free = result & ~done & ~named
    by_seg = Window.partitionBy(*EPISODE, "__seg")
    head_open = F.max(call & ~done).over(by_seg)
    first = F.min(F.when(free, at)).over(by_seg)
    head_id = F.max(F.when(call, F.col("event_id"))).over(by_seg)
    df = df.withColumn("__p2", F.when(call & ~done, first)).withColumn(
        "__c2", F.when(free & head_open & (F.col("__seg") > 0) & (F.col("pos") == first["pos"]), F.array(head_id))
    )
    df = df.withColumn("__done", done | F.col("__p2").isNotNull() | F.col("__c2").isNotNull())
    uses = F.when(call, _given(F.col("action")["metadata"]["tool_use_id"])).when(
        result, F.coalesce(_given(F.col("observation")["metadata"]["tool_use_id"]), F.col("metadata")["tool_use_id"])
    )
    names = F.when(call, _given(F.col("action")["tool_name"])).when(
        result,
        F.coalesce(
            _given(F.col("metadata")["tool_name"]), _given(F.col("observation")["metadata"]["tool_name"]),
            _given(F.get_json_object(F.col("raw"), "$.tool_name"))
        )
    )
    for n, key in (("3", uses), ("4", names)):
        df = df.withColumn("__key", F.when(~F.col("__done"), key))
        rank = F.row_number().over(Window.partitionBy(*EPISODE, "__key", "event_type").orderBy("pos"))
        df = df.withColumn("__rank", rank)
        together = Window.partitionBy(*EPISODE, "__key", "__rank")
        match = F.col("__key").isNotNull() & (F.count_if(call).over(together) == 1) & (
            F.count_if(result).over(together) == 1
        )
        df = df.withColumn(
            f"__p{n}", F.when(call & match, F.max(F.when(result, at)).over(together))
        ).withColumn(
            f"__c{n}", F.when(result & match, F.array(F.max(F.when(call, F.col("event_id"))).over(together)))
        )
        df = df.withColumn("__done", F.col("__done") | F.col(f"__p{n}").isNotNull() | F.col(f"__c{n}").isNotNull())
    met = lambda n: F.col(f"__p{n}").isNotNull() | F.col(f"__c{n}").isNotNull()
    phase = F.when(met(1), 1).when(met(2), 2).when(met(3) | met(4), 3)
    out = df.withColumn("phase", phase).withColumn("__to", F.coalesce("__p1", "__p2", "__p3", "__p4")).withColumn(
        "partner", F.col("__to.event_id")
    ).withColumn("callers", F.coalesce("__c1", "__c2", "__c3", "__c4"))
    # the id that a result takes over from its call: the call's own, or the one made for it
    lend = F.when(
        call,
        F.coalesce(
            _given(F.col("action")["tool_call_id"]),
            F.when(
                (F.col("phase") == 2) & F.col("action")["tool_call_id"].isNull(),
                F.concat(F.lit("synth_"), F.col("event_id"))
            )
        )
    )
    pair = F.coalesce("__to.pos", F.when(result, F.col("pos")))
    out = out.withColumn("__lend", lend).withColumn("__pair", F.when(F.col("phase").isNotNull(), pair))
    out = out.withColumn(
        "lent",
        F.when(
            result & F.col("phase").isNotNull(),
            F.max_by("__lend", F.when(call, F.col("pos"))).over(Window.partitionBy(*EPISODE, "__pair"))
        ).when(call, F.col("__lend"))
    )
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def pair_tool_results(t: Trajectories) -> Trajectories:
    """Link calls and results, give adjacent calls without an id a made-up one, report what stays open.

    A result gets a parent for each of its calls, calls of equal ids included; parents that it had are not added again.
    """
    call, result = F.col("event_type") == "tool_call", F.col("event_type") == "tool_result"
    df = paired(t.events)
    a, p, o = F.col("action"), F.col("provenance"), F.col("observation")
    made = call & (F.col("phase") == 2) & a["tool_call_id"].isNull()
    new_action = F.when(
        a.isNull(),
        struct_of(
            "action", kind=F.lit("generic_tool"), tool_call_id=F.col("lent"), arguments=F.lit("{}"),
            call_style=F.lit("inferred"), side_effect_level=F.lit("unknown"), metadata=empty("map<string,string>")
        )
    ).otherwise(a.withField("tool_call_id", F.col("lent")))
    new_origin = F.when(
        p.isNull(), struct_of("provenance", parser=F.lit("pair-tool-results"), confidence=F.lit(0.7))
    ).otherwise(p.withField("confidence", F.least(p["confidence"], F.lit(0.7))))
    takes = result & F.col("lent").isNotNull() & result_call_id().isNull()
    put = lambda m: F.map_from_entries(
        F.concat(
            F.map_entries(F.map_filter(F.coalesce(m, empty("map<string,string>")), lambda k, v: k != "tool_call_id")),
            F.map_entries(F.create_map(F.lit("tool_call_id"), F.col("lent")))
        )
    )
    events = df.withColumns({
        "children": F.when(
            call & F.col("partner").isNotNull(), F.array_union("children", F.array("partner"))
        ).otherwise(F.col("children")),
        "parents": F.when(
            result & F.col("callers").isNotNull(),
            F.concat(
                "parents",
                F.filter(
                    "callers", lambda c: c.isNotNull() & ~F.coalesce(F.array_contains("parents", c), F.lit(False))
                )
            )
        ).otherwise(F.col("parents")),
        "action": F.when(made, new_action).otherwise(a),
        "provenance": F.when(made, new_origin).otherwise(p),
        "observation": F.when(takes & o.isNotNull(), o.withField("metadata", put(o["metadata"]))).otherwise(o),
        "metadata": F.when(takes & o.isNull(), put(F.col("metadata"))).otherwise(F.col("metadata")),
    })
    open_ = df.where(F.col("phase").isNull() & (call | result))
    found = diagnostics_of(open_, "pair-tool-results", F.when(call, "PAIR001").otherwise("PAIR002"))
    return t.with_(events=events_of(events), diagnostics=[found])


def redact_reasoning(t: Trajectories, policy: str | None = "metadata_only") -> Trajectories:
    """Apply a policy to reasoning events; an unknown or null policy is metadata_only."""
    policy = policy if policy in ("preserve", "summarize", "drop", "redact", "metadata_only") else "metadata_only"
    reasoning, v = F.col("event_type") == "reasoning", F.col("visibility")
    content = {
        "preserve": None, "summarize": F.array(text_block(F.lit("[REASONING_SUMMARY_NOT_IMPLEMENTED]"))),
        "drop": empty(SCHEMAS["content"]), "redact": F.array(text_block(F.lit("[REDACTED_REASONING]"))),
        "metadata_only": empty(SCHEMAS["content"])
    }[policy]
    changed = v.withField("contains_reasoning", F.lit(True)).withField("policy", F.lit(policy))
    if policy == "drop":
        changed = changed.withField("trainable", F.lit(False))
    if policy in ("redact", "metadata_only"):
        changed = changed.withField("redaction_status", F.lit({"redact": "redacted"}.get(policy, policy)))
    events = t.events.withColumn("visibility", F.when(reasoning, changed).otherwise(v))
    if content is not None:
        events = events.withColumn("content", F.when(reasoning, content).otherwise(F.col("content")))
    return t.with_(events=events)


def normalize_outcome(t: Trajectories) -> Trajectories:
    """Reward, pass flag, verifier and failure reason from metadata or the raw row; passed is authoritative for the status."""
    raw = F.coalesce(F.try_parse_json("raw"), F.parse_json(F.lit("{}")))
    o, m, v = F.col("outcome"), F.col("metadata"), F.col("__raw")
    reward = F.coalesce(m["reward"].try_cast("double"), X.said(v, "$.reward").try_cast("double"))
    flag = lambda x: F.when(x.isin("true", "false"), x == "true")
    passed = F.coalesce(
        flag(m["success"]),
        F.when(X.is_bool(X.get(v, "$.test_result.passed")), X.get(v, "$.test_result.passed", "boolean"))
    )
    trial = X.get(v, "$.trial")
    swe = F.try_parse_json(m["swebench"])
    source = F.when(X.is_object(trial), trial).when(X.is_object(swe), swe)
    resolved = X.get(F.col("__source"), "$.resolved")
    pick = lambda *paths: F.coalesce(*[_given(X.said(F.col("__source"), p)) for p in paths])
    truth = F.when(X.is_bool(resolved), X.get(F.col("__source"), "$.resolved", "boolean")).otherwise(
        ~F.coalesce(X.said(F.col("__source"), "$.resolved"), F.lit("")).isin("", "0", "0.0", "[]", "{}")
    )
    score = F.coalesce(
        X.said(F.col("__source"), "$.score").try_cast("double"),
        F.when(X.is_bool(resolved), F.when(truth, 1.0).otherwise(0.0))
    )
    verifier = F.when(
        X.exists(resolved),
        struct_of(
            "verifier", passed=truth, score=score, command=pick("$.command", "$.test_command"),
            output=pick("$.test_output", "$.output")
        )
    )
    blank = (F.coalesce(m["has_empty_response"], F.lit("")) == "true") | (
        X.is_bool(X.get(v, "$.has_empty_response")) & F.coalesce(
            X.get(v, "$.has_empty_response", "boolean"), F.lit(False)
        )
    )
    found = t.records.withColumn("__raw", raw).withColumn("__source", source)
    found = found.withColumn(
        "__o",
        F.struct(
            F.coalesce(reward, o["reward"]).alias("reward"), F.coalesce(passed, o["passed"]).alias("passed"),
            F.coalesce(verifier, o["verifier"]).alias("verifier"),
            F.coalesce(F.when(blank, "empty_response"), o["failure_reason"]).alias("failure_reason")
        )
    )
    n = F.col("__o")
    status = F.when(n["passed"], "success").when(~n["passed"], "failure").when(
        n["reward"].isNotNull(), "partial"
    ).otherwise("unknown")
    outcome = struct_of(
        "outcome", status=status, reward=n["reward"], passed=n["passed"], failure_reason=n["failure_reason"],
        final_patch_artifact_id=o["final_patch_artifact_id"], verifier=n["verifier"]
    )
    records = found.withColumn("outcome", outcome).drop("__raw", "__source", "__o")
    conflict = (
        (F.col("outcome.reward") > 0) & ~F.col("outcome.passed")
    ) | ((F.col("outcome.reward") <= 0) & F.col("outcome.passed"))
    return t.with_(
        records=records,
        diagnostics=[diagnostics_of(records.where(conflict), "normalize-outcome", "OUTCOME001", "outcome")]
    )


def slice_training(t: Trajectories, keep_non_trainable: bool = False) -> Trajectories:
    """Keep trainable events; drop calls all of whose results went, then results all of whose calls went; number anew.

    Ids that an episode does not have count as gone; of repeated ids the last counts.  Events
    and a light row for each of their links are dealt by record once.  A window over an id
    tells its links whether it lives on, a window over an event gathers the links' answers.
    """
    alive = F.lit(True) if keep_non_trainable else F.coalesce(F.col("visibility.trainable"), F.lit(True))
    of = F.col("event_type")

    def links(kind: int, column: str, types: tuple[str, ...]) -> Column:
        ids = F.when(of.isin(*types), F.col(column)).otherwise(empty("array<string>"))
        return F.transform(ids, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("id")))

    own = F.array(F.struct(F.lit(0).alias("kind"), F.col("event_id").alias("id")))
    names = [c for c in EVENT_FIELDS if c not in ("rid", "record_id", "ep_pos", "pos")]
    rows = t.events.select(
        "rid", "record_id", "ep_pos", "pos", alive.alias("__alive"), F.struct(*names).alias("__event"),
        F.explode(F.concat(own, links(1, "children", CALLS), links(2, "parents", RESULTS))).alias("__x"),
    )
    kind = F.col("__kind")
    rows = rows.select(
        "rid", "record_id", "ep_pos", "pos", "__alive", F.col("__x.kind").alias("__kind"), F.col("__x.id").alias("__id"),
        F.when(F.col("__x.kind") == 0, F.col("__event")).alias("__event"), null_of("string").alias("__lost"),
    ).repartition("rid")
    for phase, name in ((1, "call"), (2, "result")):
        target = F.max_by("__alive", F.when(kind == 0, F.col("pos"))).over(Window.partitionBy(*EPISODE, "__id"))
        rows = rows.withColumn("__kept", F.when(kind == phase, F.coalesce(target, F.lit(False))))
        kept = F.coalesce(F.bool_or("__kept").over(Window.partitionBy(*EPISODE, "pos")), F.lit(True))
        rows = rows.withColumn("__kept", kept).withColumn(
            "__lost", F.when(F.col("__alive") & ~F.col("__kept"), name).otherwise(F.col("__lost"))
        )
        rows = rows.withColumn("__alive", F.col("__alive") & F.col("__kept")).drop("__kept")
    done = rows.where(kind == 0).select("rid", "record_id", "ep_pos", "pos", "__alive", "__lost", "__event.*")
    kept = done.where("__alive").withColumn(
        "idx", F.row_number().over(in_order()).cast("bigint") - 1
    ).withColumn("pos", F.col("idx"))
    lost = diagnostics_of(
        done.where("__lost is not null"), "slice-training", F.concat(F.lit("slice-training:dropped-orphan-"), "__lost")
    )
    # not in the table of codes: an information that says itself
    lost = lost.withColumns({"severity": F.lit("info"), "message": F.col("code")})
    return t.with_(records=t.records.withColumn("level", F.lit("training")), events=events_of(kept), diagnostics=[lost])


def slice_metrics(before: Trajectories, after: Trajectories) -> DataFrame:
    """``(rid, events_before, events_after, events_dropped)``."""
    n = lambda e, name: e.groupBy("rid").agg(F.count("*").alias(name))
    both = n(before.events, "events_before").join(
        n(after.events, "events_after"), "rid", "left"
    ).na.fill(0, ["events_after"])
    return both.withColumn("events_dropped", F.col("events_before") - F.col("events_after"))


def verify(t: Trajectories, strict: bool = False) -> Trajectories:
    """Structural checks; see the codes VERIFY001 to VERIFY004."""
    e, name = t.events, "verify"
    nth = F.row_number().over(Window.partitionBy(*EPISODE, "event_id").orderBy("pos"))
    checked = e.select(
        "rid", "record_id", *EPISODE[1:], "pos", "event_id", "idx", nth.alias("nth"),
        F.lag("idx").over(in_order()).alias("before")
    )
    ids = e.select(*EPISODE, F.col("event_id").alias("to")).distinct()
    parents = e.select(
        "rid", "record_id", "ep_pos", "event_id", F.explode("parents").alias("to")
    ).join(ids, [*EPISODE, "to"], "left_anti")
    known = t.records.select("rid", F.explode("artifacts.artifact_id").alias("to")).distinct()
    artifacts = e.select(
        "rid", "record_id", "event_id", F.explode("artifacts").alias("to")
    ).join(known, ["rid", "to"], "left_anti")
    unnamed = e.where(
        (F.col("event_type") == "tool_call") & F.col("action").isNotNull() & _given(F.col("action.tool_name")).isNull()
    )
    unruled = e.where((F.col("event_type") == "reasoning") & F.col("visibility.policy").isNull())
    found = [
        diagnostics_of(checked.where("nth > 1"), name, "VERIFY001", "event_id"),
        diagnostics_of(checked.where("idx <= before"), name, "VERIFY001", "idx"),
        diagnostics_of(parents, name, "VERIFY002", "parent_event_ids"),
        diagnostics_of(unnamed, name, "VERIFY002", "tool_name"),
        diagnostics_of(artifacts, name, "VERIFY003", "artifacts"),
        diagnostics_of(unruled, name, "VERIFY004", "visibility"),
    ]
    if strict:
        call_ids = e.where(
            (F.col("event_type") == "tool_call") & _given(F.col("action.tool_call_id")).isNotNull()
        ).select("rid", F.col("action.tool_call_id").alias("to")).distinct()
        results = e.where(
            (F.col("event_type") == "tool_result") & _given(F.col("action.tool_call_id")).isNotNull()
        ).select("rid", "record_id", "event_id", F.col("action.tool_call_id").alias("to"))
        blank = e.where(
            (F.col("event_type") == "assistant_message") & ~F.exists("content", lambda b: ~X.is_blank(b["text"]))
        )
        unsourced = e.where("provenance is null")
        found += [
            diagnostics_of(results.join(call_ids, ["rid", "to"], "left_anti"), name, "VERIFY002", "tool_call_id"),
            diagnostics_of(blank, name, "VERIFY004", "content"),
            diagnostics_of(unsourced, name, "VERIFY004", "provenance")
        ]
    return t.with_(diagnostics=found)


_BLOCK = r"(?s)<tool_call>\s*(.*?)\s*</tool_call>|<tool_response>\s*(.*?)\s*</tool_response>"


def parse_xml_calls(t: Trajectories) -> Trajectories:
    """Tool calls and responses written as XML blocks in assistant texts become events after their own.

    The i-th new event of a source event is ``<id>-hx-<i>`` with idx above every idx so far;
    later events keep theirs.  Blocks are found in one left-to-right scan.
    """
    text = F.when(
        F.col("role") == "assistant",
        F.array_join(F.transform("content", lambda b: F.coalesce(b["text"], F.lit(""))), "")
    )
    found = F.regexp_extract_all(F.col("__text"), F.lit(_BLOCK), F.lit(0))
    df = t.events.withColumn("__text", text).withColumn(
        "__blocks", F.coalesce(found, empty("array<string>"))
    ).withColumn("__n", F.size("__blocks"))
    # running maximum with k new events after each source: sum of earlier k + max over (idx - sum of k before)
    before = F.coalesce(F.sum("__n").over(in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.withColumn("__before", before)
    df = df.withColumn(
        "__base", F.col("__before") + F.max(F.col("idx") - F.col("__before")).over(so_far())
    ).withColumn("__shift", F.col("__before"))
    new = df.where("__n > 0").select(
        "rid", "record_id", "ep_pos", "episode_id", "pos", "event_id", "provenance", "__base", "__shift",
        F.posexplode("__blocks").alias("__i", "__block")
    )
    inner = F.col("__inner")
    new = new.withColumn("__call", F.col("__block").startswith("<tool_call>")).withColumn(
        "__inner", X.strip(F.regexp_replace("__block", r"^<tool_(call|response)>|</tool_(call|response)>$", ""))
    )
    v = F.try_parse_json(inner)
    arguments = F.when(X.is_object(X.get(v, "$.arguments")), F.get_json_object(inner, "$.arguments")).when(
        X.exists(X.get(v, "$.arguments")), F.to_json(F.struct(X.said(v, "$.arguments").alias("_raw")))
    ).otherwise(F.lit("{}"))
    action = struct_of(
        "action", kind=F.lit("generic_tool"), tool_name=X.string(v, "$.name"), arguments=arguments,
        call_style=F.lit("xml_block"), side_effect_level=F.lit("unknown"), metadata=empty("map<string,string>")
    )
    json = F.when(X.is_object(v), inner).otherwise(F.to_json(F.struct(inner.alias("_raw"))))
    block = F.array(F.struct(F.lit("json").alias("type"), null_of("string").alias("text"), json.alias("json")))
    new = new.select(
        "rid", "record_id", "ep_pos", "episode_id", (
            F.col("pos") + F.col("__shift") + 1 + F.col("__i")
        ).alias("pos"), F.concat(
            "event_id", F.lit("-hx-"), F.col("__i")
        ).alias("event_id"), (F.col("__base") + 1 + F.col("__i")).alias("idx"),
        F.when(F.col("__call"), "tool_call").otherwise("tool_result").alias("event_type"), F.when(
            F.col("__call"), "assistant"
        ).otherwise("tool").alias("role"), F.when(F.col("__call"), action).alias("action"),
        F.when(F.col("__call"), empty(SCHEMAS["content"])).otherwise(block).alias("content"), struct_of(
            "provenance", source_field=F.col("provenance.source_field"), parser=F.lit("parse-hermes-xml"),
            confidence=F.lit(1.0)
        ).alias("provenance"),
    )
    old = df.withColumn("pos", F.col("pos") + F.col("__before"))
    return t.with_(
        records=t.records.withColumn("level", F.lit("parsed")), events=events_of(old).unionByName(events_of(new))
    )


def _appended(t: Trajectories, new: DataFrame) -> DataFrame:
    """Events of episode 0 with others after them; ``new`` has rid and, as pos, its order among the new."""
    last = t.events.where("ep_pos = 0").groupBy("rid").agg(F.max("pos").alias("__last"))
    new = new.join(last, "rid", "left").withColumn(
        "pos", F.coalesce("__last", F.lit(-1)) + 1 + F.col("pos")
    ).withColumn("ep_pos", F.lit(0))
    first = t.events.where("ep_pos = 0").groupBy("rid").agg(F.first("episode_id").alias("__ep"))
    new = new.join(first, "rid", "left").withColumn("episode_id", F.coalesce("__ep", F.lit("ep_0001")))
    return t.events.unionByName(events_of(new))


def parse_turns(t: Trajectories, skip_if_parsed: bool = False) -> Trajectories:
    """Append the turns of the raw row as message events.

    Ids go on from the number of events the record has, skipping taken ones.  Records that a
    frontend has parsed get their turns a second time unless ``skip_if_parsed``.
    """
    from weftline.sources.frontends import message_types, normal_role, turn_role, turn_text

    held = t.events.groupBy("rid").agg(F.count("*").alias("__n"), F.collect_set("event_id").alias("__taken"))
    v = F.try_parse_json("raw")
    turns = F.coalesce(X.items(v, "$.messages"), X.items(v, "$.conversations"), X.items(v, "$.conversation"))
    rows = t.records.select("rid", "record_id", turns.alias("__turns")).join(held, "rid", "left").withColumn(
        "__n", F.coalesce("__n", F.lit(0)).cast("int")
    )
    if skip_if_parsed:
        rows = rows.where("__n = 0")
    rows = rows.where("size(__turns) > 0")
    taken = F.coalesce("__taken", empty("array<string>"))
    free = F.filter(
        F.transform(
            F.sequence("__n", F.col("__n") + F.size("__turns") + F.size(taken)), lambda k: X.number("evt_%04d", k)
        ),
        lambda x: ~F.array_contains(taken, x)
    )
    new = rows.withColumn("__free", free).select(
        "rid", "record_id", "__n", "__free", F.posexplode("__turns").alias("__i", "__turn")
    )
    role = normal_role(turn_role(F.col("__turn")))
    kind, ir_role = message_types(role)
    content = turn_text(F.col("__turn"))
    new = new.select(
        "rid", "record_id", F.col("__i").cast("bigint").alias("pos"), F.col("__free")[F.col("__i")].alias("event_id"),
        (F.col("__n") + F.col("__i")).cast("bigint").alias("idx"), kind.alias("event_type"), ir_role.alias("role"),
        F.when(content != "", F.array(text_block(content))).otherwise(empty(SCHEMAS["content"])).alias("content"),
        struct_of("provenance", parser=F.lit("parse-sharegpt"), confidence=F.lit(0.9)).alias("provenance"),
        F.to_json("__turn").alias("raw")
    )
    return t.with_(records=_with_level(t, rows.select("rid"), "parsed"), events=_appended(t, new))


_DIFF = r"(?m)^diff --git|^--- a/"
_DIFF_BLOCK = r"(?m)^(?:diff --git [^\n]*\n(?:(?:index|new file|deleted file|old mode|new mode|similarity|rename|copy|Binary)[^\n]*(?:\n|\z))*(?:--- [^\n]*\n\+\+\+ [^\n]*(?:\n|\z))?|--- a/[^\n]*\n\+\+\+ [^\n]*(?:\n|\z))(?:(?:@@|[+\\ -](?!-- a/))[^\n]*(?:\n|\z))*"


def diff_blocks(text: Column) -> Column:
    """The unified diffs of a text, headers and hunks whole, one for each file."""
    return F.when(text.rlike(_DIFF), F.regexp_extract_all(text, F.lit(_DIFF_BLOCK), F.lit(0)))


def written_files(diff: Column) -> Column:
    """Target names as the diff has them (with their b/ prefix)."""
    return F.filter(F.regexp_extract_all(diff, F.lit(r"(?m)^\+\+\+ ([^\s]+)"), F.lit(1)), lambda x: x != "/dev/null")


def extract_patches(t: Trajectories) -> Trajectories:
    """Patches of the raw row (model_patch, gitdiff) and of assistant texts become artifacts and file_patch events."""
    v = F.try_parse_json("raw")
    one = lambda n, field: F.struct(
        F.lit(n).alias("source"), F.lit(0).cast("bigint").alias("at"), null_of("string").alias("parent"),
        _given(X.string(v, f"$.{field}")).alias("diff")
    )
    own = F.array(one(0, "model_patch"), one(1, "gitdiff"))
    of_rows = t.records.select(
        "rid", "record_id", F.explode(own).alias("p")
    ).select("rid", "record_id", "p.*").where("diff is not null").withColumn("nth", F.lit(0))
    said = t.events.where("event_type = 'assistant_message'").select(
        "rid", "record_id", (F.col("ep_pos") * (1 << 40) + F.col("pos")).alias("at"), F.col("event_id").alias("parent"),
        F.explode("content.text").alias("text")
    )
    of_text = said.select(
        "rid", "record_id", F.lit(2).alias("source"), "at", "parent",
        F.posexplode(diff_blocks(F.col("text"))).alias("nth", "diff")
    )
    found = of_rows.unionByName(of_text)
    n = F.row_number().over(Window.partitionBy("rid").orderBy("source", "at", "nth", "diff"))
    held = t.records.select("rid", F.size("artifacts").alias("__held")).join(
        t.events.groupBy("rid").agg(F.max("idx").alias("__max")), "rid", "left"
    )
    found = found.withColumn("__n", n).join(held, "rid").withColumn(
        "artifact_id", X.number("art_%04d", F.col("__held") + F.col("__n") - 1)
    ).withColumn(
        "event_id", X.number("evt_patch_%04d", F.col("__held") + F.col("__n") - 1)
    )
    files = written_files(F.col("diff"))
    new = found.select(
        "rid", "record_id", (F.col("__n") - 1).cast("bigint").alias("pos"), "event_id",
        (F.coalesce("__max", F.lit(-1)) + F.col("__n")).alias("idx"), F.lit("file_patch").alias("event_type"),
        F.lit("assistant").alias("role"),
        F.when(F.col("parent").isNotNull(), F.array("parent")).otherwise(empty("array<string>")).alias("parents"),
        F.array("artifact_id").alias("artifacts"), files.alias("writes"),
        F.col("artifact_id").alias("patch_artifact_id"),
        struct_of(
            "provenance", parser=F.lit("extract-patches"), confidence=F.when(F.size(files) > 0, 1.0).otherwise(0.5)
        ).alias("provenance")
    )
    made = F.struct(
        "artifact_id", F.lit("patch").alias("kind"), F.col("diff").alias("content"),
        F.sha2("diff", 256).alias("sha256"), F.octet_length("diff").cast("bigint").alias("size_bytes"),
        F.col("event_id").alias("created_by")
    )
    added = found.groupBy("rid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__n", made.alias("a")))), lambda x: x["a"]).alias("__new"),
        F.max_by("artifact_id", "__n").alias("__final")
    )
    outcome = F.coalesce(
        F.col("outcome"), struct_of("outcome", status=F.lit("unknown"))
    ).withField("final_patch_artifact_id", F.col("__final"))
    records = t.records.join(added, "rid", "left").withColumn(
        "artifacts", F.concat("artifacts", F.coalesce("__new", empty(SCHEMAS["artifact_list"])))
    ).withColumn(
        "outcome", F.when(F.col("__final").isNotNull(), outcome).otherwise(F.col("outcome"))
    ).drop("__new", "__final")
    return t.with_(
        records=records, events=_appended(t, new),
        diagnostics=[diagnostics_of(found.where(F.size(files) == 0), "extract-patches", "PARSE002")]
    )


def parse_native_calls(t: Trajectories) -> Trajectories:
    """Messages with native tool calls (raw ``messages``) become message, call and result events; results are linked to the latest call of their id.

    For raw records: those that a frontend has parsed stay as they are.
    """
    from weftline.sources.frontends import native_message_events

    v = F.try_parse_json("raw")
    rows = t.records.select("rid", "record_id", X.items(v, "$.messages").alias("turns")).where("size(turns) > 0")
    rows = rows.join(t.events.select("rid").distinct(), "rid", "left_anti")
    return t.with_(events=_appended(t, latest_calls(native_message_events(rows, "parse-openhands-tool-calls"))))


def latest_calls(events: DataFrame) -> DataFrame:
    """Results with the id of the latest call before them that has their call id as a parent, and calls with those results as children."""
    cid = _given(F.col("action.tool_call_id"))
    same = Window.partitionBy("rid", "__cid").orderBy("pos")
    df = events.withColumn("__cid", cid)
    call = F.last(
        F.when(F.col("event_type") == "tool_call", F.col("event_id")), ignorenulls=True
    ).over(same.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("__call", F.when((F.col("event_type") == "tool_result") & F.col("__cid").isNotNull(), call))
    group = F.coalesce("__call", F.when(F.col("event_type") == "tool_call", F.col("event_id")))
    df = df.withColumn("__group", group)
    children = F.transform(
        F.array_sort(
            F.collect_list(
                F.when(F.col("__call").isNotNull(), F.struct("pos", "event_id"))
            ).over(Window.partitionBy("rid", "__group"))
        ),
        lambda x: x["event_id"]
    )
    df = df.withColumn(
        "parents", F.when(F.col("__call").isNotNull(), F.array("__call")).otherwise(empty("array<string>"))
    )
    return df.withColumn(
        "children", F.when(F.col("event_type") == "tool_call", children).otherwise(empty("array<string>"))
    ).drop("__cid", "__call", "__group")


def parse_coding_log(t: Trajectories) -> Trajectories:
    """Coding-log rows: messages of ``messages_json``, an assistant event of ``assistant_response`` where there is none, tools without repeated names, and the ``gitdiff`` as a patch."""
    from weftline.sources.frontends import coding_log_events, log_tools

    v = F.try_parse_json("raw")
    rows = t.records.select("rid", "record_id", v.alias("v"))
    has_assistant = t.events.groupBy("rid").agg(F.bool_or(F.col("role") == "assistant").alias("__said"))
    new = coding_log_events(rows, "parse-claude-log")
    reply = rows.join(has_assistant, "rid", "left").join(
        new.groupBy("rid").agg(F.bool_or(F.col("role") == "assistant").alias("__new")), "rid", "left"
    )
    reply = reply.where(
        ~F.coalesce("__said", F.lit(False)) & ~F.coalesce("__new", F.lit(False))
    ).withColumn("text", X.string(F.col("v"), "$.assistant_response"))
    single = reply.where(~X.is_blank(F.col("text"))).select(
        "rid", "record_id", F.lit(1 << 30).cast("bigint").alias("pos"),
        F.concat("record_id", F.lit("-response")).alias("event_id"), F.lit(1 << 30).cast("bigint").alias("idx"),
        F.lit("assistant_message").alias("event_type"), F.lit("assistant").alias("role"),
        F.array(text_block(F.col("text"))).alias("content")
    )
    records = t.records.join(rows.select("rid", log_tools(F.col("v")).alias("__tools")), "rid", "left").withColumn(
        "tools", F.when(F.size("tools") > 0, F.col("tools")).otherwise(F.coalesce("__tools", F.col("tools")))
    ).drop("__tools")
    blank = reply.where(X.exists(X.get(F.col("v"), "$.assistant_response")) & X.is_blank(F.col("text")))
    return t.with_(
        records=records, events=_appended(t, events_of(new).unionByName(events_of(single))),
        diagnostics=[diagnostics_of(blank, "parse-claude-log", "DATA001", "assistant_response")]
    )


PASSES: dict[str, Callable[[Trajectories], Trajectories]] = {
    "parse-sharegpt": parse_turns,
    "parse-hermes-xml": parse_xml_calls,
    "parse-openhands-tool-calls": parse_native_calls,
    "parse-claude-log": parse_coding_log,
    "canonicalize-tools": canonicalize_tools,
    "pair-tool-results": pair_tool_results,
    "extract-patches": extract_patches,
    "normalize-outcome": normalize_outcome,
    "redact-reasoning": redact_reasoning,
    "slice-training": slice_training,
    "verify": verify,
}
#: Named pass lists (fixed values).
GROUPS = {
    "default": ("parse-sharegpt", "canonicalize-tools", "pair-tool-results", "normalize-outcome", "verify"),
    "training": (
        "parse-sharegpt", "canonicalize-tools", "pair-tool-results", "normalize-outcome", "redact-reasoning",
        "slice-training", "verify"
    ),
    "minimal": ("normalize-outcome", "verify"),
    "full": tuple(sorted(PASSES)),
}


def register_pass(name: str, f: Callable[[Trajectories], Trajectories]) -> None:
    PASSES[name] = f


def validated(names: list[str] | tuple[str, ...] | str) -> tuple[str, ...]:
    """Pass names of a list or group; an unknown one is a ValueError before anything runs."""
    chosen = GROUPS[names] if isinstance(names, str) and names in GROUPS else (names,) if isinstance(names, str) else tuple(names)
    unknown = [n for n in chosen if n not in PASSES]
    if unknown:
        raise ValueError(f"unknown pass: {', '.join(unknown)}; known: {', '.join(sorted(PASSES))}")
    return chosen


#: Passes that join events or records with themselves: their result is settled before the next pass.
JOINING = frozenset(
    n for n in PASSES if n.startswith("parse-") and n != "parse-hermes-xml"
) | {"extract-patches", "slice-training", "canonicalize-tools"}


def run_passes(
    t: Trajectories, names: list[str] | tuple[str, ...] | str = "default", settle: bool = True, **options: dict
) -> Trajectories:
    """The passes in order; ``options`` has keyword arguments by pass name (with _ for -).

    One lazy plan, but for ``settle``: a pass that joins is written out if another follows.
    """
    chosen = validated(names)
    for i, n in enumerate(chosen):
        t = PASSES[n](t, **options.get(n.replace("-", "_"), {}))
        if settle and n in JOINING and i + 1 < len(chosen):
            t = t.settled()
    return t
