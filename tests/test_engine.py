"""Frontends, passes, lowering, formats and files on rows made for the case."""

import json
import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import CODES, Trajectories, events_of, no_diagnostics, records_of, struct_of, text_block, visible
from weftline.operators import lowering, passes
from weftline.plans import pipeline
from weftline.sources import files, frontends, spec
from weftline.streaming import convert as stream


def rows(spark, *items):
    return spark.createDataFrame(
        [(i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)], "rid bigint, raw string"
    )


def parsed(spark, name, *items):
    return frontends.convert(rows(spark, *items), name)[0]


def events(t, *columns):
    return [tuple(r) for r in t.events.orderBy("rid", "ep_pos", "pos").select(*columns).collect()]


def codes(t):
    return sorted((r["code"], r["event_id"]) for r in t.diagnostics.collect())


def episode(spark, *items):
    """Trajectories of one record from dicts: type, and what the case needs."""
    schema = "pos bigint, type string, id string, cid string, rcid string, tool string, rtool string, text string, out string, trainable boolean, parents array<string>, children array<string>, use string"
    data = [
        (
            i, e["type"], e.get("id", f"e{i}"), e.get("cid"), e.get("rcid"), e.get("tool"), e.get("rtool"),
            e.get("text"), e.get("out"), e.get("trainable", True), e.get("parents", []), e.get("children", []),
            e.get("use")
        ) for i,
        e in enumerate(items)
    ]
    d = spark.createDataFrame(data, schema)
    meta = lambda **kv: F.map_filter(
        F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull()
    )
    action = F.when(
        F.col("type").isin(*lowering.CALLS) | F.col("cid").isNotNull(),
        struct_of(
            "action", kind=F.lit("generic_tool"), tool_name=F.col("tool"), tool_call_id=F.col("cid"),
            arguments=F.lit('{"command":"ls"}'), metadata=meta(tool_use_id=F.col("use"))
        )
    )
    observation = F.when(
        F.col("out").isNotNull() | (F.col("type") == "tool_result"),
        struct_of(
            "observation", kind=F.lit("x"), stdout=F.col("out"),
            metadata=meta(
                tool_call_id=F.col("rcid"), tool_name=F.col("rtool"),
                tool_use_id=F.when(F.col("type") == "tool_result", F.col("use"))
            )
        )
    )
    role = F.when(F.col("type").startswith("user"), "user").when(
        F.col("type").startswith("system"), "system"
    ).when(F.col("type") == "tool_result", "tool").otherwise("assistant")
    content = F.when(F.col("text").isNotNull(), F.array(text_block(F.col("text")))).otherwise(
        F.array().cast("array<struct<type:string,text:string,json:string>>")
    )
    made = events_of(
        d.select(
            F.lit(0).cast("bigint").alias("rid"), F.lit("r").alias("record_id"), "pos", F.col("id").alias("event_id"),
            F.col("pos").alias("idx"), F.col("type").alias("event_type"), role.alias("role"), content.alias("content"),
            action.alias("action"), observation.alias("observation"), "parents", "children",
            visible(trainable=F.col("trainable")).alias("visibility")
        )
    )
    record = records_of(spark.createDataFrame([(0, "r")], "rid bigint, record_id string"))
    return Trajectories(record, made, no_diagnostics(made))


CHAT = {
    "messages": [
        {"role": "user", "content": "hi"}, {"from": "gpt", "value": "yo"},
        {
            "role": "Human ",
            "content": [{"type": "text", "text": "a"}, {"type": "image_url", "image_url": {"url": "u"}}, "b"]
        },
        {"role": "odd"}
    ],
    "reward": "0.5", "original_source": "s"
}


def test_rewarded_frontend(spark):
    t = parsed(spark, "agenttrove", CHAT, {"messages": []}, {"x": 1})
    assert events(t, "event_id", "event_type", "role") == [
        ("evt_0000", "user_message", "user"), ("evt_0001", "assistant_message", "assistant"),
        ("evt_0002", "user_message", "user"), ("evt_0003", "unparsed_fragment", "unknown")
    ]
    assert events(t, F.transform("content", lambda b: b["type"]))[2][0] == ["text", "image"]
    record = t.records.collect()
    assert len(record) == 1 and record[0]["outcome"]["reward"] == 0.5 and record[0]["source"]["original_source"] == "s"
    assert codes(t) == [("DATA002", None), ("DATA002", None)]


def test_detection(spark):
    df = rows(
        spark, CHAT, {"conversations": [{"from": "human", "value": "x"}] * 3, "tools": "[]", "category": "c"},
        {"trajectory": [], "trajectory_id": "t", "repo": "r"},
        {"messages_json": "[]", "gitdiff": "d", "claude_log": "l"},
        {"conversations": [{"from": "a", "value": "b"}], "repo": "r", "instance_id": "i"}
    )
    scores = {(r["rid"], r["frontend"]): r["score"] for r in frontends.detection_scores(df).collect()}
    assert scores[0, "agenttrove"] == pytest.approx(0.9) and scores[1, "hermes-agent"] == pytest.approx(0.88)
    assert scores[2, "openhands"] == 0.75 and scores[3, "claude-code"] == pytest.approx(0.4) and scores[
        4, "codex-swebenchpro"
    ] == 1.0
    best = {r["rid"]: r["frontend"] for r in frontends.best_frontend(df).collect()}
    assert best[0] == "agenttrove" and best[2] == "openhands"


def test_verified_frontend(spark):
    t = parsed(
        spark, "codex-swebenchpro",
        {
            "instance_id": "i1",
            "conversations": [{"from": "human", "value": "q"}, "junk", {"from": "gpt", "value": "a"}], "pass": False,
            "resolved": True, "repo": "r", "extra": {"k": 1}, "verifier": {"passed": True, "score": 1}
        }
    )
    assert events(t, "pos", "idx", "event_id") == [(0, 0, "i1-evt-0"), (1, 2, "i1-evt-2")]
    r = t.records.first()
    assert r["outcome"]["status"] == "success" and r["outcome"]["verifier"]["score"] == 1.0 and r["task"]["benchmark"] == "swebench-pro" and r["metadata"] == {"extra": '{"k":1}'}
    assert codes(t) == [("DATA002", None)]


def test_coding_log_frontend(spark):
    log = {
        "messages_json": json.dumps(
            [
                {"role": "user", "content": "q"},
                {"role": "assistant", "content": [{"type": "tool_use", "id": "u1", "name": "bash", "input": {"a": 1}}]},
                {"role": "assistant", "content": " "}, {"role": "tool", "content": "res"}
            ]
        ),
        "tools_json": json.dumps([{"name": "bash", "input_schema": {}}, {"name": "bash"}]), "gitdiff": "--- a/f\n",
        "claude_log": "x" * 70
    }
    flat = {"system_prompt": "s", "user_prompt": "u", "assistant_response": "a", "claude_log": "short"}
    t = parsed(spark, "claude-code", log, flat)
    assert events(t, "rid", "event_type") == [
        (0, "user_message"), (0, "assistant_message"), (0, "assistant_message"), (0, "tool_message"), (0, "file_patch"),
        (1, "system_message"), (1, "user_message"), (1, "assistant_message")
    ]
    r = {x["rid"]: x for x in t.records.collect()}
    assert [a["kind"] for a in r[0]["artifacts"]] == [
        "patch", "terminal_log"
    ] and r[0]["artifacts"][0]["size_bytes"] == 8 and len(r[0]["tools"]) == 1
    assert r[1]["metadata"] == {"claude_log": "short"} and [c for c, _ in codes(t)] == ["DATA001"]
    assert events(t, "action.tool_name", "action.call_style")[1] == ("bash", "inferred")


def test_native_frontend(spark):
    row = {
        "trajectory_id": "t", "model_patch": "p",
        "trajectory": [
            {"role": "user", "content": "q"},
            {
                "role": "assistant", "content": "thinking",
                "tool_calls": [
                    {"id": "c1", "function": {"name": "run", "arguments": '{"a": 1}'}},
                    {"id": "c2", "function": {"name": "run", "arguments": "{bad"}}
                ]
            },
            {"role": "tool", "tool_call_id": "c1", "content": "out"}, 5
        ]
    }
    t = parsed(spark, "openhands", row, {"trajectory": "no"})
    assert events(t, "event_id", "event_type", "action.arguments") == [
        ("t-evt-0", "user_message", None), ("t-evt-1", "assistant_message", None), ("t-evt-2", "tool_call", '{"a": 1}'),
        ("t-evt-3", "tool_call", '{"_raw":"{bad"}'), ("t-evt-4", "tool_result", "{}")
    ]
    assert t.records.where("rid = 0").first()["outcome"]["final_patch_artifact_id"] == "t-patch"
    assert [c for c, _ in codes(t)] == ["DATA002"]


def test_reasoning_frontend(spark):
    t = parsed(
        spark, "hermes-agent",
        {
            "id": "h", "tools": '{"tools": [{"function": {"name": "f", "parameters": {"a": 1}}}]}', "task": "do",
            "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "༄ hm"}, 3]
        }
    )
    assert events(t, "event_type", "visibility.policy") == [("user_message", None), ("reasoning", "metadata_only")]
    assert t.records.first()["tools"][0]["name"] == "f" and t.records.first()["task"]["instruction"] == "do"


def test_xml_calls(spark):
    text = 'a<tool_call>{"name":"read","arguments":{"p":"x"}}</tool_call>b<tool_response>{"r":1}</tool_response><tool_call>oops</tool_call>'
    t = passes.parse_xml_calls(
        parsed(
            spark, "agenttrove",
            {
                "messages": [
                    {"role": "user", "content": text}, {"role": "assistant", "content": text},
                    {"role": "user", "content": "z"}
                ]
            }
        )
    )
    assert events(t, "event_id", "idx", "event_type", "action.tool_name", "action.arguments") == [
        ("evt_0000", 0, "user_message", None, None), ("evt_0001", 1, "assistant_message", None, None), (
            "evt_0001-hx-0", 2, "tool_call", "read", '{"p":"x"}'
        ),
        (
            "evt_0001-hx-1", 3, "tool_result", None, None
        ), ("evt_0001-hx-2", 4, "tool_call", None, "{}"), ("evt_0002", 2, "user_message", None, None),
    ]


def test_parse_turns_skips_taken_ids(spark):
    t = episode(spark, {"type": "user_message", "id": "evt_0002", "text": "x"})
    t = t.with_(
        records=t.records.withColumn(
            "raw",
            F.lit(json.dumps({"conversation": [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]}))
        )
    )
    assert events(passes.parse_turns(t), "event_id") == [("evt_0002",), ("evt_0001",), ("evt_0003",)]
    assert len(events(passes.parse_turns(t, skip_if_parsed=True), "event_id")) == 1


def test_pairing_by_id_adjacency_and_name(spark):
    t = episode(
        spark, {"type": "tool_call", "cid": "a", "tool": "x"}, {"type": "tool_result", "rcid": "a", "out": "1"},
        {"type": "tool_result", "rcid": "a", "out": "2"}, {"type": "tool_call", "tool": "y"}, {"type": "user_message"},
        {"type": "tool_result"}, {"type": "tool_call", "tool": "z"}, {"type": "tool_call", "tool": "w"},
        {"type": "tool_result", "rcid": "zz", "rtool": "z"}
    )
    p = passes.pair_tool_results(t)
    got = {r["event_id"]: r for r in p.events.collect()}
    assert got["e0"]["children"] == ["e2"] and got["e2"]["parents"] == ["e0"] and got["e1"]["parents"] == []
    assert got["e3"]["children"] == ["e5"] and got["e3"]["action"]["tool_call_id"] == "synth_e3" and got["e3"]["provenance"]["confidence"] == 0.7
    assert got["e5"]["observation"]["metadata"]["tool_call_id"] == "synth_e3"
    assert got["e6"]["children"] == ["e8"] and got["e6"]["action"]["tool_call_id"] is None
    assert codes(p) == [("PAIR001", "e7"), ("PAIR002", "e1")]


def test_pairing_by_use_id(spark):
    t = episode(
        spark, {"type": "tool_call", "tool": "x", "use": "u"}, {"type": "tool_call", "tool": "x"},
        {"type": "tool_call"}, {"type": "tool_result", "rcid": "q", "use": "u"}
    )
    assert {r["event_id"]: r["children"] for r in passes.pair_tool_results(t).events.collect()}["e0"] == ["e3"]


def test_pairing_tells_events_of_equal_ids_apart(spark):
    """Each call is a parent of its own; a result takes over its own call's id, not that of a namesake's call."""
    t = episode(
        spark, {"type": "tool_call", "id": "a", "cid": "x"}, {"type": "tool_call", "id": "a", "cid": "x"},
        {"type": "tool_result", "id": "b", "rcid": "x"}, {"type": "tool_call", "id": "c"},
        {"type": "tool_result", "id": "d"}, {"type": "tool_result", "id": "d", "rcid": "y"},
        {"type": "tool_call", "id": "e", "cid": "y"}, {"type": "tool_call", "id": "f", "cid": "z"},
        {"type": "tool_result", "id": None, "rcid": "z"}
    )
    once = passes.pair_tool_results(t)
    said = passes.result_call_id().alias("said")
    found = events(once.with_(events=once.events.where("event_type = 'tool_result'")), "parents", said)
    assert found == [(["a", "a"], "x"), (["c"], "synth_c"), (["e"], "y"), (["f"], "z")]
    assert codes(once) == []
    again = passes.pair_tool_results(once)
    assert events(again, "parents") == events(once, "parents")


@pytest.mark.parametrize(
    "name,kind,effect",
    [
        ("bash", "terminal", "workspace_write"), (" Read ", "file_read", "read_only"),
        ("browser_x", "browser", "network"), ("odd", "generic_tool", "unknown")
    ]
)
def test_classification(spark, name, kind, effect):
    t = passes.canonicalize_tools(episode(spark, {"type": "tool_call", "tool": name}))
    assert events(
        t, "action.kind", "action.side_effect_level", "action.tool_name"
    ) == [(kind, effect, name.strip().lower())]
    assert t.records.first()["level"] == "canonical"


def test_outcome(spark):
    raw = [
        {"reward": 1, "test_result": {"passed": False}}, {"trial": {"resolved": True, "command": "c"}},
        {"reward": "abc", "has_empty_response": True}, {"reward": 2}, {}
    ]
    base = spark.createDataFrame(
        [(i, "r", json.dumps(x)) for i, x in enumerate(raw)], "rid bigint, record_id string, raw string"
    )
    t = passes.normalize_outcome(Trajectories(records_of(base), events_of(base.where("false")), no_diagnostics(base)))
    got = {r["rid"]: r["outcome"] for r in t.records.collect()}
    assert [got[i]["status"] for i in range(5)] == ["failure", "unknown", "unknown", "partial", "unknown"]
    assert got[1]["verifier"]["score"] == 1.0 and got[2]["failure_reason"] == "empty_response" and codes(t) == [
        ("OUTCOME001", None)
    ]


def test_redaction_and_unknown_policy(spark):
    t = episode(spark, {"type": "reasoning", "text": "secret"}, {"type": "user_message", "text": "u"})
    got = {
        p: events(
            passes.redact_reasoning(t, p), X.content_text(F.col("content")), "visibility.trainable", "visibility.policy"
        )[0] for p in ("preserve", "drop", "redact", "nonsense")
    }
    assert got == {
        "preserve": ("secret", True, "preserve"), "drop": ("", False, "drop"),
        "redact": ("[REDACTED_REASONING]", True, "redact"), "nonsense": ("", True, "metadata_only")
    }


def test_slice(spark):
    t = episode(
        spark, {"type": "tool_call", "children": ["e1"]},
        {"type": "tool_result", "parents": ["e0"], "trainable": False}, {"type": "tool_call", "children": ["gone"]},
        {"type": "tool_result", "parents": ["e2"]}, {"type": "user_message"}
    )
    s = passes.slice_training(t)
    assert events(s, "event_id", "idx") == [("e4", 0)] and s.records.first()["level"] == "training"
    assert codes(s) == [
        ("slice-training:dropped-orphan-call", "e0"), ("slice-training:dropped-orphan-call", "e2"),
        ("slice-training:dropped-orphan-result", "e3")
    ]
    assert [e for e, in events(passes.slice_training(t, keep_non_trainable=True), "event_id")] == ["e0", "e1", "e4"]


def test_verify_strict(spark):
    t = episode(
        spark, {"type": "tool_call", "cid": "a", "tool": "x"}, {"type": "tool_result", "cid": "b"},
        {"type": "assistant_message", "text": "  "}
    )
    assert ("VERIFY002", "e1") in codes(
        passes.verify(t, strict=True)
    ) and ("VERIFY004", "e2") in codes(passes.verify(t, strict=True)) and codes(passes.verify(t)) == []


def test_patches(spark):
    diff = "diff --git a/x b/x\nindex 1..2\n--- a/x\n+++ b/x\n@@ -1 +1 @@\n-a\n+b\ndiff --git a/y b/y\n--- a/y\n+++ b/y\n@@ -1 +1 @@\n-c\n+d\n"
    t = parsed(
        spark, "agenttrove",
        {"messages": [{"role": "assistant", "content": "see:\n" + diff + "done"}], "model_patch": "not a diff"}
    )
    p = passes.extract_patches(t)
    assert events(
        p.with_(events=p.events.where("event_type = 'file_patch'")), "event_id", "writes", "provenance.confidence"
    ) == [("evt_patch_0000", [], 0.5), ("evt_patch_0001", ["b/x"], 1.0), ("evt_patch_0002", ["b/y"], 1.0)]
    r = p.records.first()
    assert r["outcome"]["final_patch_artifact_id"] == "art_0002" and r["artifacts"][1]["content"].endswith("+b\n") and [
        c for c, _ in codes(p)
    ] == ["PARSE002"]


def messages(t, target, **options):
    return [
        tuple(r) for r in lowering.lower(t, target, lowering.Context(**options)).messages.orderBy("n").select(
            "role", "content", "call_name", "answers"
        ).collect()
    ]


def test_lowering_shapes(spark):
    t = episode(
        spark, {"type": "system_message", "text": "s"}, {"type": "user_message", "text": "a<b"},
        {"type": "reasoning", "text": "r"}, {"type": "tool_call", "cid": "c", "tool": "x"},
        {"type": "tool_result", "cid": "c", "out": "o1"}, {"type": "terminal_command", "out": "o2"},
        {"type": "finish", "text": "end"}, {"type": "error"}, {"type": "tool_message", "text": "lost"}
    )
    assert messages(t, "openai-tools") == [
        ("system", "s", None, None), ("user", "a<b", None, None), ("assistant", None, "x", None),
        ("tool", "o1", None, "c"), ("assistant", None, "terminal", None), ("tool", "o2", None, "call_e5"),
        ("assistant", "end", None, None)
    ]
    assert messages(t, "anthropic-tools")[0] == (
        "user", "s", None, None
    ) and messages(t, "anthropic-tools")[5][3] == "toolu_e5"
    assert messages(t, "hermes-xml", reasoning_policy="preserve")[1:4] == [
        ("human", "a&lt;b", None, None), ("gpt", "\nr\n</think>", None, None),
        ("gpt", '༄x({"command":"ls"})༄', None, None)
    ]
    assert [m[1] for m in messages(t, "hermes-xml")].count("o1") == 2
    assert messages(t, "sharegpt", tool_policy="inline")[2:5] == [
        ("gpt", '[Tool Call: x({"command":"ls"})]', None, None),
        ("gpt", '[Tool Call: terminal_command({"command":"ls"})]', None, None),
        ("human", "[Tool Result]: o2", None, None)
    ]
    status = {n: lowering.lower(t, n).rows.first()["status"] for n in lowering.TARGETS}
    assert status == {
        "sft": "lossy", "openai-tools": "lossy", "anthropic-tools": "lossy", "hermes-xml": "lossy",
        "openhands": "lossy", "sharegpt": "lossy", "process-supervision": "exact"
    }
    steps = lowering.lower(t, "process-supervision").messages.orderBy("pos").collect()
    assert [
        (s["step_id"], s["observation"]["stdout"] if s["observation"] else None) for s in steps
    ] == [("e3", "o1"), ("e5", None)]
    losses = {r["code"] for r in lowering.lower(t, "openai-tools").losses.collect()}
    assert losses == {"LOWER001", "LOWER003", "LOWER005"} and lowering.lower(
        episode(spark, {"type": "user_message", "text": "x"}), "sft"
    ).rows.first()["status"] == "lossy"
    with pytest.raises(KeyError):
        lowering.lower(t, "nothing")
    with pytest.raises(ValueError):
        passes.run_passes(t, ["nothing"])


def test_orphan_results_come_once(spark):
    t = episode(
        spark, {"type": "tool_result", "cid": "q", "out": "1"}, {"type": "tool_result", "cid": "q", "out": "2"},
        {"type": "tool_result", "out": "3"}
    )
    assert messages(t, "openai-tools") == [("tool", "1", None, "q")] and messages(t, "sft") == []


SPEC = """apiVersion: x/v0.1
kind: TrajectoryFormat
metadata: {name: demo}
source: {framework: f}
detect: {min_score: 0.7, rules: [{field_exists: $.a.b, score: 0.4}, {field_is_list: $.items, score: 0.3}, {text_contains: {field: $.items, values: [zz]}, score: 0.2}, {regex_match: x, score: 0.9}]}
vars:
  turns: $.items
  last: {path: "$.items[-1].text"}
task: {task_id: $.a.b, instruction: {first_of: [$.missing, {const: do}]}}
tool_registry: {from: $.tools, as: tool, item: {name: {path: tool.n}}}
outcome: {status: {const: success}, passed: "yes"}
episodes:
  - episode_id: {template: "ep-{context.row_index}"}
    events:
      - {foreach: {var: turns}, as: t, index_as: i, emit: {event_id: {template: "e{i:03d}"}, idx: {var: i}, event_type: {transform: role_to_event_type, input: t.role}, role: {transform: role_to_message_role, input: t.role}, content: {path: t.text}, action: {kind: terminal, tool_name: {var: last}}}}
      - {foreach: {const: one}, emit: {event_type: reasoning, role: user, content: [{type: text, text: x}, plain, {type: thinking, thinking: h}]}}
"""


def test_spec(spark):
    s = spec.load_spec(SPEC)
    assert spec.problems(s) == [] and spec.is_valid(SPEC)
    df = rows(
        spark,
        {
            "a": {"b": "T"}, "items": [{"role": "user", "text": "q"}, {"role": "gpt", "text": ["x", "y"]}],
            "tools": [{"n": "f"}, {}], "id": 7
        },
        {"items": "zz"}
    )
    t = spec.compile_spec(s).parse(df)
    assert events(
        t, "rid", "event_id", "idx", "event_type", "role", X.content_text(F.col("content")), "action.tool_name"
    )[:3] == [
        (0, "e000", 0, "user_message", "user", "q", '["x","y"]'),
        (0, "e001", 1, "unparsed_fragment", "unknown", "x\ny", '["x","y"]'),
        (0, "7-evt-0000", 0, "unparsed_fragment", "user", "x\nplain\nh", None)
    ]
    r = {x["rid"]: x for x in t.records.collect()}
    assert r[0]["record_id"] == "7" and r[0]["task"]["task_id"] == "T" and r[0]["task"]["instruction"] == "do" and r[0]["outcome"]["passed"] is True and [
        x["name"] for x in r[0]["tools"]
    ] == ["f", "tool_1"]
    assert r[1]["record_id"] == "dsl-row-1" and t.events.first()["episode_id"] == "ep-{context.row_index}"
    assert spec.compile_spec(s, resolve_context=True).parse(df).events.where("rid = 0").first()["episode_id"] == "ep-0"
    v = F.try_parse_json("raw")
    assert [
        tuple(x) for x in df.select(spec.detection(s, v), spec.verdict(s, v)).collect()
    ] == [(pytest.approx(0.7), "MATCH"), (pytest.approx(0.2), "LOW")]
    assert "items" in spec.probe(df)


def test_spec_problems(tmp_path):
    assert spec.problems(str(tmp_path / "none.yaml"))[0][0] == "IO001"
    bad = tmp_path / "bad.yaml"
    bad.write_text("a: [")
    assert spec.problems(bad)[0][0] == "PARSE003"
    assert {
        c for c,
        *_ in spec.problems({"apiVersion": "q", "kind": "x", "metadata": {}, "source": {}, "episodes": [], "x": 1})
    } == {"SCHEMA001", "SCHEMA002", "SCHEMA003"}
    good = tmp_path / "good.yaml"
    good.write_text(spec.new_spec("n"))
    assert spec.find_specs(str(tmp_path)) == [good] and spec.is_valid(good)
    assert spec.problems(
        {**spec.load_spec(SPEC), "episodes": [{"events": [{"emit": {"visibility": 1}}]}]}
    )[0][2].endswith("visibility")


def test_files(spark, tmp_path):
    lines = tmp_path / "x.jsonl"
    lines.write_text('{"a": 1}\n\n  {bad\n{"a": 2}\n')
    assert [
        r["raw"] for r in files.read_jsonl(spark, str(lines)).collect()
    ] == ['{"a": 1}', "{bad", '{"a": 2}'] and files.read_jsonl(spark, str(lines), limit=1).count() == 1
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(lines), strict=True).collect()
    for text, n in (('[{"a": 1}, {"a": 2}, 3]', 2), ('{"a": 1}', 1), ('{"a": 1}\nnope\n{"a": 2}', 2)):
        (tmp_path / "y.json").write_text(text)
        assert files.read_rows(spark, str(tmp_path / "y.json")).count() == n
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    files.write_rows(df, str(tmp_path / "out"), keep_nulls=True)
    files.write_rows(df, str(tmp_path / "out"), append=True)
    assert sorted(
        r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()
    ) == ['{"a":1,"b":null}', '{"a":1}', '{"a":2,"b":"b"}', '{"a":2,"b":"b"}']
    files.write_rows(df, str(tmp_path / "t.parquet"))
    assert files.read_rows(spark, str(tmp_path / "t.parquet")).count() == 2
    numbered = files.numbered(spark.range(100), ["id"])
    assert [
        tuple(r) for r in files.batches(numbered, 30).orderBy("batch_index").collect()
    ] == [(0, 0, 30, 30), (1, 30, 60, 30), (2, 60, 90, 30), (3, 90, 100, 10)]


def test_compile_and_reports(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    source.write_text(
        "\n".join(
            json.dumps(x) if isinstance(x, dict) else x for x in (
                CHAT, {"messages": [{"role": "assistant", "content": "a"}]}, "{bad"
            )
        )
    )
    counts = pipeline.compile_files(
        spark, str(source), str(tmp_path / "out"), "agenttrove", "minimal", "openai-tools",
        report=str(tmp_path / "report")
    ).collect()
    assert {r["status"]: r["n_records"] for r in counts} == {"partial": 1, "exact": 1}
    assert spark.read.text(str(tmp_path / "out")).count() == 2 and spark.read.text(
        str(tmp_path / "report/quarantine")
    ).count() == 1
    t = parsed(spark, "agenttrove", CHAT)
    assert pipeline.verification(t)[0] == 0 and pipeline.statistics(t).first()["n_events"] == 4
    bad = passes.verify(episode(spark, {"type": "user_message", "id": "a"}, {"type": "user_message", "id": "a"}))
    assert pipeline.verification(bad)[0] == 1 and pipeline.verification(bad, strict=True)[0] == 4
    assert "VERIFY001" in pipeline.diagnostic_lines(bad).first()["line"] and "VERIFY001" in pipeline.markdown(
        pipeline.diagnostic_counts(bad), "x"
    )
    assert pipeline.json_schema()["properties"]["events"]["items"]["properties"]["event_type"]["enum"] and pipeline.dialects(spark).count() == 8 and len(CODES) == 19
    assert pipeline.throughput(rows(spark, CHAT), "agenttrove")["records_per_s"] > 0
    with pytest.raises(KeyError):
        pipeline.compile_rows(rows(spark, CHAT), "nothing")


def test_full_pass_list(spark):
    t = passes.run_passes(parsed(spark, "agenttrove", CHAT), "full")
    assert t.records.first()["level"] == "training" and t.events.count() == 8


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text(json.dumps(CHAT) + "\n{bad\n")
    seen = []
    q = stream.run(
        stream.read_lines(spark, str(tmp_path / "in")), "agenttrove",
        lambda t, bad, n: seen.append((t.events.count(), bad.first()["stage"])), "minimal", str(tmp_path / "ckpt")
    )
    q.awaitTermination()
    assert seen == [(4, "stream")]


def test_user_extensions(spark):
    frontends.register_frontend(frontends.Frontend("mine", lambda v: F.lit(0.99), frontends.parse_rewarded))
    passes.register_pass("upper", lambda t: t.with_(events=t.events.withColumn("event_id", F.upper("event_id"))))
    try:
        t = passes.run_passes(parsed(spark, "mine", CHAT), ["upper"])
        assert events(t, "event_id")[0] == ("EVT_0000",) and frontends.best_frontend(
            rows(spark, {"x": 1})
        ).first()["frontend"] == "mine"
    finally:
        del frontends.FRONTENDS["mine"], passes.PASSES["upper"]


def test_command_line(spark, tmp_path, capsys):
    from weftline.__main__ import main

    source, form = tmp_path / "in.jsonl", tmp_path / "f.yaml"
    source.write_text(json.dumps(CHAT) + "\n{bad\n")
    form.write_text(spec.new_spec("mine"))
    run = lambda *a: main([str(x) for x in a])
    assert run("version") == 0 and run("schema") == 0 and run(
        "format", "validate", form
    ) == 0 and run("format", "init", "n") == 0 and run("format", "list", tmp_path) == 0
    assert run("detect", source) == 0
    assert run("parse", source, tmp_path / "t", "--quarantine", tmp_path / "q") == 0
    assert run("opt", tmp_path / "t", tmp_path / "o", "--passes", "canonicalize-tools,verify") == 0
    assert run(
        "lower", tmp_path / "o", tmp_path / "out.parquet", "--target", "sharegpt", "--report", tmp_path / "losses"
    ) == 0
    assert run("verify", tmp_path / "o") == 0 and run("stats", tmp_path / "o") == 0
    assert run("compile", source, tmp_path / "c", "--passes", "minimal") == 0
    assert run("format", "probe", source) == 0 and run("format", "preview", form, source) == 0 and run(
        "format", "convert", form, source, tmp_path / "fc"
    ) == 0
    assert run("format", "diff", form, form, source) == 0 and run("format", "bench", form, source) == 0
    assert spark.read.parquet(str(tmp_path / "out.parquet")).count() == 1 and spark.read.text(str(tmp_path / "q")).count() == 1
    assert "| sharegpt" not in capsys.readouterr().out
    del frontends.FRONTENDS["mine"]


def test_numbers_are_dense(spark, tmp_path):
    """Row numbers from 0 without gaps over any partitions, in order where one is given."""
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    ordered = {r["rid"]: r["v"] for r in files.numbered(df, ["v"]).collect()}
    assert ordered == {i: i for i in range(1000)}
    (tmp_path / "a.jsonl").write_text("".join(f'{{"v":{i}}}\n' for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        rows = files.read_jsonl(spark, str(tmp_path / "a.jsonl"))
        assert {r["rid"]: r["raw"] for r in rows.collect()} == {i: f'{{"v":{i}}}' for i in range(3000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert files.numbered(df.limit(0)).count() == 0


def test_stream_keeps_equal_lines_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = json.dumps(
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "reward": 1}
    )
    (tmp_path / "in" / "a.jsonl").write_text(f"{line}\n{line}\n")
    seen = []

    def sink(t, bad, n):
        rows = lowering.lower(t, "openai-tools").rows.collect()
        seen.append((sorted(r["n_messages"] for r in rows), t.diagnostics.where("code = 'VERIFY001'").count()))

    stream.run(
        stream.read_lines(spark, str(tmp_path / "in")), "agenttrove", sink, "minimal", str(tmp_path / "c")
    ).awaitTermination()
    assert seen == [([2, 2], 0)]


def test_formats_and_templates_are_valid():
    shipped = sorted(spec.FORMATS.glob("*.yaml"))
    assert len(shipped) == 5 and all(
        spec.is_valid(p) for p in shipped
    ) and spec.find_specs(str(spec.FORMATS)) == shipped
    assert all(spec.is_valid(spec.load_spec(spec.new_spec("mine", name))) for name in ("chat", "calls"))
    with pytest.raises(ValueError):
        spec.new_spec("mine", "none")


def test_dialects_can_be_registered(spark):
    pipeline.register_dialect("notes", ("memory_read", "memory_write"))
    try:
        assert pipeline.dialects(spark).where("name = 'notes'").first()["event_types"] == [
            "memory_read", "memory_write"
        ]
    finally:
        del pipeline.DIALECTS["notes"]
    with pytest.raises(ValueError):
        pipeline.register_dialect("notes", ("no_such_type",))


def test_measured_passes(spark):
    t, metrics = pipeline.measured_passes(frontends.convert(rows(spark, CHAT), "agenttrove")[0], "minimal")
    found = metrics.orderBy("nth").collect()
    assert [r["pass"] for r in found] == ["normalize-outcome", "verify"] and all(r["elapsed_ms"] > 0 for r in found)
    assert found[-1]["n_events"] == t.events.count()


def test_slices_use_one_exchange(spark):
    """Slicing and lowering deal events by record once."""
    t = frontends.convert(rows(spark, CHAT), "agenttrove")[0]
    for df in (passes.slice_training(t).events, lowering.lower(t, "openai-tools").messages):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(rid") <= 2


def test_schema_goes_all_the_way_down():
    schema = pipeline.json_schema()["properties"]
    verifier = schema["outcome"]["properties"]["verifier"]["properties"]
    assert verifier["passed"]["type"] == ["boolean", "null"] and verifier["score"]["type"] == ["number", "null"]
    event = schema["events"]["items"]["properties"]
    assert event["content"]["items"]["properties"]["text"]["type"] == ["string", "null"]
    assert event["metadata"]["additionalProperties"]["type"] == ["string", "null"]


def test_writers_count(spark, tmp_path):
    df = spark.range(10)
    assert files.write_rows(df, str(tmp_path / "a.jsonl")) == 10
    assert files.write_rows(df, str(tmp_path / "a.parquet"), row_group_bytes=1 << 20) == 10
    assert files.write_rows(df.limit(0), str(tmp_path / "b.parquet")) == 0
    assert spark.read.parquet(str(tmp_path / "b.parquet")).count() == 0
