"""The query catalogue: one query for each operator, with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import Trajectories
from weftline.operators import lowering, passes
from weftline.plans import pipeline
from weftline.plans.catalogue import ORACLE_SQL, QUERIES, TURNS, query, table  # noqa: F401
from weftline.plans.derived import D, conversation_rows, order_rows, rows_of, trajectories
from weftline.sources import files, frontends, spec

CALL = """<tool_call>{"name":"bash","arguments":{"k":1}}</tool_call>"""
DIFF = """diff --git a/f b/f
--- a/f
+++ b/f
@@ -1 +1 @@
-x
+y
"""


def _parsed(spark: SparkSession, sf_dir: str, suffix: str = "''") -> Trajectories:
    return frontends.convert(conversation_rows(spark, sf_dir, suffix), "agenttrove")[0]


# -- frontends ---------------------------------------------------------------------------


@query(f"WITH {TURNS} SELECT rid, CAST(pos AS BIGINT) AS n, role, text AS content FROM c WHERE text <> ''")
def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to chat-tool messages: parse, classify, verify, lower."""
    t = passes.run_passes(
        _parsed(spark, sf_dir), ("canonicalize-tools", "pair-tool-results", "normalize-outcome", "verify"), settle=False
    )
    return lowering.lower(t, "openai-tools").messages.select("rid", "n", "role", "content")


@query(
    f"""WITH {TURNS} SELECT rid, CAST(pos AS BIGINT) AS pos, printf('evt_%04d', pos) AS event_id, role || '_message' AS event_type, role, text FROM c"""
)
def q_turn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).events.select(
        "rid", "pos", "event_id", "event_type", "role", X.content_text(F.col("content")).alias("text")
    )


def _scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = ", 'reward', CASE WHEN rid % 2 = 0 THEN 1.5D END, 'gitdiff', CASE WHEN rid % 3 = 0 THEN 'x' END, 'repo', 'r'"
    return conversation_rows(spark, sf_dir, extra=extra)


_SCORES = """s AS (SELECT DISTINCT conv_id AS rid, CASE WHEN conv_id % 2 = 0 THEN 0.733 ELSE 0.1 END AS agenttrove, 0.0 AS codex, CASE WHEN conv_id % 3 = 0 THEN 0.2 ELSE 0.0 END AS coding, 0.25 AS openhands, 0.0 AS hermes FROM conversations),
u AS (SELECT rid, 0 AS k, 'agenttrove' AS frontend, CAST(agenttrove AS DOUBLE) AS score FROM s UNION ALL SELECT rid, 1, 'codex-swebenchpro', CAST(codex AS DOUBLE) FROM s UNION ALL SELECT rid, 2, 'claude-code', CAST(coding AS DOUBLE) FROM s UNION ALL SELECT rid, 3, 'openhands', CAST(openhands AS DOUBLE) FROM s UNION ALL SELECT rid, 4, 'hermes-agent', CAST(hermes AS DOUBLE) FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, k) AS rank FROM u)"""


@query(f"WITH {_SCORES} SELECT rid, frontend, score, CAST(rank AS BIGINT) AS rank FROM r")
def q_detect_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontends.detection_scores(_scored_rows(spark, sf_dir)).withColumn("rank", F.col("rank").cast("bigint"))


@query(f"WITH {_SCORES} SELECT rid, frontend, score FROM r WHERE rank = 1")
def q_detect_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontends.best_frontend(_scored_rows(spark, sf_dir))


@query("""WITH l AS (SELECT l_orderkey AS rid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INT)) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber AS ln, l_partkey AS p, CAST(l_quantity AS INT) AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
e AS (SELECT o_orderkey AS rid, 0 AS pos, 'user_message' AS event_type, o_orderpriority AS text, NULL AS call_id, NULL AS arguments FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT rid, i, 'tool_call', '', 'l' || ln, '{"p":' || p || '}' FROM l UNION ALL SELECT rid, n + i, 'tool_result', 'q' || q, 'l' || ln, '{}' FROM l)
SELECT rid, CAST(pos AS BIGINT) AS pos, event_type, text, call_id, arguments FROM e""")
def q_native_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = frontends.convert(order_rows(spark, sf_dir), "openhands")[0]
    return t.events.select(
        "rid", "pos", "event_type", X.content_text(F.col("content")).alias("text"),
        F.col("action.tool_call_id").alias("call_id"), F.col("action.arguments").alias("arguments")
    )


@query("""WITH l AS (SELECT l_orderkey AS rid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INT)) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber AS ln FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT a.rid, CAST(a.n + a.i AS BIGINT) AS pos, 'o' || a.rid || '-evt-' || max(b.i) AS parent FROM l a JOIN l b ON a.rid = b.rid AND a.ln = b.ln GROUP BY a.rid, a.n, a.i""")
def q_native_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = frontends.convert(order_rows(spark, sf_dir), "openhands")[0]
    return passes.latest_calls(t.events).where(F.size("parents") > 0).select(
        "rid", "pos", F.col("parents")[0].alias("parent")
    )


@query(
    """SELECT doc_id AS rid, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes FROM documents WHERE text <> ''"""
)
def q_log_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("rid"), F.to_json(F.struct(F.col("text").alias("gitdiff"))).alias("raw")
    )
    return frontends.convert(rows, "claude-code")[0].records.select(
        "rid", F.explode("artifacts").alias("a")
    ).select("rid", "a.sha256", "a.size_bytes")


@query(
    """WITH e AS (SELECT event_id AS rid, event_type FROM events) SELECT CAST(rid AS BIGINT) AS row_index, CASE WHEN rid % 3 = 0 THEN 'malformed JSON' ELSE 'not an object' END AS error, 'batch' AS stage FROM e WHERE rid % 3 = 0 OR rid % 5 = 0"""
)
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).select("row_index", "error", "stage")


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, "{bad").when(F.col("event_id") % 5 == 0, "[1]").otherwise(
        F.to_json(
            F.struct(
                F.array(F.struct(F.lit("user").alias("role"), F.col("event_type").alias("content"))).alias("messages")
            )
        )
    )
    return frontends.convert(
        table(spark, sf_dir, "events").select(F.col("event_id").alias("rid"), raw.alias("raw")), "agenttrove"
    )[1]


@query("SELECT 'batch' AS stage, count(*) AS n FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 0")
def q_quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.quarantine_summary(_quarantine(spark, sf_dir))


# -- passes: parsing -------------------------------------------------------------------------


@query(
    f"""WITH {TURNS}, n AS (SELECT rid, count(*) AS n FROM c GROUP BY rid) SELECT c.rid, CAST(pos + n * k AS BIGINT) AS pos, printf('evt_%04d', CAST(pos + n * k AS BIGINT)) AS event_id, role || '_message' AS event_type, text FROM c JOIN n ON c.rid = n.rid CROSS JOIN (SELECT unnest([0, 1]) AS k)"""
)
def q_parse_sharegpt_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.parse_turns(_parsed(spark, sf_dir))
    return t.events.select("rid", "pos", "event_id", "event_type", X.content_text(F.col("content")).alias("text"))


@query(f"""WITH {TURNS}, k AS (SELECT *, CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM c),
m AS (SELECT *, before + max(pos - before) OVER (PARTITION BY rid ORDER BY pos) AS base FROM k)
SELECT rid, CAST(pos + before + 1 AS BIGINT) AS pos, printf('evt_%04d', pos) || '-hx-0' AS event_id, CAST(base + 1 AS BIGINT) AS idx, 'bash' AS tool_name, '{{"k":1}}' AS arguments FROM m WHERE role = 'assistant'""")
def q_xml_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.parse_xml_calls(_parsed(spark, sf_dir, f"'{CALL}'"))
    return t.events.where("event_type = 'tool_call'").select(
        "rid", "pos", "event_id", "idx", "action.tool_name", "action.arguments"
    )


@query("SELECT doc_id AS rid, 'b/f' AS file, 1 AS n_blocks FROM documents WHERE text IS NOT NULL")
def q_patch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    diffs = passes.diff_blocks(
        F.concat(F.regexp_replace("text", r"(?m)^(diff --git|--- a/|[+\\ @-])", "_$1"), F.lit("\n" + DIFF + "after"))
    )
    return table(spark, sf_dir, "documents").where("text is not null").select(
        F.col("doc_id").alias("rid"), diffs.alias("d")
    ).select(
        "rid", F.array_join(passes.written_files(F.array_join("d", "")), ",").alias("file"),
        F.size("d").alias("n_blocks")
    )


@query(f"""WITH {TURNS}, a AS (SELECT rid, pos, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS k, max(pos) OVER (PARTITION BY rid) AS last FROM c), s AS (SELECT a.* FROM a JOIN c ON a.rid = c.rid AND a.pos = c.pos WHERE c.role = 'assistant'), n AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS i FROM s),
all_last AS (SELECT rid, max(pos) AS last FROM c GROUP BY rid)
SELECT n.rid, printf('evt_patch_%04d', i) AS event_id, CAST(l.last + 1 + i AS BIGINT) AS idx, printf('art_%04d', i) AS artifact_id, printf('evt_%04d', n.pos) AS parent, 'b/f' AS file FROM n JOIN all_last l ON n.rid = l.rid""")
def q_extract_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.extract_patches(_parsed(spark, sf_dir, "'\n" + DIFF + "'"))
    return t.events.where("event_type = 'file_patch'").select(
        "rid", "event_id", "idx", F.col("patch_artifact_id").alias("artifact_id"),
        F.get("parents", F.lit(0)).alias("parent"), F.get("writes", F.lit(0)).alias("file")
    )


# -- passes: tools -----------------------------------------------------------------------------


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())


_KINDS = {n: f"{kind}:{effect}" for (kind, effect), names in passes.TOOLS.items() for n in names}


@query(f"""WITH {D}, k(name, what) AS (VALUES {_values(_KINDS)}), n AS (SELECT *, lower(trim(tool)) AS name0 FROM d WHERE event_type = 'tool_call')
SELECT rid, pos, CASE WHEN tool = '' THEN 'generic_tool' ELSE coalesce(split_part(what, ':', 1), CASE WHEN name0 LIKE 'browser\\_%' ESCAPE '\\' THEN 'browser' ELSE 'generic_tool' END) END AS kind,
CASE WHEN tool = '' THEN 'unknown' ELSE coalesce(split_part(what, ':', 2), CASE WHEN name0 LIKE 'browser\\_%' ESCAPE '\\' THEN 'network' ELSE 'unknown' END) END AS effect, name0 AS tool_name, CASE WHEN tool <> '' THEN tool END AS raw_name FROM n LEFT JOIN k ON n.name0 = k.name""")
def q_canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.canonicalize_tools(trajectories(spark, sf_dir))
    a = F.col("action")
    return t.events.where("event_type = 'tool_call'").select(
        "rid", "pos", a["kind"].alias("kind"), a["side_effect_level"].alias("effect"),
        a["tool_name"].alias("tool_name"), a["metadata"]["tool.name.raw"].alias("raw_name")
    )


@query(
    f"""WITH {D} SELECT rid, CASE WHEN max(CASE WHEN event_type = 'tool_call' AND tool <> '' THEN 1 ELSE 0 END) = 1 THEN 'canonical' ELSE 'parsed' END AS level FROM d GROUP BY rid"""
)
def q_canonical_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.canonicalize_tools(trajectories(spark, sf_dir)).records.select("rid", "level")


@query(
    f"""WITH {D} SELECT rid, pos, CASE tool WHEN 'bash' THEN 'generic_tool' ELSE 'generic_tool' END AS kind, 'workspace_write' AS effect FROM d WHERE event_type = 'tool_call'"""
)
def q_nativetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).where("event_type = 'tool_call'").select(
        "rid", "pos", passes.native_kind(F.col("tool")).alias("kind"),
        passes.native_effect(F.col("tool")).alias("effect")
    )


PAIRS = f"""{D}, lastr AS (SELECT rid, cid, max(pos) AS rpos FROM d WHERE event_type = 'tool_result' AND cid IS NOT NULL GROUP BY rid, cid),
p1 AS (SELECT c.rid, c.pos, l.rpos FROM d c JOIN lastr l ON c.rid = l.rid AND c.cid = l.cid WHERE c.event_type = 'tool_call'),
g AS (SELECT *, sum(CASE WHEN event_type = 'tool_call' THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY pos) AS seg FROM d),
h AS (SELECT g.rid, g.seg, g.pos FROM g LEFT JOIN p1 ON g.rid = p1.rid AND g.pos = p1.pos WHERE event_type = 'tool_call' AND p1.pos IS NULL),
f AS (SELECT rid, seg, min(pos) AS rpos FROM g WHERE event_type = 'tool_result' AND cid IS NULL GROUP BY rid, seg),
p2 AS (SELECT h.rid, h.pos, f.rpos FROM h JOIN f ON h.rid = f.rid AND h.seg = f.seg),
p AS (SELECT rid, pos, rpos, 1 AS phase FROM p1 UNION ALL SELECT rid, pos, rpos, 2 FROM p2)"""


@query(f"WITH {PAIRS} SELECT p.rid, p.pos, d.id AS partner, p.phase FROM p JOIN d ON p.rid = d.rid AND p.rpos = d.pos")
def q_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.paired(trajectories(spark, sf_dir).events).where(
        "event_type = 'tool_call' and phase is not null"
    ).select("rid", "pos", "partner", "phase")


PAIRS3 = PAIRS + """, lc AS (SELECT d.rid, d.pos, d.tool, row_number() OVER (PARTITION BY d.rid, d.tool ORDER BY d.pos) AS k FROM d LEFT JOIN p ON d.rid = p.rid AND d.pos = p.pos WHERE d.event_type = 'tool_call' AND d.tool <> '' AND p.pos IS NULL),
lr AS (SELECT d.rid, d.pos, d.tool, row_number() OVER (PARTITION BY d.rid, d.tool ORDER BY d.pos) AS k FROM d LEFT JOIN (SELECT DISTINCT rid, rpos FROM p) q ON d.rid = q.rid AND d.pos = q.rpos WHERE d.event_type = 'tool_result' AND d.tool <> '' AND q.rpos IS NULL)"""


@query(
    f"WITH {PAIRS3} SELECT lc.rid, lc.pos, d.id AS partner FROM lc JOIN lr ON lc.rid = lr.rid AND lc.tool = lr.tool AND lc.k = lr.k JOIN d ON d.rid = lr.rid AND d.pos = lr.pos"
)
def q_pair_framework(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.paired(
        trajectories(spark, sf_dir, named_results=True).events
    ).where("event_type = 'tool_call' and phase = 3").select("rid", "pos", "partner")


@query(f"""WITH {PAIRS} SELECT 'PAIR001' AS code, 'warning' AS severity, d.rid, d.id AS event_id FROM d LEFT JOIN p ON d.rid = p.rid AND d.pos = p.pos WHERE d.event_type = 'tool_call' AND p.pos IS NULL
UNION ALL SELECT 'PAIR002', 'warning', d.rid, d.id FROM d LEFT JOIN (SELECT DISTINCT rid, rpos FROM p) q ON d.rid = q.rid AND d.pos = q.rpos WHERE d.event_type = 'tool_result' AND q.rpos IS NULL""")
def q_pair_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.pair_tool_results(trajectories(spark, sf_dir)).diagnostics.select(
        "code", "severity", "rid", "event_id"
    )


@query(
    f"""WITH {PAIRS} SELECT d.rid, d.pos, coalesce(d.cid, CASE WHEN p.phase = 2 THEN 'synth_' || d.id END) AS call_id, CASE WHEN p.phase = 2 AND d.cid IS NULL THEN 0.7 WHEN d.eid % 3 <> 1 THEN 0.9 END AS confidence, r.id AS child FROM d LEFT JOIN p ON d.rid = p.rid AND d.pos = p.pos LEFT JOIN d r ON r.rid = p.rid AND r.pos = p.rpos WHERE d.event_type = 'tool_call'"""
)
def q_pair_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.pair_tool_results(trajectories(spark, sf_dir))
    return t.events.where("event_type = 'tool_call'").select(
        "rid", "pos", F.col("action.tool_call_id").alias("call_id"), F.col("provenance.confidence").alias("confidence"),
        F.get("children", F.lit(0)).alias("child")
    )


@query(
    f"""WITH {PAIRS} SELECT r.rid, r.pos, string_agg(c.id, ',' ORDER BY c.pos) AS parents, max(coalesce(r.cid, c.cid, 'synth_' || c.id)) AS answers FROM p JOIN d r ON r.rid = p.rid AND r.pos = p.rpos JOIN d c ON c.rid = p.rid AND c.pos = p.pos GROUP BY r.rid, r.pos"""
)
def q_pair_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = passes.pair_tool_results(trajectories(spark, sf_dir))
    return t.events.where("event_type = 'tool_result' and size(parents) > 0").select(
        "rid", "pos", F.array_join("parents", ",").alias("parents"), passes.result_call_id().alias("answers")
    )


# -- passes: outcome, redaction, slices, checks ------------------------------------------------


OUT = "r AS (SELECT DISTINCT user_id AS rid, CASE user_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN -1.0 END AS reward, CASE user_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS passed FROM events)"


@query(
    f"WITH {OUT} SELECT rid, CAST(reward AS DOUBLE) AS reward, passed, CASE WHEN passed THEN 'success' WHEN NOT passed THEN 'failure' WHEN reward IS NOT NULL THEN 'partial' ELSE 'unknown' END AS status FROM r"
)
def q_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.normalize_outcome(trajectories(spark, sf_dir)).records.select(
        "rid", "outcome.reward", "outcome.passed", "outcome.status"
    )


@query(
    f"WITH {OUT} SELECT rid, 'OUTCOME001' AS code FROM r WHERE (reward > 0 AND NOT passed) OR (reward <= 0 AND passed)"
)
def q_outcome_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.normalize_outcome(trajectories(spark, sf_dir)).diagnostics.select("rid", "code")


def _redaction(policy: str) -> None:
    text = {
        "preserve": "'t' || CAST(eid AS STRING)", "summarize": "'[REASONING_SUMMARY_NOT_IMPLEMENTED]'",
        "redact": "'[REDACTED_REASONING]'"
    }.get(policy, "''")
    status = {"redact": "redacted", "metadata_only": "metadata_only"}.get(policy, "none")
    trainable = "false" if policy == "drop" else "trainable"

    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = passes.redact_reasoning(trajectories(spark, sf_dir), policy)
        v = F.col("visibility")
        return t.events.where("event_type = 'reasoning'").select(
            "rid", "pos", X.content_text(F.col("content")).alias("text"), v["trainable"].alias("trainable"),
            v["redaction_status"].alias("redaction"), v["policy"].alias("policy")
        )

    f.__name__ = f"q_redact_{policy}"
    query(
        f"WITH {D} SELECT rid, pos, {text} AS text, {trainable} AS trainable, '{status}' AS redaction, '{policy}' AS policy FROM d WHERE event_type = 'reasoning'"
    )(f)


for _policy in ("preserve", "summarize", "drop", "redact", "metadata_only"):
    _redaction(_policy)

SLICE = f"""{D}, ids AS (SELECT rid, id, max_by(trainable, pos) AS alive FROM d GROUP BY rid, id),
k1 AS (SELECT d.*, d.trainable AND (d.child IS NULL OR coalesce(i.alive, false)) AS keep1 FROM d LEFT JOIN ids i ON d.rid = i.rid AND d.child = i.id),
ids2 AS (SELECT rid, id, max_by(keep1, pos) AS alive FROM k1 GROUP BY rid, id),
k2 AS (SELECT k1.*, keep1 AND (event_type <> 'tool_result' OR parent IS NULL OR coalesce(j.alive, false)) AS keep FROM k1 LEFT JOIN ids2 j ON k1.rid = j.rid AND k1.parent = j.id)"""


@query(
    f"WITH {SLICE} SELECT rid, id AS event_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS BIGINT) AS idx FROM k2 WHERE keep"
)
def q_slice_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.slice_training(trajectories(spark, sf_dir, links=True)).events.select("rid", "event_id", "idx")


@query(
    f"WITH {SLICE} SELECT rid, count(*) AS events_before, CAST(sum(CASE WHEN keep THEN 1 ELSE 0 END) AS BIGINT) AS events_after, CAST(sum(CASE WHEN keep THEN 0 ELSE 1 END) AS BIGINT) AS events_dropped FROM k2 GROUP BY rid"
)
def q_slice_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trajectories(spark, sf_dir, links=True)
    return passes.slice_metrics(t, passes.slice_training(t))


@query(
    f"""WITH {SLICE} SELECT rid, id AS event_id, CASE WHEN event_type = 'tool_call' THEN 'slice-training:dropped-orphan-call' ELSE 'slice-training:dropped-orphan-result' END AS code FROM k2 WHERE trainable AND NOT keep"""
)
def q_slice_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.slice_training(trajectories(spark, sf_dir, links=True)).diagnostics.select("rid", "event_id", "code")


CHECKS = {
    "event_id": f"WITH {D}, n AS (SELECT *, row_number() OVER (PARTITION BY rid, id ORDER BY pos) AS k FROM d) SELECT rid, id AS event_id, 'VERIFY001' AS code FROM n WHERE k > 1",
    "idx": f"WITH {D}, n AS (SELECT *, lag(idx) OVER (PARTITION BY rid ORDER BY pos) AS b FROM d) SELECT rid, id AS event_id, 'VERIFY001' AS code FROM n WHERE idx <= b",
    "parent_event_ids": f"WITH {D} SELECT rid, id AS event_id, 'VERIFY002' AS code FROM d WHERE parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d e WHERE e.rid = d.rid AND e.id = d.parent)",
    "tool_name": f"WITH {D} SELECT rid, id AS event_id, 'VERIFY002' AS code FROM d WHERE event_type = 'tool_call' AND tool = ''",
    "artifacts": f"WITH {D} SELECT rid, id AS event_id, 'VERIFY003' AS code FROM d WHERE artifact = 'art_x'",
    "visibility": f"WITH {D} SELECT rid, id AS event_id, 'VERIFY004' AS code FROM d WHERE event_type = 'reasoning' AND policy IS NULL",
    "tool_call_id": f"WITH {D} SELECT rid, id AS event_id, 'VERIFY002' AS code FROM d WHERE event_type = 'tool_result' AND cid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d e WHERE e.rid = d.rid AND e.event_type = 'tool_call' AND e.cid = d.cid)",
}


def _check(field: str, sql: str) -> None:
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = passes.verify(trajectories(spark, sf_dir, links=True), strict=field == "tool_call_id")
        return t.diagnostics.where(F.col("field") == field).select("rid", "event_id", "code")

    f.__name__ = f"q_verify_{field}"
    query(sql)(f)


for _field, _sql in CHECKS.items():
    _check(_field, _sql)

# -- lowering ----------------------------------------------------------------------------------


def _chat(prefix: str, reasoning: bool = False, results: bool = True, name: str = "d.tool") -> str:
    """Messages of ``D`` in a chat format."""
    key = f"CASE WHEN event_type = 'tool_call' THEN coalesce(cid, '{prefix}' || id) WHEN event_type = 'tool_result' THEN cid END"
    return f"""{D}, k AS (SELECT *, {key} AS key FROM d), e AS (SELECT *, count(*) OVER (PARTITION BY rid, key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM k),
a AS (SELECT rid, cid, max_by(eid, pos) AS last FROM d WHERE event_type = 'tool_result' AND cid IS NOT NULL GROUP BY rid, cid),
m AS (SELECT rid, pos, 0 AS k, CASE WHEN event_type = 'user_message' THEN 'user' ELSE 'assistant' END AS role, 't' || CAST(eid AS STRING) AS content, NULL AS call_id, NULL AS call_name, NULL AS call_arguments, NULL AS answers FROM d WHERE event_type IN ('user_message', 'assistant_message'{", 'reasoning'" if reasoning else ""})
UNION ALL SELECT rid, pos, 0, 'assistant', NULL, key, {name.replace("d.", "e.")}, '{{"n":' || CAST(eid AS STRING) || '}}', NULL FROM e WHERE event_type = 'tool_call'
UNION ALL SELECT e.rid, e.pos, 1, 'tool', 'out' || CAST(a.last AS STRING), NULL, NULL, NULL, e.key FROM e JOIN a ON e.rid = a.rid AND e.key = a.cid WHERE e.event_type = 'tool_call'
{"UNION ALL SELECT rid, pos, 0, 'tool', 'out' || CAST(eid AS STRING), NULL, NULL, NULL, key FROM e WHERE event_type = 'tool_result' AND key IS NOT NULL AND earlier = 0" if results else ""}),
o AS (SELECT rid, CAST(row_number() OVER (PARTITION BY rid ORDER BY pos, k) - 1 AS BIGINT) AS n, role, content, call_id, call_name, call_arguments, answers FROM m)"""


def _lowering(target: str, sql: str, suffix: str = "", **context) -> None:
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = lowering.lower(trajectories(spark, sf_dir), target, lowering.Context(**context)).messages
        return found.select("rid", "n", "role", "content", "call_id", "call_name", "call_arguments", "answers")

    f.__name__ = "q_lower_" + target.replace("-", "_") + suffix
    query(sql)(f)


_lowering("openai-tools", f"WITH {_chat('call_')} SELECT * FROM o")
_lowering("openhands", f"WITH {_chat('call_')} SELECT * FROM o")
_lowering("anthropic-tools", f"WITH {_chat('toolu_')} SELECT * FROM o")
_lowering(
    "anthropic-tools", f"WITH {_chat('toolu_', reasoning=True)} SELECT * FROM o", "_reasoning", include_reasoning=True
)
_lowering(
    "sft",
    f"WITH {_chat('call_', results=False, name='CASE WHEN d.tool = '+chr(39)*2+' THEN '+chr(39)+'unknown'+chr(39)+' ELSE d.tool END')} SELECT * FROM o"
)

_NAMED = "CASE WHEN tool = '' THEN 'tool_call' ELSE tool END || '({\"n\":' || CAST(eid AS STRING) || '})'"
_NONE = "NULL AS call_id, NULL AS call_name, NULL AS call_arguments, NULL AS answers"
_GPT = f"SELECT rid, pos, 0 AS k, CASE WHEN event_type = 'user_message' THEN 'human' ELSE 'gpt' END AS role, 't' || CAST(eid AS STRING) AS content FROM d WHERE event_type IN ('user_message', 'assistant_message')"
_NUMBERED = f"SELECT rid, CAST(row_number() OVER (PARTITION BY rid ORDER BY pos, k) - 1 AS BIGINT) AS n, role, content, {_NONE} FROM m"
_lowering("sharegpt", f"WITH {D}, m AS ({_GPT}) {_NUMBERED}")
_lowering(
    "sharegpt",
    f"WITH {D}, m AS ({_GPT} UNION ALL SELECT rid, pos, 0, 'gpt', '[Tool Call: ' || {_NAMED} || ']' FROM d WHERE event_type = 'tool_call') {_NUMBERED}",
    "_inline", tool_policy="inline"
)
_lowering(
    "hermes-xml",
    f"""WITH {D}, a AS (SELECT rid, cid, max_by(eid, pos) AS last FROM d WHERE event_type = 'tool_result' AND cid IS NOT NULL GROUP BY rid, cid), m AS ({_GPT} UNION ALL SELECT rid, pos, 0, 'gpt', '༄' || {_NAMED} || '༄' FROM d WHERE event_type = 'tool_call'
UNION ALL SELECT d.rid, d.pos, 1, 'tool', 'out' || CAST(a.last AS STRING) FROM d JOIN a ON d.rid = a.rid AND d.cid = a.cid WHERE d.event_type = 'tool_call'
UNION ALL SELECT rid, pos, 0, 'tool', 'out' || CAST(eid AS STRING) FROM d WHERE event_type = 'tool_result'
UNION ALL SELECT rid, pos, 0, 'gpt', chr(10) || 't' || CAST(eid AS STRING) || chr(10) || '</think>' FROM d WHERE event_type = 'reasoning'),
o AS ({_NUMBERED}) SELECT rid, n, role, content, call_id, call_name, call_arguments, answers FROM o""",
    reasoning_policy="metadata_only",
)


@query(f"""WITH {D}, g AS (SELECT *, sum(CASE WHEN event_type = 'tool_call' THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY pos) AS seg FROM d), f AS (SELECT rid, seg, min_by(eid, pos) AS nxt FROM g WHERE event_type = 'tool_result' GROUP BY rid, seg)
SELECT g.rid, g.pos, g.id AS step_id, g.tool AS tool_name, 'out' || CAST(f.nxt AS STRING) AS observation FROM g LEFT JOIN f ON g.rid = f.rid AND g.seg = f.seg WHERE g.event_type = 'tool_call'""")
def q_lower_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowering.lower(trajectories(spark, sf_dir), "process-supervision").messages.select(
        "rid", "pos", "step_id", "tool_name", F.col("observation.stdout").alias("observation")
    )


_LOSSES = f"{D}, x AS (SELECT rid, id AS event_id, 'info' AS severity, 'LOWER003' AS code FROM d WHERE event_type = 'reasoning' UNION ALL SELECT rid, id, 'warning', 'LOWER001' FROM d WHERE event_type = 'tool_call' AND cid IS NULL)"


@query(f"WITH {_LOSSES} SELECT rid, event_id, severity, code FROM x")
def q_loss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowering.lower(
        trajectories(spark, sf_dir), "openai-tools"
    ).losses.select("rid", "event_id", "severity", "code")


@query(f"""WITH {_LOSSES}, r AS (SELECT u.rid, CASE WHEN max(CASE WHEN severity = 'warning' THEN 1 ELSE 0 END) = 1 THEN 'lossy' WHEN count(severity) > 0 THEN 'partial' ELSE 'exact' END AS status, count(severity) AS n FROM (SELECT DISTINCT rid FROM d) u LEFT JOIN x ON u.rid = x.rid GROUP BY u.rid)
SELECT status, count(*) AS n_records, CAST(sum(n) AS BIGINT) AS n_losses FROM r GROUP BY status""")
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowering.status_counts(lowering.lower(trajectories(spark, sf_dir), "openai-tools"))


@query(
    "SELECT unnest(['anthropic-tools', 'hermes-xml', 'openai-tools', 'openhands', 'process-supervision', 'sft', 'sharegpt']) AS target, (SELECT count(DISTINCT user_id) FROM events) AS n_records"
)
def q_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lowering.lower_all(trajectories(spark, sf_dir), sorted(lowering.TARGETS))
    counts = [
        x.rows.agg(F.count("*").alias("n_records")).select(F.lit(n).alias("target"), "n_records") for n,
        x in found.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# -- reports, formats, files ----------------------------------------------------------------------


@query(f"""WITH {PAIRS} SELECT 'PAIR001' AS code, 'warning' AS severity, count(*) AS n FROM d LEFT JOIN p ON d.rid = p.rid AND d.pos = p.pos WHERE d.event_type = 'tool_call' AND p.pos IS NULL
UNION ALL SELECT 'PAIR002', 'warning', count(*) FROM d LEFT JOIN (SELECT DISTINCT rid, rpos FROM p) q ON d.rid = q.rid AND d.pos = q.rpos WHERE d.event_type = 'tool_result' AND q.rpos IS NULL""")
def q_diag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.diagnostic_counts(
        passes.pair_tool_results(trajectories(spark, sf_dir))
    ).select("code", "severity", "n")


@query(
    f"WITH {D} SELECT count(DISTINCT rid) AS n_records, count(DISTINCT rid) AS n_artifacts, count(*) AS n_events, count(DISTINCT rid) AS n_episodes FROM d"
)
def q_pipeline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.statistics(trajectories(spark, sf_dir)).select("n_records", "n_artifacts", "n_events", "n_episodes")


@query(
    f"WITH {D} SELECT rid, id AS event_id, 'events' AS source_field, 'derived' AS parser, 0.9 AS confidence FROM d WHERE eid % 3 <> 1"
)
def q_source_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.source_map(trajectories(spark, sf_dir))


@query(f"""WITH {D}, f AS (SELECT rid, event_type, min(pos) AS first FROM d GROUP BY rid, event_type), t AS (SELECT rid, string_agg(event_type, ',' ORDER BY first) AS types FROM f GROUP BY rid)
SELECT d.rid, count(*) AS n_events, string_agg(event_type, ',' ORDER BY pos) FILTER (WHERE pos < 10) AS first_types, any_value(t.types) AS types FROM d JOIN t ON d.rid = t.rid GROUP BY d.rid""")
def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spec.preview(trajectories(spark, sf_dir))


@query(
    """WITH n AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS rid FROM conversations) SELECT CAST(floor(rid / 256) AS BIGINT) AS batch_index, CAST(min(rid) AS BIGINT) AS start_row, CAST(max(rid) + 1 AS BIGINT) AS end_row, count(*) AS n_rows FROM n GROUP BY floor(rid / 256)"""
)
def q_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.batches(
        files.numbered(table(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id", "turn"])
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.try_parse_json("props")).alias("raw"))
    return rows.select("event_id", X.said(F.try_parse_json("raw"), "$.k").cast("bigint").alias("k"))


FORMAT = spec.load_spec(spec.new_spec("conversations"))
OTHER_FORMAT = {
    **FORMAT,
    "episodes": [
        {
            "events": [
                {
                    "foreach": {"var": "turns"}, "as": "turn", "index_as": "i",
                    "emit": {
                        "event_type": "tool_call", "role": {"path": "turn.role"}, "content": {"path": "turn.content"}
                    }
                }
            ]
        }
    ]
}


@query(
    f"WITH {TURNS} SELECT rid, 'dsl-row-' || rid AS record_id, CAST(pos AS BIGINT) AS idx, printf('evt_%04d', pos) AS event_id, role || '_message' AS event_type, role, text FROM c"
)
def q_dsl_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spec.compile_spec(FORMAT).parse(conversation_rows(spark, sf_dir)).events
    return e.select(
        "rid", "record_id", "idx", "event_id", "event_type", "role", X.content_text(F.col("content")).alias("text")
    )


@query("SELECT DISTINCT conv_id AS rid, 0.7 AS score, 'MATCH' AS verdict FROM conversations")
def q_dsl_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("raw")
    return conversation_rows(spark, sf_dir).select(
        "rid", spec.detection(FORMAT, v).alias("score"), spec.verdict(FORMAT, v).alias("verdict")
    )


@query(
    """SELECT event_id AS rid, CAST(json_extract(props, '$.k') AS BIGINT) AS whole, CAST(json_extract(props, '$.k') AS DOUBLE) AS number, CAST(json_extract(props, '$.k') AS BIGINT) <> 0 AS truth, 'evt_' || printf('%04d', event_id) AS name, 'unparsed_fragment' AS kind, event_type AS first FROM events"""
)
def q_dsl_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("rid"),
        F.try_parse_json(
            F.concat(
                F.lit('{"e":"'), F.col("event_type"), F.lit('","id":'), F.col("event_id"), F.lit(',"p":'),
                F.col("props"), F.lit("}")
            )
        ).alias("v")
    )
    s = spec.Scope(F.col("v"), {"i": X.get(F.col("v"), "$.id")})
    value = lambda e, kind: F.try_variant_get(s.value(e), "$", kind)
    return rows.select(
        "rid", value(
            {"transform": "to_integer", "input": "$.p.k"}, "bigint"
        ).alias("whole"), value({"transform": "to_float", "input": "$.p.k"}, "double").alias("number"), value(
            {"transform": "to_boolean", "input": "$.p.k"}, "boolean"
        ).alias("truth"),
        value({"template": "evt_{i:04d}"}, "string").alias("name"), value(
            {"transform": "role_to_event_type", "input": "$.e"}, "string"
        ).alias("kind"), value({"first_of": ["$.none", {"path": "$.e"}]}, "string").alias("first"),
    )


@query(
    """SELECT conv_id AS rid, count(*) AS n_a, count(*) AS n_b, string_agg(DISTINCT role || '_message', ',' ORDER BY role || '_message') AS only_a, 'unparsed_fragment' AS only_b FROM conversations GROUP BY conv_id"""
)
def q_dsl_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_rows(spark, sf_dir)
    return spec.diff(spec.compile_spec(FORMAT).parse(rows), spec.compile_spec(OTHER_FORMAT).parse(rows))



from weftline.plans import format_queries  # noqa: E402, F401  (fills the registry)
