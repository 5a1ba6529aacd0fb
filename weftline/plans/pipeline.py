"""Whole runs: rows to trajectories, passes, a target, and the reports about them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.model import CODES, ENUMS, IR_VERSION, RECORD_FIELDS, EVENT_FIELDS, Trajectories
from weftline.operators import lowering, passes
from weftline.sources import files, frontends

#: Registered dialects: name and the event types it describes (fixed values).
DIALECTS: dict[str, tuple[str, ...]] = {
    "agent": (
        "system_message", "user_message", "assistant_message", "reasoning", "plan", "todo_update", "memory_read",
        "memory_write", "agent_handoff", "subtask_spawn", "subtask_result", "state_snapshot", "finish",
        "unparsed_fragment",
    ),
    "browser": (
        "browser_action", "browser_observation",
    ),
    "eval": (
        "verification", "reward",
    ),
    "file": (
        "file_read", "file_write", "file_patch",
    ),
    "reasoning": (
        "reasoning", "plan",
    ),
    "swe": (
        "file_patch", "verification", "reward",
    ),
    "terminal": (
        "terminal_command", "terminal_output",
    ),
    "tool": (
        "tool_call", "tool_result",
    ),
}


def register_dialect(name: str, event_types: tuple[str, ...]) -> None:
    """Add or replace a dialect; ``event_types`` are names of the model."""
    unknown = set(event_types) - set(ENUMS["event_type"])
    if unknown:
        raise ValueError(f"unknown event types: {', '.join(sorted(unknown))}")
    DIALECTS[name] = event_types


def dialects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(n, IR_VERSION, list(x)) for n, x in DIALECTS.items()],
        "name string, version string, event_types array<string>"
    )


def compile_rows(
    df: DataFrame, frontend: str, pass_names: str | list[str] = "default", target: str = "openai-tools",
    ctx: lowering.Context = lowering.Context(), **options: dict
) -> tuple[lowering.Lowered, Trajectories, DataFrame]:
    """Parse, run passes and lower, as one lazy plan.  Gives the target rows, the trajectories and the quarantine."""
    chosen = passes.validated(pass_names)
    frontends.frontend(frontend)
    if target not in lowering.TARGETS:
        raise KeyError(f"unknown target: {target}; known: {', '.join(sorted(lowering.TARGETS))}")
    parsed, bad = frontends.convert(df, frontend)
    t = passes.run_passes(parsed, chosen, **options)
    return lowering.lower(t, target, ctx), t, bad


def compile_files(
    spark: SparkSession, source: str, out: str, frontend: str, pass_names: str | list[str] = "default",
    target: str = "openai-tools", limit: int | None = None, report: str | None = None
) -> DataFrame:
    """From a file to a file; returns the status counts.  With ``report``, losses go there as JSON lines."""
    lowered, _, bad = compile_rows(files.read_rows(spark, source, limit), frontend, pass_names, target)
    files.write_rows(lowered.rows.select("output.*"), out, keep_nulls=True)
    if report:
        files.write_rows(lowered.losses, report + "/losses", "jsonl")
        files.write_rows(bad, report + "/quarantine", "jsonl")
    return lowering.status_counts(lowered)


def save(t: Trajectories, path: str) -> None:
    """Trajectories as three Parquet tables."""
    for name in ("records", "events", "diagnostics"):
        getattr(t, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> Trajectories:
    return Trajectories(*[spark.read.parquet(f"{path}/{name}") for name in ("records", "events", "diagnostics")])


def diagnostic_counts(t: Trajectories) -> DataFrame:
    return t.diagnostics.groupBy("pass", "code", "severity").agg(F.count("*").alias("n"))


def severity_counts(t: Trajectories) -> DataFrame:
    return t.diagnostics.groupBy("severity").agg(F.count("*").alias("n"))


def verification(t: Trajectories, strict: bool = False) -> tuple[int, DataFrame]:
    """(exit code, counts): 0 without errors, 1 with some, 4 with some where ``strict``."""
    found = passes.verify(Trajectories(t.records, t.events, t.diagnostics.where(F.lit(False))), strict)
    counts = severity_counts(found)
    worst = {r["severity"] for r in counts.collect()}
    return (4 if strict else 1) if worst & {"error", "fatal"} else 0, counts


def measured_passes(t: Trajectories, names: str | list[str]) -> tuple[Trajectories, DataFrame]:
    """Passes run one by one, each written to the checkpoint folder, and ``(nth, pass, elapsed_ms, n_events, n_diagnostics)``."""
    rows, before = [], t.diagnostics.count()
    for i, name in enumerate(passes.validated(names)):
        start = time.perf_counter()
        t = passes.PASSES[name](t).settled()
        took = 1000 * (time.perf_counter() - start)
        diagnostics = t.diagnostics.count()
        rows.append((i, name, took, t.events.count(), diagnostics - before))
        before = diagnostics
    schema = "nth int, pass string, elapsed_ms double, n_events bigint, n_diagnostics bigint"
    return t, t.events.sparkSession.createDataFrame(rows, schema)


def statistics(t: Trajectories) -> DataFrame:
    """One row: records, events, episodes, artifacts, diagnostics by severity."""
    e = t.events.agg(
        F.count("*").alias("n_events"), F.countDistinct("rid", "ep_pos").alias("n_episodes"),
        F.countDistinct("rid").alias("n_with_events")
    )
    r = t.records.agg(
        F.count("*").alias("n_records"),
        F.coalesce(F.sum(F.size("artifacts")), F.lit(0)).cast("bigint").alias("n_artifacts")
    )
    d = t.diagnostics.agg(*[F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in ENUMS["severity"]])
    return r.crossJoin(e).crossJoin(d)  # single rows


def source_map(t: Trajectories) -> DataFrame:
    """Where events come from: ``(rid, event_id, source_field, parser, confidence)``."""
    return t.events.where("provenance is not null").select("rid", "event_id", "provenance.*")


def markdown(counts: DataFrame, title: str) -> str:
    """A table of a small aggregate."""
    rows, names = counts.collect(), counts.columns
    return "\n".join(
        [
            f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "-|" * len(names),
            *["| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows]
        ]
    ) + "\n"


def diagnostic_lines(t: Trajectories) -> DataFrame:
    """``severity[CODE]: message`` with the place below, one text for each diagnostic."""
    at = F.concat_ws(":", F.col("record_id"), F.col("event_id"), F.col("field"))
    return t.diagnostics.select(
        "rid",
        F.concat(
            F.col("severity"), F.lit("["), F.col("code"), F.lit("]: "), F.coalesce("message", F.lit("")),
            F.when(at != "", F.concat(F.lit("\n  --> "), at)).otherwise("")
        ).alias("line")
    )


def _parts(inner: str) -> list[str]:
    """The members of ``struct<...>`` or ``map<...>``: what stands between commas outside of brackets."""
    out, depth = [""], 0
    for c in inner:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def _type_schema(kind: str) -> dict:
    """JSON Schema of a column type, all the way down; every value can be null."""
    outer, _, inner = kind.partition("<")
    inner = inner.removesuffix(">")
    if outer == "struct":
        fields = [f.partition(":") for f in _parts(inner)]
        return {"type": ["object", "null"], "properties": {n: _type_schema(t) for n, _, t in fields}}
    if outer == "array":
        return {"type": ["array", "null"], "items": _type_schema(inner)}
    if outer == "map":
        return {"type": ["object", "null"], "additionalProperties": _type_schema(_parts(inner)[1])}
    kinds = {"bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean"}
    return {"type": [kinds.get(kind, "string"), "null"]}


def json_schema() -> dict:
    """A JSON Schema of the record, from the column types and the closed value sets."""
    types = lambda fields: {n: _type_schema(kind) for n, kind in fields.items()}
    event, record = types(EVENT_FIELDS), types(RECORD_FIELDS)
    event["event_type"] = {"enum": list(ENUMS["event_type"])}
    event["role"] = {"enum": list(ENUMS["role"])}
    record["level"] = {"enum": list(ENUMS["level"])}
    record["outcome"]["properties"]["status"] = {"enum": [*ENUMS["status"], None]}
    record["events"] = {"type": "array", "items": {"type": "object", "properties": event}}
    head = {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "trajectory record", "version": IR_VERSION}
    return {**head, "type": "object", "properties": record, "codes": sorted(CODES)}


def throughput(df: DataFrame, frontend: str) -> dict[str, float]:
    """Records and events a second of parsing to a sink that keeps nothing, after a warm-up on five rows."""
    frontends.convert(df.limit(5), frontend)[0].events.write.format("noop").mode("overwrite").save()
    t, _ = frontends.convert(df, frontend)
    start = time.perf_counter()
    t.events.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    return {"seconds": took, "records_per_s": df.count() / took, "events_per_s": t.events.count() / took}
