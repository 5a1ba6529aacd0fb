"""The canonical form of trajectories: lazy DataFrames of records, events and diagnostics.

Order inside an episode is ``pos``; ``idx`` is what a source or pass says it is.  ``rid`` is
the key of a record (source ids need not be unique).  Arguments and other free-form values
stay JSON text, which keeps key order and number forms.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IR_VERSION = "0.1.0"

#: Closed value sets of the model (fixed values).
ENUMS: dict[str, tuple[str, ...]] = {
    "level": ("raw", "parsed", "canonical", "training", "target"),
    "event_type": (
        "system_message", "user_message", "assistant_message", "tool_message", "reasoning", "plan", "tool_call", "tool_result",
        "terminal_command", "terminal_output", "file_read", "file_write", "file_patch", "browser_action", "browser_observation",
        "todo_update", "state_snapshot", "verification", "reward", "error", "finish", "unparsed_fragment", "memory_read",
        "memory_write", "agent_handoff", "subtask_spawn", "subtask_result",
    ),
    "role": ("system", "user", "assistant", "tool", "developer", "environment", "unknown"),
    "status": ("success", "failure", "partial", "unknown"),
    "severity": ("info", "warning", "error", "fatal"),
    "lowering": ("exact", "lossy", "partial", "unsupported"),
    "policy": ("preserve", "summarize", "drop", "redact", "metadata_only"),
    "action_kind": (
        "message", "generic_tool", "terminal", "file_read", "file_write", "file_patch", "browser", "retrieval", "memory", "planner",
        "delegation", "finish", "unknown",
    ),
    "call_style": ("native_tool_call", "xml_block", "json_in_text", "bash_batch", "inferred", "none", "unknown"),
}

BLOCK = "struct<type:string,text:string,json:string>"
SCHEMAS = {
    "content": f"array<{BLOCK}>",
    "action": "struct<kind:string,tool_name:string,tool_call_id:string,arguments:string,call_style:string,side_effect_level:string,metadata:map<string,string>>",
    "observation": f"struct<kind:string,stdout:string,stderr:string,exit_code:bigint,content:array<{BLOCK}>,artifact_ids:array<string>,metadata:map<string,string>>",
    "provenance": "struct<source_field:string,parser:string,confidence:double>",
    "visibility": "struct<trainable:boolean,contains_reasoning:boolean,redaction_status:string,policy:string>",
    "source": "struct<dataset:string,framework:string,row_index:bigint,original_source:string,original_teacher:string>",
    "task": "struct<task_id:string,instruction:string,category:string,subcategory:string,benchmark:string,repo:string,base_commit:string>",
    "tools": "array<struct<name:string,description:string,input_schema:string>>",
    "verifier": "struct<passed:boolean,score:double,command:string,output:string>",
    "artifact_list": "array<struct<artifact_id:string,kind:string,content:string,sha256:string,size_bytes:bigint,created_by:string>>",
}
SCHEMAS["outcome"] = f"struct<status:string,reward:double,passed:boolean,failure_reason:string,final_patch_artifact_id:string,verifier:{SCHEMAS['verifier']}>"

EVENT_FIELDS: dict[str, str] = {
    "rid": "bigint", "record_id": "string", "ep_pos": "int", "episode_id": "string", "pos": "bigint", "event_id": "string", "idx": "bigint",
    "event_type": "string", "role": "string", "content": SCHEMAS["content"], "action": SCHEMAS["action"], "observation": SCHEMAS["observation"],
    "parents": "array<string>", "children": "array<string>", "artifacts": "array<string>", "writes": "array<string>", "patch_artifact_id": "string",
    "provenance": SCHEMAS["provenance"], "visibility": SCHEMAS["visibility"], "raw": "string", "metadata": "map<string,string>",
}
RECORD_FIELDS: dict[str, str] = {
    "rid": "bigint", "record_id": "string", "level": "string", "source": SCHEMAS["source"], "task": SCHEMAS["task"], "tools": SCHEMAS["tools"], "model": "string",
    "outcome": SCHEMAS["outcome"], "artifacts": SCHEMAS["artifact_list"], "raw": "string", "metadata": "map<string,string>",
}
DIAGNOSTIC_FIELDS: dict[str, str] = {
    "rid": "bigint", "record_id": "string", "pass": "string", "code": "string", "severity": "string",
    "event_id": "string", "field": "string", "message": "string"
}

#: Diagnostic codes with their default severity (both fixed values) and a message.
CODES: dict[str, tuple[str, str]] = {
    "PARSE001": ("warning", "a block of tool markup is broken"),
    "PARSE002": ("warning", "a text that looks like a diff is none"),
    "PARSE003": ("warning", "arguments of a call are no JSON"),
    "PAIR001": ("warning", "a call without a result"),
    "PAIR002": ("warning", "a result without a call"),
    "VERIFY001": ("error", "an event id or index occurs again"),
    "VERIFY002": ("error", "a reference to an event or call that is not there"),
    "VERIFY003": ("warning", "a reference to an artifact that is not there"),
    "VERIFY004": ("warning", "an event lacks its policy, content or origin"),
    "OUTCOME001": ("warning", "reward and verdict contradict each other"),
    "LOWER001": ("warning", "a call got an id made from its event"),
    "LOWER002": ("warning", "no place for an artifact in the target"),
    "LOWER003": ("warning", "no place for reasoning or messages in the target"),
    "LOWER004": ("warning", "a plan or call became plain text"),
    "DATA001": ("warning", "the assistant says nothing"),
    "DATA002": ("warning", "a field that the format needs is not there"),
    "SCHEMA001": ("error", "a value that the schema does not allow"),
    "IO001": ("error", "a file that can't be read"),
    "IO002": ("error", "a file that can't be written"),
}


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def empty(kind: str) -> Column:
    """An empty array or map."""
    return F.array().cast(kind) if kind.startswith("array") else F.create_map().cast(kind)


def struct_of(kind: str, /, **fields: Column) -> Column:
    """A struct of the named schema with the given fields, others null, in its order."""
    names = T.StructType.fromDDL(SCHEMAS[kind][len("struct<") : -1])
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in names.fields])


def text_block(text: Column, kind: str = "text") -> Column:
    return F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), null_of("string").alias("json"))


def visible(**changes: Column) -> Column:
    return struct_of(
        "visibility",
        **({"trainable": F.lit(True), "contains_reasoning": F.lit(False), "redaction_status": F.lit("none")} | changes)
    )


def events_of(df: DataFrame) -> DataFrame:
    """All event columns in order; those that df lacks get their defaults."""
    default = {
        "ep_pos": F.lit(0), "episode_id": F.lit("ep_0"), "content": empty(SCHEMAS["content"]),
        "parents": empty("array<string>"), "children": empty("array<string>"), "artifacts": empty("array<string>"),
        "writes": empty("array<string>"), "visibility": visible(), "metadata": empty("map<string,string>")
    }
    return df.select(
        *[
            (F.col(n) if n in df.columns else default.get(n, F.lit(None))).cast(t).alias(n) for n,
            t in EVENT_FIELDS.items()
        ]
    )


def records_of(df: DataFrame) -> DataFrame:
    default = {
        "level": F.lit("parsed"), "tools": empty(SCHEMAS["tools"]), "artifacts": empty(SCHEMAS["artifact_list"]),
        "metadata": empty("map<string,string>")
    }
    return df.select(
        *[
            (F.col(n) if n in df.columns else default.get(n, F.lit(None))).cast(t).alias(n) for n,
            t in RECORD_FIELDS.items()
        ]
    )


def diagnostics_of(
    df: DataFrame, origin: str, code: str | Column, field: str | None = None, severity: str | None = None, event_id: Column | None = None
) -> DataFrame:
    """One diagnostic for each row of df (which has rid, record_id and, for events, event_id); a Column can give each row its own code."""
    if isinstance(code, Column):
        known = lambda i: F.create_map(*[F.lit(x) for c, v in CODES.items() for x in (c, v[i])])[code]
        default, message = known(0), known(1)
    else:
        default, message = map(F.lit, CODES.get(code, ("info", code)))
        code = F.lit(code)
    at = event_id if event_id is not None else F.col("event_id") if "event_id" in df.columns else null_of("string")
    values = {
        "rid": F.col("rid"), "record_id": F.col("record_id"), "pass": F.lit(origin), "code": code, "event_id": at,
        "field": F.lit(field)
    }
    values |= {"severity": F.lit(severity) if severity else default, "message": message}
    return df.select(*[values[n].cast(t).alias(n) for n, t in DIAGNOSTIC_FIELDS.items()])


def no_diagnostics(like: DataFrame) -> DataFrame:
    return like.sparkSession.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in DIAGNOSTIC_FIELDS.items()))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where that is unset and the master is local, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="weftline-")


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, read from the folder in spark.checkpoint.dir."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@dataclass(frozen=True)
class Trajectories:
    records: DataFrame
    events: DataFrame
    diagnostics: DataFrame

    def with_(
        self, records: DataFrame | None = None, events: DataFrame | None = None,
        diagnostics: list[DataFrame] | None = None
    ) -> Trajectories:
        """A copy with other records or events, and more diagnostics."""
        added = self.diagnostics
        for d in diagnostics or []:
            added = added.unionByName(d)
        return replace(
            self, records=self.records if records is None else records,
            events=self.events if events is None else events, diagnostics=added
        )

    def settled(self) -> Trajectories:
        """The same with its lineage cut: written to the folder in spark.checkpoint.dir.

        Passes read events and records several times each; without a cut now and then, the
        plan of a long list of passes grows as a power of its length.
        """
        return Trajectories(checkpointed(self.records), checkpointed(self.events), checkpointed(self.diagnostics))
