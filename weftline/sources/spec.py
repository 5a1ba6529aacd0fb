"""Declarative trajectory formats: a YAML mapping compiled once into Columns over the row.

Every value expression becomes a VARIANT column, so evaluation is JVM code that Catalyst can
share between expressions; nothing is interpreted for each row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from pathlib import Path
from string import Formatter
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import DIAGNOSTIC_FIELDS, ENUMS, SCHEMAS, Trajectories, empty, events_of, no_diagnostics, null_of, records_of, struct_of, text_block
from weftline.sources.frontends import Frontend

API_VERSIONS = re.compile(r".+/v0\.1$")
ROLES = ("system", "user", "assistant", "tool", "developer")
REQUIRED = ("apiVersion", "kind", "metadata", "source", "episodes")
EMIT_KEYS = frozenset(
    (
        "event_id", "idx", "event_type", "role", "actor_id", "content", "action", "observation", "artifacts",
        "provenance", "timestamp", "metadata",
    )
)
MESSAGE_TYPES = ("system_message", "user_message", "assistant_message", "tool_message", "unparsed_fragment")
CONTEXT_KEYS = ("dataset", "config", "split", "row_index")


# -- loading and validation (on the driver) ------------------------------------------------


def load_spec(source: str | Path) -> dict[str, Any]:
    """A mapping from a YAML file or text; ValueError if it is none."""
    text = Path(source).read_text() if isinstance(source, Path) or "\n" not in source else source
    spec = yaml.safe_load(text)
    if not isinstance(spec, dict):
        raise ValueError("a format is a mapping")
    return spec


def problems(source: str | Path | dict[str, Any]) -> list[tuple[str, str, str, str]]:
    """(code, severity, field, message) of everything wrong with a format; empty for a good one."""
    if not isinstance(source, dict):
        try:
            source = load_spec(source)
        except OSError as e:
            return [("IO001", "error", "", str(e))]
        except yaml.YAMLError as e:
            return [("PARSE003", "error", "", str(e).splitlines()[0])]
        except ValueError as e:
            return [("SCHEMA001", "error", "", str(e))]
    found = [("SCHEMA001", "error", k, "required") for k in REQUIRED if k not in source]
    version = source.get("apiVersion")
    if version is not None and not API_VERSIONS.match(str(version)):
        found.append(("SCHEMA002", "warning", "apiVersion", f"unknown version {version}"))
    if "kind" in source and source["kind"] != "TrajectoryFormat":
        found.append(("SCHEMA001", "error", "kind", "must be TrajectoryFormat"))
    if isinstance(source.get("metadata"), dict) and not source["metadata"].get("name"):
        found.append(("SCHEMA001", "error", "metadata.name", "required"))
    episodes = source.get("episodes")
    if "episodes" in source and (not isinstance(episodes, list) or not episodes):
        found.append(("SCHEMA003", "error", "episodes", "at least one episode"))
    for i, episode in enumerate(episodes if isinstance(episodes, list) else []):
        for j, mapping in enumerate(episode.get("events") or [] if isinstance(episode, dict) else []):
            unknown = set((mapping or {}).get("emit") or {}) - EMIT_KEYS
            found += [
                ("SCHEMA001", "error", f"episodes[{i}].events[{j}].emit.{k}", "not allowed") for k in sorted(unknown)
            ]
    return found


def validation(spark: SparkSession, source: str | Path | dict[str, Any]) -> DataFrame:
    """The problems as diagnostics."""
    rows = [
        (None, None, "validate", code, severity, None, field, message) for code, severity, field,
        message in problems(source)
    ]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in DIAGNOSTIC_FIELDS.items()))


def is_valid(source: str | Path | dict[str, Any]) -> bool:
    return not any(severity == "error" for _, severity, *_ in problems(source))


def find_specs(*roots: str) -> list[Path]:
    """Format files below the given folders."""
    return sorted(p for root in roots for p in Path(root).rglob("*.yaml") if "TrajectoryFormat" in p.read_text())


# -- expressions ---------------------------------------------------------------------------


def _literal(x: Any) -> Column:
    return F.parse_json(F.lit(json.dumps(x)))


def _variant(x: Column) -> Column:
    """Text as a VARIANT string."""
    return F.try_parse_json(F.to_json(F.array(x)))


def _text_variant(x: Column) -> Column:
    return X.let(x, lambda t: F.when(t.isNotNull(), X.get(_variant(t), "$[0]")))


def _known(v: Column) -> Column:
    """SQL null for a JSON null."""
    return X.let(v, lambda x: F.when(X.exists(x), x))


def _segments(path: str) -> list[str]:
    return [a or b for a, b in re.findall(r"\[([^\]]*)\]|([^.\[\]]+)", path)]


def _walk(at: Column, segments: list[str]) -> Column:
    """Down a path; a wildcard gives the list it stands on and ends the path."""
    for s in segments:
        if s == "*":
            return X.let(at, lambda x: F.when(X.is_list(x), x))
        if re.fullmatch(r"-?\d+", s):
            n = int(s)
            at = X.get(at, f"$[{n}]") if n >= 0 else F.try_element_at(X.items(at), F.lit(n))
        else:
            at = X.get(at, "$['" + s.replace("'", "\\'") + "']")
    return _known(at)


class Scope:
    """What names stand for: the row, earlier vars, loop variables, and context values."""

    def __init__(
        self, root: Column, names: dict[str, Column] | None = None, context: dict[str, Column] | None = None,
        resolve_context: bool = False
    ):
        self.root, self.names, self.context, self.resolve_context = root, names or {}, context or {}, resolve_context

    def with_(self, **names: Column) -> Scope:
        return Scope(self.root, self.names | names, self.context, self.resolve_context)

    def path(self, path: str) -> Column:
        if path.startswith("$"):
            return _walk(self.root, _segments(path[1:]))
        segments = path.split(".")
        found = [_walk(self.root, segments)]
        if segments[0] in self.names:
            found.append(_walk(self.names[segments[0]], segments[1:]))
        return F.coalesce(*found)

    def value(self, e: Any) -> Column:
        """The VARIANT of an expression; null where it has no value."""
        if e is None:
            return null_of("variant")
        if isinstance(e, (bool, int, float)):
            return _literal(e)
        if isinstance(e, str):
            if e.startswith("$"):
                return self.path(e)
            if "." in e and not e.startswith(("{", "http", "ftp")):
                head, *rest = e.split(".")
                own = [_walk(self.names[head], rest)] if head in self.names else []
                return F.coalesce(*own, self.path(e))
            return _literal(e)
        if isinstance(e, list):
            return F.to_variant_object(F.array(*[self.value(x) for x in e])) if e else _literal([])
        if "var" in e:
            return _known(self.names.get(e["var"], null_of("variant")))
        if "const" in e:
            return _known(_literal(e["const"]))
        if "template" in e:
            return _text_variant(self.template(e["template"]))
        if "path" in e:
            return self.path(e["path"])
        if "transform" in e:
            return self.transformed(e["transform"], self.value(e.get("input")), e.get("fallback"))
        if "first_of" in e:
            return F.coalesce(*[self.value(x) for x in e["first_of"]], null_of("variant"))
        if not e:
            return _literal({})
        return F.to_variant_object(F.struct(*[self.value(x).alias(k) for k, x in e.items()]))

    def template(self, form: str) -> Column:
        """Python format fields over names and context; the text itself where one is unknown or does not fit."""
        parts: list[Column] = []
        for literal, name, spec, _ in Formatter().parse(form):
            if literal:
                parts.append(F.lit(literal))
            if name is None:
                continue
            if name.startswith("context.") and self.resolve_context:
                name = name.split(".", 1)[1]
            if name in self.names:
                v = _known(self.names[name])
            elif name in self.context:
                v = self.context[name]
            else:
                return F.lit(form)
            text = _said(v)
            if spec:
                whole = re.fullmatch(r"(0?\d*)d", spec)
                if not whole:
                    return F.lit(form)
                number = text.try_cast("bigint")
                parts.append(F.when(number.isNotNull(), F.format_string(f"%{whole[1]}d", number)))
            else:
                parts.append(F.coalesce(text, F.lit("None")))
        return F.coalesce(F.concat(*parts), F.lit(form)) if parts else F.lit("")

    def transformed(self, name: str, v: Column, fallback: Any) -> Column:
        return X.let(v, lambda x: self._transformed(name, x, fallback))

    def _transformed(self, name: str, v: Column, fallback: Any) -> Column:
        other = _known(_literal(fallback)) if fallback is not None else null_of("variant")
        text, lower = _said(v), F.lower(F.coalesce(_said(v), F.lit("none")))
        kind = name.lower().replace("-", "_")
        if kind == "role_to_event_type":
            return _text_variant(
                F.when(lower == "developer", "system_message").when(
                    lower.isin(*ROLES), F.concat(lower, F.lit("_message"))
                ).otherwise("unparsed_fragment")
            )
        if kind == "role_to_message_role":
            return _text_variant(F.when(lower.isin(*ROLES), lower).otherwise("unknown"))
        if kind == "parse_json":
            return F.coalesce(
                F.when(X.is_string(v), F.try_parse_json(X.string(v))).when(X.is_list(v) | X.is_object(v), v), other
            )
        if kind == "extract_text":
            part = lambda p: F.when(
                X.is_object(p) & X.exists(X.get(p, "$.text")), _said(X.get(p, "$.text"))
            ).otherwise(_said(p))
            joined = F.array_join(F.filter(F.transform(X.items(v), part), lambda x: x.isNotNull()), "\n")
            return F.coalesce(_text_variant(F.when(X.is_list(v), joined).otherwise(text)), other)
        if kind == "to_string":
            return F.coalesce(_text_variant(text), other)
        if kind == "to_integer":
            n = F.when(
                X.is_bool(v), F.when(text == "True", 1).otherwise(0).cast("bigint")
            ).when(
                X.is_string(v), X.strip(text).try_cast("bigint")
            ).otherwise(text.try_cast("double").try_cast("bigint"))
            return F.coalesce(F.try_parse_json(n.cast("string")), other)
        if kind == "to_float":
            n = F.when(
                X.is_bool(v), F.when(text == "True", 1.0).otherwise(0.0)
            ).otherwise(X.strip(text).try_cast("double"))
            return F.coalesce(F.try_parse_json(n.cast("string")), other)
        if kind == "to_boolean":
            truth = F.when(X.is_bool(v), text == "True").when(
                X.is_string(v), lower.isin("true", "yes", "1")
            ).otherwise(text.try_cast("double") != 0)
            return F.coalesce(F.try_parse_json(truth.cast("string")), other)
        return other


def _said(v: Column) -> Column:
    """As text; booleans as True and False, lists and objects as JSON."""
    return X.let(v, lambda x: F.when(X.is_bool(x), F.initcap(F.try_variant_get(x, "$", "string"))).otherwise(X.said(x)))


# -- detection -------------------------------------------------------------------------------


def _rule(rule: dict[str, Any], scope: Scope) -> Column | None:
    """Whether a rule holds; None for predicates that are accepted and never evaluated."""
    at = scope.path
    if "field_exists" in rule:
        return X.exists(at(rule["field_exists"]))
    if "field_missing" in rule:
        return ~X.exists(at(rule["field_missing"]))
    if "field_is_list" in rule:
        return X.is_list(at(rule["field_is_list"]))
    if "field_is_dict" in rule:
        return X.is_object(at(rule["field_is_dict"]))
    if "field_is_string" in rule:
        return X.is_string(at(rule["field_is_string"]))
    if "any_field_exists" in rule:
        return F.greatest(F.lit(False), *[X.exists(at(p)) for p in rule["any_field_exists"]], F.lit(False))
    if "all_fields_exist" in rule:
        return F.least(F.lit(True), *[X.exists(at(p)) for p in rule["all_fields_exist"]], F.lit(True))
    if "text_contains" in rule:
        t = rule["text_contains"]
        field, wanted = (
            t.get("field") or t.get("path"), t.get("values") or t.get("any") or [t.get("value") or t.get("text")]
        ) if isinstance(t, dict) else (rule.get("field", "$"), t if isinstance(t, list) else [t])
        said = F.coalesce(X.said(at(field)), F.lit(""))
        return F.greatest(
            F.lit(False), *[F.contains(said, F.lit(str(w))) for w in wanted if w is not None], F.lit(False)
        )
    return None


def detection(spec: dict[str, Any], v: Column) -> Column:
    """The sum of the scores of the rules that hold, at most 1; 1 without rules."""
    rules = (spec.get("detect") or {}).get("rules") or []
    if not rules:
        return F.lit(1.0)
    total = F.lit(0.0)
    for rule in rules:
        holds = _rule(rule, Scope(v))
        if holds is not None:
            total = total + F.when(holds, float(rule.get("score", 0))).otherwise(0.0)
    return F.least(F.lit(1.0), total)


def verdict(spec: dict[str, Any], v: Column) -> Column:
    return F.when(
        detection(spec, v) >= float((spec.get("detect") or {}).get("min_score", 0.5)), "MATCH"
    ).otherwise("LOW")


# -- records and events ------------------------------------------------------------------------


def _blocks(v: Column) -> Column:
    """Content blocks of a text, a list of texts and typed objects, or anything else as text."""

    def one(p: Column) -> Column:
        kind = F.coalesce(X.string(p, "$.type"), F.lit("text"))
        words = F.coalesce(_said(X.get(p, "$.text")), F.lit(""))
        thought = F.coalesce(_said(X.get(p, "$.thinking")), words)
        raw = F.struct(F.lit("json").alias("type"), null_of("string").alias("text"), F.to_json(p).alias("json"))
        return F.when(X.is_string(p), text_block(X.string(p))).when(
            ~X.is_object(p), null_of(SCHEMAS["content"][6:-1])
        ).when(kind == "text", text_block(words)).when(
            kind.isin("thinking", "reasoning"), text_block(thought)
        ).otherwise(raw)

    none = empty(SCHEMAS["content"])
    return X.let(v, lambda v: _content(v, one, none))


def _content(v: Column, one: Callable[[Column], Column], none: Column) -> Column:
    listed = F.filter(F.transform(X.items(v), one), lambda b: b.isNotNull())
    return F.when(~X.exists(v), none).when(X.is_list(v), listed).when(_said(v) == "", none).otherwise(
        F.array(text_block(_said(v)))
    )


def compile_spec(spec: dict[str, Any], resolve_context: bool = False) -> Frontend:
    """A frontend of a format.  ``resolve_context`` lets templates use ``{context.row_index}``, which otherwise stays literal text."""
    name = spec["metadata"]["name"]

    def parse(df: DataFrame, dataset: str | None = None) -> Trajectories:
        return _parse(spec, df, dataset, resolve_context)

    return Frontend(name, lambda v: detection(spec, v), parse, lambda v: _rejected(spec, v, resolve_context))


def _said_of(scope: Scope, mapping: dict[str, Any], e: Any) -> Callable[[Column, Column], Column]:
    """The text of an expression for an item of a mapping's list and its index."""

    def said(item: Column, i: Column) -> Column:
        names = {mapping.get("as", "item"): item, mapping.get("index_as", "index"): F.try_parse_json(i.cast("string"))}
        return _said(scope.with_(**names).value(e))

    return said


def _outside(said: Column, values: tuple[str, ...]) -> Column:
    return F.filter(said, lambda x: x.isNotNull() & ~x.isin(*values))


def _rejected(spec: dict[str, Any], v: Column, resolve_context: bool) -> Column:
    """Why a row has an action whose kind or call style is no value of the model; null if all are."""
    scope = Scope(v, {}, {}, resolve_context)
    for k, e in (spec.get("vars") or {}).items():
        scope = scope.with_(**{k: scope.value(e)})
    reason = null_of("string")
    checked = (("kind", ENUMS["action_kind"]), ("call_style", ENUMS["call_style"]))
    for mapping in [m for episode in spec["episodes"] for m in episode.get("events") or []]:
        action = (mapping.get("emit") or {}).get("action") or {}
        each = scope.value(mapping["foreach"]) if "foreach" in mapping else _literal([None])
        for field, values in [x for x in checked if x[0] in action]:
            listed = X.let(each, lambda e: F.when(X.is_list(e), X.items(e)).when(X.exists(e), F.array(e)))
            said = F.transform(listed, _said_of(scope, mapping, action[field]))
            wrong = _outside(said, values)
            reason = F.coalesce(
                reason, F.when(F.size(wrong) > 0, F.concat(F.lit(f"action.{field}: "), F.get(wrong, F.lit(0))))
            )
    return reason


def _parse(spec: dict[str, Any], df: DataFrame, dataset: str | None, resolve_context: bool) -> Trajectories:
    source = spec.get("source") or {}
    data = source.get("default_dataset") or dataset
    rows = df.select(
        F.col("rid").cast("bigint").alias("rid"), F.col("raw").cast("string").alias("raw"),
        F.try_parse_json("raw").alias("root")
    )
    context = {
        "row_index": F.try_parse_json(F.col("rid").cast("string")), "dataset": _text_variant(F.lit(data)),
        "config": _text_variant(F.lit(source.get("default_config"))),
        "split": _text_variant(F.lit(source.get("default_split")))
    }
    scope = Scope(F.col("root"), {}, context, resolve_context)
    for k, e in (spec.get("vars") or {}).items():  # later vars see earlier ones
        rows = rows.withColumn(f"var_{k}", scope.value(e))
        scope = scope.with_(**{k: F.col(f"var_{k}")})
    own = (spec.get("source_overrides") or {}).get("row_id")
    ids = [_said(scope.value(own))] if own is not None else []
    ids += [_said(scope.path(p)) for p in ("$.id", "$.instance_id", "$.trajectory_id")]
    rows = rows.withColumn("record_id", F.coalesce(*ids, F.concat(F.lit("dsl-row-"), F.col("rid"))))
    text = lambda e: _said(scope.value(e))
    task, outcome = spec.get("task"), spec.get("outcome")
    fields: dict[str, Column] = {
        "source": struct_of(
            "source", dataset=F.lit(data), framework=F.lit(source.get("framework")), row_index=F.col("rid")
        )
    }
    if task:
        fields["task"] = struct_of(
            "task", **{k: text(task[k]) for k in ("task_id", "instruction", "category", "subcategory") if k in task}
        )
    if outcome:
        status = text(outcome.get("status"))
        passed = scope.transformed("to_boolean", scope.value(outcome.get("passed")), None)
        fields["outcome"] = struct_of(
            "outcome", status=F.when(status.isin(*ENUMS["status"]), status).otherwise("unknown"),
            passed=F.try_variant_get(passed, "$", "boolean")
        )
    tools = spec.get("tool_registry")
    if tools and "from" in tools:
        fields["tools"] = F.transform(
            X.items(scope.value(tools["from"])),
            lambda x, i: _tool(scope.with_(**{tools.get("as", "tool"): x, "item": x}), tools.get("item") or {}, i)
        )
    events = None
    for ep_pos, episode in enumerate(spec["episodes"]):
        for nth, mapping in enumerate(episode.get("events") or []):
            made = _mapping(rows, scope, episode, ep_pos, nth, mapping)
            if made is not None:
                events = made if events is None else events.unionByName(made)
    if events is None:
        events = events_of(rows.where(F.lit(False)).select("rid", "record_id"))
    records = records_of(
        rows.select("rid", "record_id", F.lit("parsed").alias("level"), "raw", *[c.alias(k) for k, c in fields.items()])
    )
    return Trajectories(records, events, no_diagnostics(df))


def _tool(scope: Scope, item: dict[str, Any], i: Column) -> Column:
    get = lambda k, *others: F.coalesce(
        *[_said(scope.value(item[n])) for n in (k, *others) if n in item], null_of("string")
    )
    return F.struct(
        F.coalesce(get("name"), F.concat(F.lit("tool_"), i)).alias("name"), get("description").alias("description"),
        get("input_schema", "parameters").alias("input_schema")
    )


def _mapping(
    rows: DataFrame, scope: Scope, episode: dict[str, Any], ep_pos: int, nth: int, mapping: dict[str, Any]
) -> DataFrame | None:
    """Events of one mapping: an explode of its list, emitted fields as projections.  Order is (mapping, item)."""
    emit = mapping.get("emit")
    if not emit:
        return None
    each = scope.value(mapping["foreach"]) if "foreach" in mapping else _literal([None])
    listed = X.let(each, lambda e: F.when(X.is_list(e), X.items(e)).when(X.exists(e), F.array(e)))
    items = rows.withColumn(
        "episode_id",
        F.coalesce(_said(scope.value(episode.get("episode_id"))), F.concat("record_id", F.lit(f"-ep-{ep_pos}")))
    )
    items = items.select("*", F.posexplode(listed).alias("item_i", "item"))
    inner = scope.with_(
        **{
            mapping.get("as", "item"): F.col("item"),
            mapping.get("index_as", "index"): F.try_parse_json(F.col("item_i").cast("string"))
        }
    )
    text = lambda k: _said(inner.value(emit[k])) if k in emit else null_of("string")
    idx = F.coalesce(_said(inner.value(emit.get("idx"))).try_cast("bigint"), F.col("item_i").cast("bigint"))
    role = F.lower(text("role"))
    kind = text("event_type")
    # literal types go through the role table, too
    kind = X.let(
        kind,
        lambda k: F.when(k.isin(*MESSAGE_TYPES), k).when(F.lower(k) == "developer", "system_message").when(
            F.lower(k).isin(*ROLES), F.concat(F.lower(k), F.lit("_message"))
        ).otherwise("unparsed_fragment")
    )
    action = emit.get("action")
    made = null_of(SCHEMAS["action"])
    if action:
        part = lambda k, d: F.coalesce(_said(inner.value(action.get(k))), F.lit(d))
        made = struct_of(
            "action", kind=part("kind", "generic_tool"), tool_name=_said(inner.value(action.get("tool_name"))),
            tool_call_id=_said(inner.value(action.get("tool_call_id"))), arguments=F.lit("{}"),
            call_style=part("call_style", "unknown"), side_effect_level=F.lit("unknown"),
            metadata=empty("map<string,string>")
        )
    content = _blocks(inner.value(emit["content"])) if "content" in emit else empty(SCHEMAS["content"])
    return events_of(
        items.select(
            "rid", "record_id", F.lit(ep_pos).alias("ep_pos"), "episode_id", (
                F.lit(nth).cast("bigint") * (1 << 32) + F.col("item_i")
            ).alias("pos"),
            F.coalesce(
                text("event_id"), F.concat("record_id", F.lit("-evt-"), F.format_string("%04d", F.col("item_i")))
            ).alias("event_id"), idx.alias("idx"), kind.alias("event_type"),
            F.when(role.isin(*ENUMS["role"]), role).otherwise("unknown").alias("role"), content.alias("content"), made.alias("action"),
        )
    )


# -- tools for format authors ------------------------------------------------------------------


def probe(df: DataFrame) -> str:
    """The merged shape of rows: names and types, as Spark writes a VARIANT schema.  For a sample of rows."""
    return df.select(F.schema_of_variant_agg(F.try_parse_json("raw")).alias("s")).first()["s"]


def probe_tree(df: DataFrame, depth: int = 4) -> DataFrame:
    """``(path, kinds, n, most_items)``: every path down to ``depth``, the kinds of its values, how many there are, and the longest list.

    One level at a time: a level's objects and lists are exploded into the next one.
    """
    level = df.select(F.lit("$").alias("path"), F.try_parse_json("raw").alias("v")).where("v is not null")
    found = None
    for _ in range(depth):
        items = F.when(X.is_list(F.col("v")), F.size(X.items(F.col("v"))))
        kind = F.regexp_replace(F.schema_of_variant("v"), r"[<(].*", "")
        kinds = F.array_join(F.array_sort(F.collect_set(kind)), ",")
        shape = level.groupBy("path").agg(
            kinds.alias("kinds"), F.count("*").alias("n"), F.max(items).alias("most_items")
        )
        found = shape if found is None else found.unionByName(shape)
        step = "path || CASE WHEN key IS NULL THEN '[]' ELSE '.' || key END"
        level = df.sparkSession.sql(
            f"SELECT {step} AS path, value AS v FROM {{level}}, LATERAL variant_explode(v)", level=level
        )
    return found.orderBy("path")


def preview(t: Trajectories, n_events: int = 10, n_types: int = 5) -> DataFrame:
    """``(rid, n_events, first_types, types)``: the first event types and the distinct ones in order of appearance."""
    order = F.transform(
        F.array_sort(F.collect_list(F.struct("ep_pos", "pos", "event_type"))), lambda x: x["event_type"]
    )
    return t.events.groupBy("rid").agg(F.count("*").alias("n_events"), order.alias("o")).select(
        "rid", "n_events", F.array_join(F.slice("o", 1, n_events), ",").alias("first_types"),
        F.array_join(F.slice(F.array_distinct("o"), 1, n_types), ",").alias("types")
    )


def diff(a: Trajectories, b: Trajectories) -> DataFrame:
    """What two formats make of the same rows: event counts, and the types that only one has."""
    side = lambda t, s: t.events.groupBy("rid").agg(
        F.count("*").alias(f"n_{s}"), F.array_sort(F.collect_set("event_type")).alias(f"types_{s}")
    )
    both = side(a, "a").join(side(b, "b"), "rid", "full")
    none = F.array().cast("array<string>")
    only = lambda x, y: F.array_join(F.array_except(F.coalesce(x, none), F.coalesce(y, none)), ",")
    return both.select(
        "rid", F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"),
        only("types_a", "types_b").alias("only_a"), only("types_b", "types_a").alias("only_b")
    )


#: Shipped formats, one for each frontend, and templates to start from.
FORMATS = Path(__file__).parent / "formats"
TEMPLATES = Path(__file__).parent / "templates"


def new_spec(name: str, template: str = "chat") -> str:
    """A format to start from; templates are ``chat`` and ``calls``."""
    path = TEMPLATES / f"{template}.yaml"
    if not path.exists():
        raise ValueError(
            f"unknown template: {template}; known: {', '.join(sorted(p.stem for p in TEMPLATES.glob('*.yaml')))}"
        )
    return path.read_text().replace("NAME", name)


def shipped(name: str) -> dict[str, Any]:
    """A shipped format by the name of its file."""
    return load_spec(FORMATS / f"{name}.yaml")
