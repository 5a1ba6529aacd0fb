"""Command line: ``python -m weftline COMMAND``.

Runs in stages keep trajectories as Parquet folders between ``parse``, ``opt`` and
``lower``; ``compile`` is all three as one plan.  ``format`` has the tools for authors of
declarative formats.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from weftline.model import IR_VERSION


def _spark() -> SparkSession:
    spark = SparkSession.builder.appName("weftline").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="weftline", description=__doc__.split("\n")[0])
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, into=commands, **options) -> argparse.ArgumentParser:
        p = into.add_parser(name)
        for a in arguments:
            p.add_argument(a)
        for k, v in options.items():
            flag = "--" + k.replace("_", "-")
            p.add_argument(flag, action="store_true") if v is False else p.add_argument(
                flag, default=v, type=type(v) if v is not None else str
            )
        return p

    lowering = {"reasoning_policy": None, "include_reasoning": False, "tool_policy": "structured", "report": None}
    command("version")
    command("schema", out=None)
    command("detect", "source", limit=0)
    command(
        "compile", "source", "out", frontend="agenttrove", passes="default", target="openai-tools", limit=0, **lowering
    )
    command("parse", "source", "out", frontend="agenttrove", limit=0, quarantine=None)
    command("opt", "source", "out", passes="default")
    command("lower", "source", "out", target="openai-tools", **lowering)
    command("verify", "source", strict=False, report=None)
    command("stats", "source")
    formats = commands.add_parser("format").add_subparsers(dest="action", required=True)
    command("validate", "spec", into=formats)
    command("probe", "source", into=formats, limit=100, depth=4)
    command("preview", "spec", "source", into=formats, limit=5)
    command("convert", "spec", "source", "out", into=formats, limit=0)
    command("bench", "spec", "source", into=formats)
    command("diff", "spec", "other", "source", into=formats)
    command("init", "name", into=formats, template="chat")
    command("list", into=formats, folder=None)
    return top


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    if a.command == "version":
        print(IR_VERSION)
        return 0
    from weftline.operators import lowering, passes
    from weftline.plans import pipeline
    from weftline.sources import files, frontends, spec

    if a.command == "schema":
        text = json.dumps(pipeline.json_schema(), indent=2)
        print(text) if a.out is None else open(a.out, "w").write(text)
        return 0
    if a.command == "format" and a.action in ("validate", "init", "list"):
        if a.action == "init":
            print(spec.new_spec(a.name, a.template), end="")
        elif a.action == "list":
            print("\n".join(map(str, spec.find_specs(a.folder or str(spec.FORMATS)))))
        else:
            for code, severity, field, message in spec.problems(a.spec):
                print(f"{severity}[{code}]: {field}: {message}")
            return 0 if spec.is_valid(a.spec) else 1
        return 0
    spark = _spark()
    rows = lambda: files.read_rows(spark, a.source, getattr(a, "limit", 0) or None)
    names = lambda x: x if x in passes.GROUPS else x.split(",")
    context = lambda: lowering.Context(a.include_reasoning, a.reasoning_policy, a.tool_policy)

    def written(lowered: lowering.Lowered) -> None:
        files.write_rows(lowered.rows.select("output.*"), a.out, keep_nulls=True)
        counts = lowering.status_counts(lowered)
        if a.report:
            files.write_rows(lowered.losses, a.report, "jsonl")
        print(pipeline.markdown(counts, "lowering"), end="")

    if a.command == "detect":
        frontends.best_frontend(rows()).groupBy("frontend").count().show(truncate=False)
    elif a.command == "compile":
        written(pipeline.compile_rows(rows(), a.frontend, names(a.passes), a.target, context())[0])
    elif a.command == "parse":
        t, bad = frontends.convert(rows(), a.frontend)
        pipeline.save(t, a.out)
        if a.quarantine:
            files.write_rows(bad, a.quarantine, "jsonl")
        print(pipeline.markdown(files.quarantine_summary(bad), "quarantine"), end="")
    elif a.command == "opt":
        pipeline.save(passes.run_passes(pipeline.load(spark, a.source), names(a.passes)), a.out)
        print(pipeline.markdown(pipeline.diagnostic_counts(pipeline.load(spark, a.out)), "diagnostics"), end="")
    elif a.command == "lower":
        written(lowering.lower(pipeline.load(spark, a.source), a.target, context()))
    elif a.command == "verify":
        if "verify" not in passes.PASSES:
            return 3
        try:
            records = pipeline.load(spark, a.source)
        except AnalysisException:
            print(f"cannot be read: {a.source}", file=sys.stderr)
            return 2
        code, counts = pipeline.verification(records, a.strict)
        text = pipeline.markdown(counts, "verification")
        print(text, end="") if a.report is None else open(a.report, "w").write(text)
        return code
    elif a.command == "stats":
        print(pipeline.markdown(pipeline.statistics(pipeline.load(spark, a.source)), "statistics"), end="")
    elif a.action == "probe":
        print(spec.probe(rows()))
        spec.probe_tree(rows(), a.depth).show(1000, truncate=False)
        frontends.detection_scores(rows()).groupBy("frontend").avg("score").show(truncate=False)
    else:
        mine = spec.compile_spec(spec.load_spec(a.spec))
        t = mine.parse(rows())
        if a.action == "preview":
            spec.preview(t).show(truncate=False)
        elif a.action == "convert":
            pipeline.save(t, a.out)
        elif a.action == "diff":
            spec.diff(t, spec.compile_spec(spec.load_spec(a.other)).parse(rows())).show(truncate=False)
        else:
            frontends.register_frontend(mine)
            print(json.dumps(pipeline.throughput(rows(), mine.name)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
