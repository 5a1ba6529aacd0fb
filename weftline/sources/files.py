"""Readers and writers of raw rows: JSON lines, JSON, Parquet.

Rows are ``(rid, raw)``: the index of the row, from 0 without gaps, and its JSON text.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.model import checkpointed, null_of


def numbered(df: DataFrame, order: list[str | Column] | None = None) -> DataFrame:
    """With ``rid`` from 0 without gaps, in the given order, else in that of the input's partitions.

    Every partition counts its rows, and a running sum over the partitions, one row for each,
    gives where each begins: no task sees more than its own rows.  An order is a range
    exchange, whose cuts are estimates, so its result is written to the checkpoint folder
    before it is counted.  Without an order the input is read twice and must give the same
    partitions both times, as files do.
    """
    if order:
        keys = [F.col(c) if isinstance(c, str) else c for c in order]
        df = checkpointed(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    rows = df.withColumn("__part", F.spark_partition_id())
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    # the id counts up from 0 in the low 33 bits of every partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.withColumn("__place", place).join(F.broadcast(starts), "__part")
    return placed.withColumn("rid", F.col("__start") + F.col("__place")).drop("__part", "__start", "__place")


def read_jsonl(spark: SparkSession, path: str | list[str], limit: int | None = None, strict: bool = False) -> DataFrame:
    """Non-blank lines as rows; malformed ones fail the job if ``strict``, else they keep their text for quarantine."""
    lines = spark.read.text(path).select(X.strip(F.col("value")).alias("raw")).where("raw <> ''")
    if limit is not None:
        lines = lines.limit(limit)
    if strict:
        lines = lines.select(F.when(F.parse_json("raw").isNotNull(), F.col("raw")).alias("raw"))
    return numbered(lines).select("rid", "raw")


def _is_lines(spark: SparkSession, path: str) -> bool:
    """Whether the file goes on after a first line that is an object of its own; two flags reach the driver."""
    line = X.strip(F.col("value"))
    first = spark.read.text(path).where(line != "").select(
        X.is_object(F.try_parse_json(line)).alias("whole")
    ).limit(2).collect()
    return len(first) == 2 and first[0]["whole"]


def read_json(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A JSON array gives its elements, an object one row, anything else is read as lines; malformed lines and other values are left out.

    A file of lines is split like any text; only an array or object that spans lines, one
    value by nature, is read whole in one task.
    """
    parsed = F.try_parse_json("value")
    if _is_lines(spark, path):
        rows = spark.read.text(path).select(parsed.alias("v"))
    else:
        whole = spark.read.text(path, wholetext=True).select(F.col("value"), parsed.alias("v"))
        lines = F.transform(F.filter(F.split("value", "\n"), lambda x: ~X.is_blank(x)), lambda x: F.try_parse_json(x))
        parts = F.when(X.is_list(F.col("v")), X.items(F.col("v"))).when(X.is_object(F.col("v")), F.array("v"))
        rows = whole.select(F.explode(F.coalesce(parts, lines)).alias("v"))
    rows = rows.where(X.is_object(F.col("v"))).select(F.to_json("v").alias("raw"))
    return numbered(rows if limit is None else rows.limit(limit)).select("rid", "raw")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Parquet rows as JSON text of the chosen columns (pruned at the scan)."""
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    df = df if limit is None else df.limit(limit)
    return numbered(df.select(F.to_json(F.struct("*")).alias("raw"))).select("rid", "raw")


def read_rows(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """By suffix: .parquet, .json, else JSON lines.  An export of a remote dataset is read the same way."""
    suffix = Path(path.rstrip("/")).suffix
    return read_table(spark, path, limit=limit) if suffix == ".parquet" else read_json(spark, path, limit) if suffix == ".json" else read_jsonl(spark, path, limit)


def batches(df: DataFrame, size: int = 256) -> DataFrame:
    """``(batch_index, start_row, end_row, n_rows)`` of rows numbered densely; end_row is exclusive."""
    return df.groupBy(F.floor(F.col("rid") / size).alias("batch_index")).agg(
        F.min("rid").alias("start_row"), (F.max("rid") + 1).alias("end_row"), F.count("*").alias("n_rows")
    )


def file_format(path: str, explicit: str | None = None) -> str:
    return explicit or ("parquet" if path.endswith(".parquet") else "jsonl")


def write_rows(
    df: DataFrame, path: str, explicit: str | None = None, append: bool = False, keep_nulls: bool = False, row_group_bytes: int | None = None
) -> int:
    """Rows as JSON lines or Parquet; how many, counted on the way.

    Keys with null are left out of JSON unless ``keep_nulls``.  An empty table gives a file of
    no rows.  ``row_group_bytes`` is for Parquet.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer_mode = "append" if append else "overwrite"
    if file_format(path, explicit) == "parquet":
        writer = counted.write.mode(writer_mode)
        (writer.option("parquet.block.size", row_group_bytes) if row_group_bytes else writer).parquet(path)
    else:
        options = {"ignoreNullFields": str(not keep_nulls).lower()}
        counted.select(F.to_json(F.struct("*"), options).alias("value")).write.mode(writer_mode).text(path)
    return seen.get["n"]


def quarantine_summary(side: DataFrame) -> DataFrame:
    return side.groupBy("stage").agg(F.count("*").alias("n"))


def no_quarantine(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(
        F.col("id").alias("row_index"), null_of("string").alias("record_id"), null_of("string").alias("error"),
        null_of("string").alias("raw_data"), null_of("string").alias("stage")
    )
