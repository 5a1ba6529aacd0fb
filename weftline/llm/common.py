"""Helpers that several corpus operators share."""

from __future__ import annotations

import os
import re
import tempfile
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Lower-cases A-Z and nothing else.
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it, unless they can already; a cluster ships it its own way."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in [*paths, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the decimal text of ``col``, modulo ``mod``."""
    return F.crc32(col.cast("string").cast("binary")) % mod


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder named in spark.checkpoint.dir (see ``shared_folder``)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where that is unset and the master is local, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="weftline-")


def drawn_rows(df: DataFrame, label: str, per_label: int, *identity: str, max_labels: int = 1000) -> DataFrame:
    """At least ``per_label`` rows of each non-null ``label`` (all of one that has no more), with their ``__ticket``.

    Tickets are a hash of the ``identity`` columns, so reruns draw the same rows; a label's count
    says up to which ticket rows are wanted.  Where rows that are equal in their identity, and so
    share a ticket, leave a label short, its share grows until enough are drawn.  Rows stay in
    their partitions, and only counts reach the driver.  More than ``max_labels`` labels are an
    error.
    """
    scale = 1 << 40
    ticket = F.pmod(F.xxhash64(F.lit(7), *identity), F.lit(scale))
    rows = df.where(F.col(label).isNotNull()).withColumn("__ticket", ticket)
    name = F.col(label).cast("string")

    def counted(of: DataFrame) -> dict[str, int]:
        found = of.groupBy(name.alias("name")).agg(F.count("*").alias("n")).limit(max_labels + 1).collect()
        return {r["name"]: r["n"] for r in found}

    sizes = counted(rows)
    if not sizes:
        return rows.where(F.lit(False))
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} values of {label}")
    wanted = per_label + 4 * int(per_label**0.5) + 16
    cuts = {k: min(scale, wanted * scale // n) for k, n in sizes.items()}
    while True:
        cut = F.create_map(*[F.lit(x) for k, c in cuts.items() for x in (k, c)])
        drawn = rows.where(F.col("__ticket") < cut[name])
        if all(c == scale for c in cuts.values()):
            return drawn
        got = counted(drawn)
        short = [k for k, n in sizes.items() if cuts[k] < scale and got.get(k, 0) < min(per_label, n)]
        if not short:
            return drawn
        cuts |= {k: min(scale, 8 * cuts[k]) for k in short}


def first_rows(df: DataFrame, label: str, per_label: int, *order: str) -> DataFrame:
    """The first ``per_label`` rows of each ``label``; every partition ranks its own and passes on no more than that."""
    place = F.row_number().over(Window.partitionBy(label).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= per_label).drop("__place")


def bounded_sample(df: DataFrame, label: str, per_label: int, *identity: str, max_labels: int = 1000) -> DataFrame:
    """At most ``per_label`` rows of each non-null ``label``, and all of a label that has no more.

    See ``drawn_rows``; here the rows of a label meet in one task, so this is for samples that
    a driver will hold.  Rows equal in their identity are interchangeable.  Neither a large
    table nor a row that is repeated often makes the result or a task large.
    """
    drawn = drawn_rows(df, label, per_label, *identity, max_labels=max_labels)
    return first_rows(drawn, label, per_label, "__ticket", *identity).drop("__ticket")


def join_hot(rows: DataFrame, facts: DataFrame, keys: list[str], spread: int = 100) -> DataFrame:
    """``rows`` inner-joined to ``facts``, which has one row for each value of ``keys``, with hot keys dealt over many tasks.

    A key is hot if it holds more than one in ``spread`` of all rows, so there are fewer than
    ``spread`` of them and their list is bounded; only their facts are repeated, ``spread`` times.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = rows.agg(F.count("*").alias("__all"))
    hot = counts.join(
        F.broadcast(total), F.col("__n") * spread > F.col("__all")
    ).select(*keys, F.lit(True).alias("__hot"))
    hot = F.broadcast(checkpointed(hot))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(spread)).cast("int")).otherwise(0)
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(hot, keys, "left").withColumn("__salt", salt).drop("__hot")
    right = facts.join(hot, keys, "left").withColumn("__salt", F.explode(salts)).drop("__hot")
    return left.join(right, [*keys, "__salt"]).drop("__salt")


def text_chunks(
    batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of ``batch`` with the texts of ``column`` (null as empty), each of about ``max_bytes`` unless one text is longer."""
    sizes = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(sizes), 0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > max_bytes:
            part = batch.slice(start, i - start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            start, held = i, 0
        held += int(n) + 64
    if start < batch.num_rows:
        part = batch.slice(start)
        yield part, [t or "" for t in part.column(column).to_pylist()]


def word_codes(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased words, the word number at each position of all texts, and each text's number of words."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    codes: list[int] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = WORD.findall(text.lower())
        lengths[i] = len(found)
        codes.extend(map(number.__getitem__, found))
    return list(number), np.array(codes, np.int64), lengths


def word_ngrams(words: list[str], sizes: tuple[int, ...], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the word number and hash bucket of every character n-gram of ``<word>``.  ``buckets`` is a power of two."""
    if not words:
        return
    joined = "<" + "><".join(words) + ">"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    for n in sizes:
        if len(points) < n:
            continue
        stop = len(points) - n + 1
        inside = owner[:stop] == owner[n - 1 :]
        mixed = np.full(stop, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            mixed = (mixed ^ points[k : stop + k]) * np.uint32(0x01000193)
            mixed ^= mixed >> np.uint32(15)
        mixed = mixed[inside] * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        yield owner[:stop][inside], (mixed & np.uint32(buckets - 1)).astype(np.int64)


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive segments; empty segments give 0."""
    out = np.zeros((len(lengths), *values.shape[1:]), values.dtype)
    filled = lengths > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[filled], axis=0)
    return out


def plain(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under names of our own, so that extra columns of the input can't clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])
