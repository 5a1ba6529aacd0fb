"""Mixing sources to target weights by entropy balancing.

Among all ways to weigh documents so that each source gives its target of words, entropy
balancing takes the one nearest to the equal weighting.  Its solution tilts exponentially:
a document of x times its source's mean size has the rate exp(lambda * x), at most the
cap; one lambda for each source solves the convex dual.  Newton iterations find it, each a
distributed sum over the table of (source, size, count), which holds the same sums as the
documents; a bracket with bisection guards the steps.

Rates become whole copies by systematic rounding along sizes: fractional rates are summed
up in order of size and a document gets the extra copy where the sum passes a whole number,
so the words of a source stay within about one document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import checkpointed, plain

#: A word, as in the contract; Java's notation.
WORD = r"[^\x20\x09-\x0D]+"
#: Sub-groups of the documents of one source and size, so that a hot one is many tasks.
SALTS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A key without nulls that keeps their order: code points, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sized: DataFrame, cycle: int = 3, cap: float = 3.0) -> DataFrame:
    """``(key, source_size, n_docs, mean, least, target)``, a row for each source of ``(key, size)``.

    Weights 1..cycle go round the sources in order of key and share all words.  A target stops
    at ``cap`` times its source's words; the excess goes to the others by weight until none is
    above.  In order of cap over weight the capped sources come first, so running sums find the
    final level; this table has one row for each source.
    """
    sums = sized.groupBy("key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    )
    in_order = Window.orderBy("key")
    weighed = sums.withColumn(
        "weight", ((F.row_number().over(in_order) - 1) % cycle + 1).cast("double")
    ).withColumn("most", cap * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("most") / F.col("weight")), "key")
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - before) / F.sum("weight").over(
        by_ratio.rowsBetween(0, Window.unboundedFollowing)
    )
    leveled = weighed.withColumn("level", level)
    final = F.min(
        F.when(
            F.col("level") * F.col("weight") <= F.col("most"),
            F.struct((F.col("most") / F.col("weight")).alias("r"), "key", "level")
        )
    ).over(everything)["level"]
    target = F.least("most", F.coalesce(final * F.col("weight"), F.col("most")))
    mean = F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9))
    return leveled.withColumn("target", target).select(
        "key", "source_size", "n_docs", mean.alias("mean"), "least", "target"
    )


def _rate(cap: float) -> Column:
    return F.when(F.col("tilt").isNull(), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    )


def tilts(cells: DataFrame, goals: DataFrame, cap: float = 3.0, tolerance: float = 1e-9, most: int = 60) -> DataFrame:
    """``goals`` with the column ``tilt`` that meets each target; null where every document is at the cap.

    Newton on the logarithm of the words taken; a step outside the bracket is a bisection.
    One row for each source is written between iterations, and the worst relative error is
    all that reaches the driver.
    """
    reach = F.log(F.lit(cap)) * F.col("mean") / F.col("least")
    ratio = F.col("target") / F.col("source_size")
    full = (F.col("source_size") == 0) | (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))
    state = goals.withColumn("tilt", F.when(full, F.lit(None).cast("double")).otherwise(F.log(ratio)))
    state = state.withColumn(
        "low", -(F.abs(F.log(ratio)) + 1) * F.col("mean") / F.col("least")
    ).withColumn("high", F.greatest(reach, F.lit(1.0)))
    state = checkpointed(state)
    for _ in range(most):
        x = F.col("size") / F.col("mean")
        rate, words = _rate(cap), F.col("size") * F.col("n")
        sums = cells.join(state.where("tilt is not null").select("key", "mean", "tilt"), "key").groupBy("key").agg(
            F.sum(words * rate).alias("got"), F.sum(F.when(rate < cap, words * rate * x).otherwise(0.0)).alias("slope")
        )
        new = state.join(sums, "key", "left")
        off = F.col("got") - F.col("target")
        new = new.withColumn("low", F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn(
            "high", F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        )
        step = F.col("tilt") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.when(
            F.col("slope") > 0, F.col("slope")
        )
        inside = step.between(F.col("low"), F.col("high"))
        new = new.withColumn("error", F.abs(off) / F.col("target"))
        new = new.withColumn(
            "tilt",
            F.when(
                F.col("tilt").isNull() | (F.col("error") <= tolerance), F.col("tilt")
            ).otherwise(F.when(inside, step).otherwise((F.col("low") + F.col("high")) / 2))
        )
        state = checkpointed(new.drop("got", "slope"))
        worst = state.agg(F.max("error")).first()[0]
        state = state.drop("error")
        if worst is None or worst <= tolerance:
            break
    else:
        raise RuntimeError(f"no convergence in {most} iterations: relative error {worst}")
    return state.drop("low", "high")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_copies(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", cycle: int = 3,
    cap: float = 3.0, keep: bool = False
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` = copies * size.

    ``keep`` carries all columns of the input in ``row`` (a struct); otherwise only doc_id.
    Null texts have size 0, null sources are one source (the last), documents of size 0 have
    the rate 1 and take no words.  No document exceeds ``cap`` copies.  Which of several rows
    of one source and size get the extra copy is settled by a hash of doc_id, so reruns agree;
    rows equal in all of these are interchangeable.
    """
    names = [
        F.col(doc_id).cast("bigint").alias("doc_id"), source_key(F.col(source)).alias("key"),
        word_count(F.col(text)).alias("size")
    ]
    sized = checkpointed(docs.select(*names).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")))
    parts = sized.groupBy("key", "size", "salt").agg(F.count("*").alias("m"))
    cells = checkpointed(sized.groupBy("key", "size").agg(F.count("*").alias("n")))
    goals = tilts(cells, targets(sized, cycle, cap), cap)
    rated = cells.join(goals, "key").withColumn("rate", _rate(cap)).withColumn(
        "whole", F.floor(F.col("rate") + 1e-9)
    ).withColumn(
        "part", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))
    )
    along = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    phase = F.pmod(F.xxhash64("key", F.lit("phase")), F.lit(1 << 20)) / (1 << 20)
    rated = rated.withColumn("start", phase + F.coalesce(F.sum(F.col("n") * F.col("part")).over(along), F.lit(0.0)))
    earlier = Window.partitionBy("key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("earlier", F.coalesce(F.sum("m").over(earlier), F.lit(0))).join(
        rated.select("key", "size", "whole", "part", "start", "source_size", "target"), ["key", "size"]
    )
    rows = docs.select(
        *names, F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row")
    ).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")) if keep else sized
    place = F.row_number().over(
        Window.partitionBy("key", "size", "salt").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    ) - 1
    ranked = rows.withColumn("place", place).join(parts, ["key", "size", "salt"])
    at = F.col("start") + (F.col("earlier") + F.col("place")) * F.col("part")
    copies = (F.col("whole") + F.floor(at + F.col("part")) - F.floor(at)).cast("int")
    return ranked.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"), "copies", *["row"] * keep
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the input's columns, each row as many times as it has copies."""
    rows = with_copies(docs, keep=True, **settings).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
