"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes, gives every vector the string of its signs, and sorts
the vectors of a label by that string: a short angle makes a long common prefix likely.
Vectors are compared with their next ``window`` neighbours only, the cosine is computed in
double precision, and pairs at or above the threshold are united across passes.  Exact
copies are one vector in the passes, and the first vectors of runs with one sign string are
also compared among themselves, so neither fills the window of what lies beside it.

Two vectors at the threshold share the prefix that singles out a window among the n vectors
of a label with probability q = (1 - angle / pi) ** log2(n / window).  A label gets as many
passes as bring 1 - (1 - q) ** passes to ``recall``; they grow about as n ** 0.18.  This holds
for vectors spread evenly over the sphere; labels crowded around few places find less.

The sorted rows are cut into partitions by their bytes.  What lies within a window of a cut
is compared in a second, small pass over the cuts, so cuts part no pair.

The window bounds candidates, not links.  Links inside a united class are completed exactly:
members within half the threshold angle of the class's centre are all linked to each other
(the triangle inequality for angles), so they are counted and not compared; every other
member is compared with the whole class, block by block on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import checkpointed, join_hot, plain
from weftline.llm.components import connected_components


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, label, unit)`` of the rows that can link, with the vector at length 1; unit is null for all others.

    Null or zero vectors, null or non-finite components and null labels can't link.  The
    label carries the number of components, as only vectors of one length are compared.
    """
    v = F.col(embedding).cast("array<double>")
    rows = plain(vectors, vec_id=F.col(vec_id).cast("bigint"), label=F.col(label).cast("string"), v=v)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    largest = F.array_max(F.transform("v", F.abs))
    able = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & finite & (largest > 0), F.lit(False))
    # divided by the largest first: squares of any finite vector stay finite
    rows = rows.select(
        "vec_id", F.concat_ws(":", F.size("v"), "label").alias("label"), F.when(able, F.col("v")).alias("v"),
        F.when(able, largest).alias("m")
    )
    rows = rows.select("vec_id", "label", F.transform("v", lambda x: x / F.col("m")).alias("s"))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    return rows.select("vec_id", "label", "s", norm.alias("norm")).select(
        "vec_id", "label", F.transform("s", lambda x: x / F.col("norm")).alias("unit")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def with_passes(reps: DataFrame, threshold: float, recall: float, passes: int, window: int) -> DataFrame:
    """``reps`` with the number of passes that their label's size asks for (see above), ``passes`` at least."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    q = F.pow(F.lit(agree), F.greatest(F.lit(0.0), F.log2(F.col("size") / F.lit(float(window)))))
    q = F.least(F.greatest(q, F.lit(1e-9)), F.lit(1 - 1e-9))
    needed = F.ceil(F.lit(math.log(1 - recall)) / F.log(1 - q)).cast("int")
    sizes = reps.groupBy("label").agg(F.count("*").alias("size"))
    return reps.join(sizes.select("label", F.greatest(F.lit(passes), needed).alias("passes")), "label")


class _Window:
    """Rows in sorted order, batch after batch: pairs within the window, and what the next batch may still pair with."""

    def __init__(self, threshold: float, window: int):
        self.threshold, self.window = threshold, window
        self.held: pa.RecordBatch | None = None

    def pairs(self, new: pa.RecordBatch) -> np.ndarray:
        rows = new if self.held is None else pa.Table.from_batches([self.held, new]).combine_chunks().to_batches()[0]
        first_new = rows.num_rows - new.num_rows
        group = np.array(
            [f"{p}:{x}" for p, x in zip(rows.column("pass").to_pylist(), rows.column("label").to_pylist())]
        )
        nodes, found = np.asarray(rows.column("node")), [np.zeros((0, 2), np.int64)]
        starts = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)]
        for d, end in zip(starts[:-1], starts[1:]):
            own, x = nodes[d:end], _matrix(rows.slice(d, end - d).column("unit"))
            for step in range(1, min(self.window, len(own) - 1) + 1):
                start = max(0, first_new - d - step)  # pairs of two held rows were seen before
                cosine = np.einsum("ij,ij->i", x[start : len(own) - step], x[start + step :])
                linked = start + np.flatnonzero(cosine >= self.threshold)
                found.append(np.stack([own[linked], own[linked + step]], 1))
        self.held = rows.slice(max(0, rows.num_rows - self.window))
        return np.sort(np.concatenate(found), axis=1)


class _Sorted:
    """All rows and, apart from them, the first rows of runs with one sign string."""

    def __init__(self, threshold: float, window: int):
        self.all, self.heads = _Window(threshold, window), _Window(threshold, window)
        self.last = None
        self.apart = False  # whether a run has made the two differ

    def pairs(self, batch: pa.RecordBatch) -> tuple[np.ndarray, pa.RecordBatch]:
        """Pairs of a batch with itself and what came before, and the batch's heads."""
        runs = [self.last, *zip(*(batch.column(c).to_pylist() for c in ("pass", "label", "key")))]
        heads = batch.filter(pa.array([a != b for a, b in zip(runs[:-1], runs[1:])], pa.bool_()))
        self.last = runs[-1]
        self.apart |= heads.num_rows < batch.num_rows
        if not self.apart:
            found, self.heads.held = self.all.pairs(batch), self.all.held
            return found, heads
        found = self.all.pairs(batch)
        return np.concatenate([found, self.heads.pairs(heads)]) if heads.num_rows else found, heads


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, size):
            yield whole.slice(at, size)


def candidate_links(
    reps: DataFrame, threshold: float, window: int, bits: int, seed: int, partition_bytes: int = 32 << 20
) -> DataFrame:
    """Verified pairs ``(u, v)``, u < v, of ``(node, label, unit, passes)``.

    Partitions hold about ``partition_bytes`` of vectors.  Only where one holds fewer rows
    than the window (a bad estimate of the cuts) are pairs across it left to the other passes.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in _slices(batches, 2048):
            dims = np.asarray(pc.list_value_length(batch.column("unit")))
            for d in np.unique(dims):
                part, p = batch.filter(pa.array(dims == d)), 0
                while part.num_rows:
                    if (d, p) not in planes:
                        planes[d, p] = np.random.default_rng([seed, int(d), p]).normal(size=(int(d), bits))
                    keys = np.packbits(_matrix(part.column("unit")) @ planes[d, p] > 0, axis=1)
                    key = pa.array([k.tobytes() for k in keys], pa.binary())
                    number = pa.array(np.full(part.num_rows, p, np.int32))
                    columns = [number, part.column("label"), key, part.column("node"), part.column("unit")]
                    yield pa.RecordBatch.from_arrays(columns, ["pass", "label", "key", "node", "unit"])
                    p += 1
                    part = part.filter(pc.greater(part.column("passes"), p))

    names = ["u", "v", "cut", "side", "pass", "label", "key", "node", "unit"]
    kinds = [
        pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int64(),
        pa.list_(pa.float64())
    ]

    def linked(pairs: np.ndarray) -> pa.RecordBatch:
        rest = [pa.nulls(len(pairs), k) for k in kinds[2:]]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *rest], names)

    def at_cut(rows: pa.Table, cut: int, side: int) -> pa.RecordBatch:
        n = rows.num_rows
        place = [pa.array(np.full(n, x, np.int32)) for x in (cut, side)]
        columns = [c.combine_chunks() for c in rows.select(["pass", "label", "key", "node", "unit"]).columns]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays([*(pa.nulls(n, pa.int64()) for _ in "uv"), *place, *columns], names)

    def union(*parts: pa.RecordBatch | None) -> pa.Table:
        """Rows of the parts in order of node within sign string, each once."""
        rows = pa.Table.from_batches([p for p in parts if p is not None])
        order = rows.sort_by([(c, "ascending") for c in ("pass", "label", "key", "node")])
        keys = list(zip(order.column("pass").to_pylist(), order.column("node").to_pylist()))
        return order.take([i for i, k in enumerate(keys) if not i or k != keys[i - 1]])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me, state = TaskContext.get().partitionId(), _Sorted(threshold, window)
        first: list[pa.RecordBatch] = []
        first_heads: list[pa.RecordBatch] = []
        for batch in _slices(batches, 4096):
            pairs, heads = state.pairs(batch)
            for kept, rows in ((first, batch), (first_heads, heads)):
                have = sum(x.num_rows for x in kept)
                if have < window and rows.num_rows:
                    kept.append(rows.slice(0, window - have))
            yield linked(pairs)
        if first:
            yield at_cut(union(*first, *first_heads), me - 1, 1)
            yield at_cut(union(state.all.held, state.heads.held), me, 0)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, state = None, _Sorted(threshold, window)
        for batch in batches:
            cuts = np.asarray(batch.column("cut"))
            starts = np.r_[0, np.flatnonzero(cuts[1:] != cuts[:-1]) + 1, len(cuts)] if len(cuts) else []
            for a, b in zip(starts[:-1], starts[1:]):
                if cuts[a] != cut:
                    cut, state = cuts[a], _Sorted(threshold, window)
                pairs, _ = state.pairs(batch.slice(int(a), int(b - a)))
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    size = reps.agg(F.sum(F.size("unit").cast("bigint") * 8 * F.col("passes"))).first()[0] or 0
    order = ["pass", "label", "key", "node"]
    rows = reps.select("node", "label", "unit", "passes").mapInArrow(
        hashed, "pass int, label string, key binary, node bigint, unit array<double>"
    )
    ordered = rows.repartitionByRange(-(-size // partition_bytes) or 1, *order).sortWithinPartitions(*order)
    schema = "u bigint, v bigint, cut int, side int, pass int, label string, key binary, node bigint, unit array<double>"
    found = checkpointed(ordered.mapInArrow(compared, schema))
    edges = found.where("cut is not null").select("cut", "side", *order, "unit")
    edges = edges.repartition("cut").sortWithinPartitions("cut", "side", *order).mapInArrow(
        across, "u bigint, v bigint"
    )
    return found.where("u is not null").select("u", "v").union(edges).distinct()


def count_links(members: DataFrame, threshold: float, block: int = 1024) -> DataFrame:
    """``(node, n_links)``: the exact number of links of each member inside its class.

    Members are ``(root, node, unit, copies)``, each standing for so many equal vectors.  A
    task holds two blocks at a time, whatever the size of the class.
    """
    centre = members.select("root", F.posexplode("unit")).groupBy("root", "pos").agg(F.sum("col").alias("s"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "s")))  # as many as a vector has components
    centre = centre.groupBy("root").agg(F.transform(in_order, lambda x: x["s"]).alias("c"))
    norm = F.sqrt(F.aggregate("c", F.lit(0.0), lambda a, x: a + x * x))
    cosine = F.aggregate(F.zip_with("unit", "c", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) / norm
    core = F.coalesce(cosine >= math.cos(math.acos(threshold) / 2 - 1e-9), F.lit(False))
    placed = checkpointed(
        join_hot(members, centre, ["root"]).select("root", "node", "unit", "copies", core.alias("core"))
    )
    sums = [
        F.count("*").alias("n"), F.count_if("core").alias("n_core"),
        F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies")
    ]
    sized = checkpointed(join_hot(placed, placed.groupBy("root").agg(*sums), ["root"]))
    near = sized.where("core").select("node", (F.col("core_copies") - 1).alias("n"))
    # the classes with members outside the core: those against all, block by block
    blocks = lambda n: F.ceil(n / block).cast("int")
    mixed = sized.where("n_core < n").select(
        "root", "node", "core", "unit", "copies", blocks(F.col("n")).alias("of"),
        blocks(F.col("n") - F.col("n_core")).alias("asking")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["node", "core", "unit", "copies"]
    sides = mixed.select(
        "root", number("of").alias("block"), every("asking").alias("ask_block"), F.lit(1).alias("asks"), *columns
    ).union(
        mixed.where("not core").select(
            "root", every("of").alias("block"), number("asking").alias("ask_block"), F.lit(0).alias("asks"), *columns
        )
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(rows: pa.Table) -> pa.RecordBatch:
            asks = np.asarray(rows.column("asks")) == 0
            ids, core = np.asarray(rows.column("node")), np.asarray(rows.column("core"))
            x = _matrix(rows.column("unit").combine_chunks())
            a, b = x[asks], x[~asks]
            copies = np.asarray(rows.column("copies")).astype(np.float64)
            ask_n, has_n = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for at in range(0, len(a), 512):
                own = ids[asks][at : at + 512, None] == ids[~asks][None, :]
                linked = ((a[at : at + 512] @ b.T >= threshold) | own).astype(np.float64)
                ask_n[at : at + 512] = (linked @ copies[~asks]).astype(np.int64) - own.sum(1)
                has_n += (copies[asks][at : at + 512] @ linked).astype(np.int64)
            has_n[~core[~asks]] = 0  # they ask themselves
            columns = [np.concatenate([ids[asks], ids[~asks]]), np.concatenate([ask_n, has_n])]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "n"])

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches(([] if held is None else held.to_batches()) + [batch])
            key = np.stack([np.asarray(rows.column(c)) for c in ("root", "block", "ask_block")], 1)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            for a, b in zip(starts[:-1], starts[1:]):
                yield counted(rows.slice(int(a), int(b - a)))
            held = rows.slice(int(starts[-1]))
        if held is not None:
            yield counted(held)

    keys = ["root", "block", "ask_block"]
    rest = sides.repartition(*keys).sortWithinPartitions(*keys, "asks", "node").mapInArrow(
        compared, "node bigint, n bigint"
    )
    return near.union(rest).groupBy("node").agg(F.sum("n").alias("n_links"))


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    passes: int = 12,
    window: int = 16,
    bits: int = 64,
    seed: int = 5,
    recall: float = 0.99,
    partition_bytes: int = 32 << 20,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Every row is a vector: rows that share a vec_id are compared one by one, equal ones are
    linked.  Only vectors with one label and one length are compared.  What can't link (see
    ``usable``) has no links and is its own component.  A component's id is the least vec_id
    in it, null if it has none; kept where that is the row's own vec_id (or both are null).
    An empty table gives an empty result.  ``passes`` is the least number of passes; large
    labels get more, for ``recall`` of the pairs at the threshold.
    """
    rows = checkpointed(usable(vectors, vec_id, embedding, label))
    able = rows.where("unit is not null")
    reps = able.groupBy("label", "unit").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # numbered on files, so that a task that runs again gives the same numbers
    reps = checkpointed(checkpointed(reps).withColumn("node", F.monotonically_increasing_id()))
    links = candidate_links(
        with_passes(reps, threshold, recall, passes, window), threshold, window, bits, seed, partition_bytes
    )
    roots = checkpointed(connected_components(links))
    members = roots.join(reps, "node").select("root", "node", "unit", "copies", "least")
    counts = count_links(members.drop("least"), threshold)
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    of = checkpointed(
        join_hot(members.select("root", "node"), least, ["root"]).select("node", "component_id").join(counts, "node")
    )
    answer = reps.join(of, "node", "left").select(
        "label", "unit", "copies", "least", F.coalesce("n_links", F.col("copies") - 1).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    answer = checkpointed(answer)
    single = answer.where("copies = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id")
    repeated = answer.where("copies > 1").select("label", "unit", "n_links", "component_id")
    several = join_hot(able, repeated, ["label", "unit"]).select("vec_id", "n_links", "component_id")
    apart = rows.where("unit is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return single.union(several).union(apart).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
