"""Near-duplicate documents by SimHash fingerprints and a byte-position inverted index.

A fingerprint has eight bytes.  Two fingerprints that differ in at most ``max_bits`` = 3 bits
agree in at least 5 of the 8 byte positions (the guaranteed minimum).  The index posts every
distinct fingerprint under (positions, bytes) for the 14 sets of four positions whose numbers
have the exclusive or 0.  Every three positions lie in one of these sets, and the other four
positions of such a set are a set, too; so whatever three positions differ, the pair meets
in the list of a set that has none of them.  Lists have keys of 32 bits, so chance meetings
stay rare up to billions of fingerprints.  Within a list the matching bytes of a pair are
tallied over all eight positions, pairs below the minimum go, and the rest are verified bit
by bit.

A list is walked from neighbour to neighbour: a member that has been reached leaves the list,
so a cluster of k fingerprints gives k - 1 links and not k * k.  The links of a list connect
just what all its pairs connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weftline.llm.common import ASCII_LOWER, WORD, checkpointed, plain, text_chunks
from weftline.llm.components import connected_components

#: The four-position sets of the index.
POSITIONS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
MAX_BITS = 3


def fingerprint(text: str | None, size: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text; 0 without words."""
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    size = min(size, len(words))
    parts = [w.encode("utf-8", "surrogatepass") for w in words]
    whole = memoryview(b" ".join(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[size - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], 42) for a, b in zip(starts[: len(ends)].tolist(), ends.tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) >> 14)):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row; fp is the fingerprint as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, "text"):
                found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return plain(
        docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text)
    ).mapInArrow(run, "doc_id bigint, fp bigint")


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the fingerprint of their text as a signed bigint ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, text):
                found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, "fp"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("fp", LongType())]))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _walk(values: np.ndarray, max_bits: int, min_bytes: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest over the values of one list (distinct, uint64)."""
    left = values
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            apart = left ^ at
            shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            near = np.flatnonzero(shared >= min_bytes)
            near = near[_popcount(apart[near]) <= max_bits]
            if len(near):
                for x in left[near]:
                    yield int(at), int(x)
                queue.extend(left[near])
                keep = np.ones(len(left), bool)
                keep[near] = False
                left = left[keep]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(u, v)`` that connect all distinct fingerprints ``fp`` within ``max_bits`` bits (at most 3) of each other."""
    if max_bits > MAX_BITS:
        raise ValueError("the byte-position index guarantees matches for at most 3 bits")
    min_bytes = 8 - max_bits
    keys = []
    for n, positions in enumerate(POSITIONS):
        mask = sum(0xFF << 8 * (7 - p) for p in positions)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bytes")))
    posted = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.n", "k.bytes", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(members: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
            found: list[tuple[int, int]] = []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a > 1:
                    found.extend(_walk(members[a:b].view(np.uint64), max_bits, min_bytes))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        held: list[np.ndarray] = []  # the list that may go on in the next batch: n, bytes, fp as columns
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("n", "bytes", "fp")], axis=1)
            if held and len(rows) and (
                rows[-1, :2] == held[-1][-1, :2]
            ).all() and (rows[0, :2] == held[-1][-1, :2]).all():
                held.append(rows)  # all of one list: joined only when it ends
                continue
            rows = np.concatenate([*held, rows])
            if not len(rows):
                continue
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)])
            held = [rows[starts[-1] :]]
            yield linked(np.ascontiguousarray(rows[:, 2]), starts)
        if held:
            rows = np.concatenate(held)
            yield linked(np.ascontiguousarray(rows[:, 2]), np.array([0, len(rows)]))

    return posted.repartition("n", "bytes").sortWithinPartitions("n", "bytes", "fp").mapInArrow(
        run, "u bigint, v bigint"
    )


def classes(of: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint of ``(doc_id, fp)``: root is the least fingerprint of its component, component_id the least doc_id, null if there is none."""
    distinct = of.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row.

    component_id is the least doc_id reachable by links of at most ``max_bits`` differing
    bits.  Null and empty texts have fingerprint zero and link like any other; equal texts
    share a fingerprint; a null doc_id is ordered after all others, so a component of null
    ids alone has a null component_id.  An empty table gives an empty result.
    """
    of = checkpointed(fingerprints(docs, doc_id, text))
    return of.join(classes(of, max_bits).select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
