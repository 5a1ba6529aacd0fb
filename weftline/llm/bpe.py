"""Byte-level BPE by a global shuffle of distinct words.

1. Texts are split into pre-tokens with positions.  A block of documents (a stretch of one
   input partition) keeps its distinct words in a dictionary and its texts as word numbers
   by position, so a word crosses the network once for each block and not for each use.
2. Dictionary parts are shuffled by word (``shard`` = crc32 of its bytes); a shard meets
   each of its words from all blocks in one task and encodes it once.
3. Token ids return to their block and are joined to the positions; documents are put
   together by position.  Decoding looks every id up in the token-byte table.

Word numbers are computed in a second scan rather than kept, as they outweigh all else that
is shuffled.  Both scans must cut the same blocks: they do for any input whose partitions
hold the same rows in the same order each time, such as files.  A block carries a checksum
of its dictionary and rows; where the scans differ the job fails and never mixes words up.  For
other inputs write or checkpoint() the table first.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import plain, text_chunks

#: White_Space of Unicode, which the public library's ``\s`` means; Python's would add U+001C to U+001F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _expanded(pattern: str, space: str, letters: str, numbers: str) -> str:
    """The pattern with its classes spelled out."""
    spelled = pattern.replace(
        r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]"
    ).replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return spelled.replace(r"[^\s", "[^" + space).replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")


@lru_cache
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that lists the matches of the pattern in a text.

    Texts within Latin-1 take the standard library's engine with the classes of that range
    spelled out, which gives the same matches in less time.
    """
    general = regex.compile(
        _expanded(pattern, SPACE, r"\p{L}", r"\p{N}").replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    ).findall
    chars = [chr(i) for i in range(256)]
    letters, numbers = ("".join(re.escape(c) for c in chars if regex.match(p, c)) for p in (r"\p{L}", r"\p{N}"))
    spaces = "".join(re.escape(c) for c in chars if regex.match(f"[{SPACE}]", c))
    try:
        narrow = re.compile(_expanded(pattern, spaces, letters, numbers)).findall
    except re.error:  # a pattern with more of the wider engine's notation
        return general

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general(text)
        return narrow(text)

    return split


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers below 2**32, as four compressed byte planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _batch(columns, **types: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


class _Block:
    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.size = self.n_docs = 0

    def add(self, doc_id: int | None, words: list[str], keep: bool) -> None:
        codes = np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words))
        self.size += len(words) + 8  # so that empty texts end a block, too
        self.n_docs += 1
        if keep:
            self.docs.append((doc_id, codes))


def _blocks(
    batches: Iterator[pa.RecordBatch], pattern: str, max_words: int, max_size: int, keep: bool
) -> Iterator[tuple[int, int, _Block]]:
    """(block id, dictionary checksum, block) of one input partition; both numbers and the cuts follow from what it holds."""
    split, block, ids = splitter(pattern), _Block(), xxhash.xxh64()

    def closed() -> tuple[int, int, _Block]:
        check = xxhash.xxh64()
        for word in block.number:
            check.update(word.encode("utf-8", "surrogatepass") + b"\xff")
        ids.update(check.digest())
        return ids.intdigest() >> 1, check.intdigest() >> 1, block

    for batch in batches:
        for part, texts in text_chunks(batch, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                block.add(doc_id, split(text), keep)
                ids.update(b"%d," % doc_id if doc_id is not None else b",")
                if len(block.number) >= max_words or block.size >= max_size:
                    yield closed()
                    block, ids = _Block(), xxhash.xxh64()
    if block.n_docs:
        yield closed()


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    output: str = "ids",
    shards: int | None = None,
    known_words: int = 1_000_000,
    block_words: int = 200_000,
    block_size: int = 6_000_000,
) -> DataFrame:
    """Token ids of every row's whole text (null as empty), without special tokens.

    ``output`` is ``ids`` for ``(doc_id, n_tokens, ids array<int>)``, ``digest`` for
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, ``both`` for all of these.  Rows stay
    rows: repeated and null doc_ids are kept apart.  A block ends at ``block_words`` distinct
    words or ``block_size`` pre-tokens, which bounds the memory of a task.  Words are dealt to
    ``shards`` (by default the session's shuffle partitions, 512 at least), each of which
    remembers at most ``known_words`` encoded words at a time.
    """
    spark = docs.sparkSession
    shards = shards or max(512, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(ranks)  # bounded by the vocabulary: some 50,000 tokens
    source = plain(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text))

    def dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, held in _blocks(batches, pattern, block_words, block_size, False):
            parts: defaultdict[int, list[tuple[bytes, int]]] = defaultdict(list)
            for word, code in held.number.items():
                raw = word.encode("utf-8", "surrogatepass")
                parts[zlib.crc32(raw) % shards].append((raw, code))
            rows = []
            for shard, own in parts.items():
                own.sort()
                lengths = np.fromiter((len(w) for w, _ in own), np.uint32, len(own))
                rows.append(
                    (
                        block, check, shard, _pack(np.array([c for _, c in own])), _pack(lengths),
                        zstandard.compress(b"".join(w for w, _ in own), 3)
                    )
                )
            rows = rows or [(block, check, 0, _pack(np.zeros(0)), _pack(np.zeros(0)), zstandard.compress(b"", 3))]
            yield _batch(
                zip(*rows), block=pa.int64(), check=pa.int64(), shard=pa.int32(), codes=pa.binary(),
                lengths=pa.binary(), words=pa.binary()
            )

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, check, held in _blocks(batches, pattern, block_words, block_size, True):
            start = 0
            while start < len(held.docs):
                end, size = start, 0
                while end < len(held.docs) and (
                    end == start or size + len(held.docs[end][1]) <= 1 << 16
                ) and end - start < 4096:
                    size += len(held.docs[end][1])
                    end += 1
                own, start = held.docs[start:end], end
                columns = [
                    [block], [check], [[d for d, _ in own]], [[len(c) for _, c in own]],
                    [_pack(np.concatenate([c for _, c in own]))]
                ]
                yield _batch(
                    columns, block=pa.int64(), check=pa.int64(), doc_ids=pa.list_(pa.int64()),
                    lengths=pa.list_(pa.int32()), codes=pa.binary()
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        shard, known = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, known = row["shard"], {}
                words, ends = zstandard.decompress(row["words"]), list(accumulate(_unpack(row["lengths"]).tolist()))
                ids = []
                for a, b in zip([0, *ends], ends):
                    word = words[a:b]
                    if word not in known:
                        if len(known) >= known_words:
                            known.clear()  # forgotten words are encoded again
                        known[word] = engine.encode_ordinary(word.decode("utf-8", "surrogatepass"))
                    ids.append(known[word])
                out.append(
                    (
                        row["block"], row["check"], row["codes"],
                        _pack(np.fromiter(map(len, ids), np.uint32, len(ids))),
                        _pack(np.array([i for x in ids for i in x], np.uint32))
                    )
                )
            if out:
                yield _batch(
                    zip(*out), block=pa.int64(), check=pa.int64(), codes=pa.binary(), counts=pa.binary(),
                    ids=pa.binary()
                )

    def reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b""] * (max(shared.value.values(), default=-1) + 1)
        for token, rank in shared.value.items():
            table[rank] = token
        at = None
        parts: list[dict] = []
        words: _Words | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at:
                    at, parts, words = row["block"], [], None
                if row["kind"] == 0:
                    parts.append(row)
                    continue
                if words is None:
                    words, parts = _Words(parts, table, output), []
                if row["check"] != words.check:
                    raise RuntimeError(f"block {at} differs between two scans: write the input to a table first")
                codes = _unpack(row["codes"])
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                yield words.batch(row["doc_ids"], np.split(codes, ends[:-1]))

    dictionary = source.mapInArrow(
        dictionaries, "block bigint, check bigint, shard int, codes binary, lengths binary, words binary"
    )
    ids = dictionary.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        encoded, "block bigint, check bigint, codes binary, counts binary, ids binary"
    )
    texts = source.mapInArrow(
        positions, "block bigint, check bigint, doc_ids array<bigint>, lengths array<int>, codes binary"
    )
    both = ids.select(
        "block", F.lit(0).alias("kind"), "check", "codes", "counts", "ids",
        F.lit(None).cast("array<bigint>").alias("doc_ids"), F.lit(None).cast("array<int>").alias("lengths")
    ).unionByName(
        texts.select(
            "block", F.lit(1).alias("kind"), "check", "codes", F.lit(None).cast("binary").alias("counts"),
            F.lit(None).cast("binary").alias("ids"), "doc_ids", "lengths"
        )
    )
    schema = "doc_id bigint, n_tokens bigint" + ", ids array<int>" * (output != "digest") + ", ids_sha256 string, decoded_sha256 string" * (output != "ids")
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(reassembled, schema)


class _Words:
    """The dictionary of a block with the token ids of its words."""

    def __init__(self, parts: list[dict], table: list[bytes], output: str):
        if not parts or len({p["check"] for p in parts}) != 1:
            raise RuntimeError("a block's dictionary is missing or mixed: write the input to a table first")
        self.check, self.output = parts[0]["check"], output
        codes, counts, ids = (np.concatenate([_unpack(p[k]) for p in parts]) for k in ("codes", "counts", "ids"))
        self.counts = np.zeros(len(codes), np.int64)
        self.counts[codes] = counts
        starts = np.zeros(len(codes), np.int64)
        starts[codes] = np.cumsum(counts) - counts
        self.starts, self.ids = starts, ids
        if output != "ids":
            text = list(map(b"%d".__mod__, ids.tolist()))
            raw = list(map(table.__getitem__, ids.tolist()))
            spans = list(zip(starts.tolist(), (starts + self.counts).tolist()))
            self.decimal = [b" ".join(text[a:b]) for a, b in spans]
            self.decoded = [b"".join(raw[a:b]) for a, b in spans]

    def batch(self, doc_ids: list[int | None], docs: list[np.ndarray]) -> pa.RecordBatch:
        columns = {
            "doc_id": pa.array(doc_ids, pa.int64()),
            "n_tokens": pa.array([int(self.counts[c].sum()) for c in docs], pa.int64())
        }
        if self.output != "digest":
            columns["ids"] = pa.array([self._ids(c) for c in docs], pa.list_(pa.int32()))
        if self.output != "ids":
            columns["ids_sha256"] = pa.array(
                [hashlib.sha256(b" ".join(map(self.decimal.__getitem__, c.tolist()))).hexdigest() for c in docs]
            )
            columns["decoded_sha256"] = pa.array(
                [hashlib.sha256(b"".join(map(self.decoded.__getitem__, c.tolist()))).hexdigest() for c in docs]
            )
        return pa.RecordBatch.from_pydict(columns)

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        counts = self.counts[codes]
        first = np.repeat(self.starts[codes] - (np.cumsum(counts) - counts), counts)
        return self.ids[first + np.arange(len(first))].astype(np.int32)


def decode(tokens: DataFrame, ranks: dict[bytes, int], doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, bytes binary)`` of every row: its ids joined to the token-byte table, in order.  Null ids give no bytes; an id outside the table fails."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            found = [b"".join(map(table.__getitem__, x or ())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"]
            )

    return plain(
        tokens, doc_id=F.col(doc_id).cast("bigint"), ids=F.col(ids)
    ).mapInArrow(run, "doc_id bigint, bytes binary")

