"""Document quality: rule statistics, and an isolation forest over them.

Every tree of the forest splits a small random draw of its own at random values of random
statistics; a document that is parted from the others early, on short paths over all trees,
is an anomaly.  How many documents end in each leaf, and so how long its path is, is counted
over all documents.  The anomaly score above which a document goes is calibrated on all
labelled rows: it loses at most ``max_loss`` of the good ones.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import WORD, bounded_sample, checkpointed, plain, segment_sums, text_chunks

SYMBOLS = "#*$%&|<>"
_MARK = re.compile(r"[^\w\s]")
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]{2}")
#: A run of letters with two capitals side by side.
_UPPER = re.compile(r"[^\W\d_]*[A-ZÀ-ÖØ-Þ]{2}[^\W\d_]*")
#: Of ASCII, what str.split takes for white space and the contract does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_ALNUM = re.compile(r"[^\W_]")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "letterless", "distinct",
    "top_word", "line_length", "plain_words", "symbols_a_word",
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class _Letterless(dict):
    """Whether a word has no letter and no digit.  Kept for one call."""

    def __missing__(self, word: str) -> bool:
        self[word] = found = not word.isalnum() and _ALNUM.search(word) is None
        return found


def _count(text: str, chars: str) -> int:
    return sum(map(text.count, chars))


def _repeated(codes: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words in 3-word windows found twice or more in their text, for each text.

    codes number the words of every text from 0, sizes says how many numbers each text has.
    """
    text = np.repeat(np.arange(len(lengths)), lengths)
    if len(codes) < 3:
        return np.zeros(len(lengths), np.int64)
    inside = text[2:] == text[:-2]
    if (sizes.astype(float) ** 3).sum() < 2.0**62:
        cubes = sizes**3
        m = sizes[text[:-2]]
        window = (np.cumsum(cubes) - cubes)[text[:-2]] + (codes[:-2] * m + codes[1:-1]) * m + codes[2:]
    else:  # a text of millions of different words: number the pairs first
        most = int(sizes.max())
        pair = np.unique(codes[:-2] * most + codes[1:-1], return_inverse=True)[1]
        triple = np.unique(pair * most + codes[2:], return_inverse=True)[1]
        window = text[:-2] * (int(triple.max()) + 1) + triple
    window = window[inside]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(window), bool)
    twice[order] = np.r_[False, same] | np.r_[same, False]
    covered = np.zeros(len(codes), bool)
    at = np.flatnonzero(inside)[twice]
    for k in range(3):
        covered[at + k] = True
    return segment_sums(covered.astype(np.int64), lengths)


def statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The base counts (BASE) and the forest's features (FEATURES), a row for each text."""
    codes: list[int] = []
    lengths, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    direct = np.zeros((len(texts), 7))  # word characters, symbols, lines, duplicate lines, digits, marks, capitals
    distinct: list[str] = []
    for i, text in enumerate(texts):
        words = text.split() if text.isascii() and not _SEPARATORS.search(text) else WORD.findall(text)
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        codes.extend(map(number.__getitem__, words))
        distinct.extend(number)
        lengths[i], sizes[i] = len(words), len(number)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        direct[i] = (
            sum(map(len, words)), _count(text, SYMBOLS), len(lines), len(lines) - len(set(lines)),
            _count(text, "0123456789"), len(_MARK.findall(text)),
            len(_UPPER.findall(text)) if _CAPITALS.search(text) else 0,
        )
    at = np.array(codes, np.int64)
    chars, symbols, lines, duplicate, digits, marks, upper = direct.T
    repeated = _repeated(at, sizes, lengths)
    uses = np.bincount(at + np.repeat(np.cumsum(sizes) - sizes, lengths), minlength=len(distinct))
    letterless = np.fromiter(map(_Letterless().__getitem__, distinct), bool, len(distinct))
    top = np.zeros(len(texts))
    some = sizes > 0
    if some.any():
        top[some] = np.maximum.reduceat(uses, (np.cumsum(sizes) - sizes)[some])
    per_word, per_char = 1 / np.maximum(1, lengths), 1 / np.maximum(1, chars)
    base = np.stack([lengths, chars, symbols, duplicate, repeated], 1).astype(np.int64)
    features = [
        np.log1p(lengths),
        np.minimum(chars * per_word, 40.0),
        symbols * per_char,
        duplicate / np.maximum(1, lines),
        repeated * per_word,
        upper * per_word,
        digits * per_char,
        marks * per_char,
        segment_sums(uses * letterless, sizes) * per_word,
        sizes / np.maximum(1.0, lengths**0.8),
        top * per_word,
        np.log1p(lengths / np.maximum(1, lines)),
        segment_sums(uses * np.fromiter(map(str.isalpha, distinct), bool, len(distinct)), sizes) * per_word,
        np.minimum(symbols * per_word, 10.0),
    ]
    return base, np.stack(features, 1)


#: Fewer than 50 words, or more than half of them in repeated windows.
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search in a binary search tree of n; between whole n below 3 on straight lines."""
    n = np.asarray(n, float)
    grown = lambda n: 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n < 3, np.interp(n, [1, 2, 3], [0, 1, grown(3.0)]), grown(n))


@dataclass
class Forest:
    """Trees as arrays, one row for each tree; a leaf is its own child.  Path lengths include the mean below a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    level: np.ndarray
    depth: int
    size: int
    threshold: float = 1.0

    def leaves(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The leaf of a tree in which each row ends."""
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = np.where(
                x[rows, self.feature[tree][node]] < self.cut[tree][node], self.left[tree][node], self.right[tree][node]
            )
        return node

    def counts(self, x: np.ndarray) -> np.ndarray:
        """How many rows end in each leaf of each tree."""
        nodes = self.path.shape[1]
        return np.stack([np.bincount(self.leaves(t, x), minlength=nodes) for t in range(len(self.path))])

    def weigh(self, counts: np.ndarray) -> None:
        """Take path lengths from counts of all rows: a leaf with a share of them holds that share of a tree's ``size``."""
        every = counts.sum(1, keepdims=True)
        self.path = self.level + _average_path(counts * np.minimum(1.0, self.size / np.maximum(1, every)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The anomaly score, 0 to 1."""
        total = np.zeros(len(x))
        for t in range(len(self.feature)):
            total += self.path[t][self.leaves(t, x)]
        return 2.0 ** (-total / len(self.feature) / max(float(_average_path(np.array(self.size))), 1e-9))


TREES, TREE_ROWS = 200, 256


def grow(x: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = 17) -> Forest:
    """A forest over the rows of x, in random order: each tree takes the next ``size`` of them, or a draw where too few are left.

    With fewer than two rows every path has length 0.
    """
    rng = np.random.default_rng(seed)
    own = len(x) >= trees * size
    size = min(size, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))) + 2)
    grown = []
    for tree in range(trees):
        nodes: list[list[float]] = []  # feature, cut, left, right, path, level

        def build(rows: np.ndarray, level: int) -> int:
            me = len(nodes)
            nodes.append([0, 0.0, me, me, level + float(_average_path(np.array(len(rows)))), level])
            low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(1), np.zeros(1))
            varied = np.flatnonzero(high > low)
            if level < depth and len(varied):
                f = int(rng.choice(varied))
                cut = rng.uniform(low[f], high[f])
                below = rows[:, f] < cut
                nodes[me][:4] = [f, cut, build(rows[below], level + 1), build(rows[~below], level + 1)]
            return me

        rows = x[tree * size : (tree + 1) * size] if own else x[
            rng.choice(len(x), size, replace=False)
        ] if len(x) else x
        build(rows, 0)
        grown.append(nodes)
    most = max(map(len, grown))
    table = np.zeros((trees, most, 6))
    for t, nodes in enumerate(grown):
        table[t, : len(nodes)] = nodes
    return Forest(
        table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 2].astype(int), table[:, :, 3].astype(int),
        table[:, :, 4], table[:, :, 5], depth, max(size, 2)
    )


def _best_cut(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray, max_loss: float) -> float:
    """See ``calibrate``; good and bad count the rows whose score is between the cut before and each cut, itself included."""
    if not good.sum() or not bad.sum():
        return 1.0
    lost, found = 1 - np.cumsum(good) / good.sum(), 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(lost <= max_loss, found - 10 * lost, -np.inf)
    best = np.flatnonzero(gain == gain.max())
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def calibrate(forest: Forest, good: np.ndarray, bad: np.ndarray, max_loss: float = 0.01) -> float:
    """The threshold that best parts good from bad rows, a lost good one weighing ten missed bad ones, with at most ``max_loss`` of the good above it.

    Without good or bad rows nothing goes.
    """
    if not len(good) or not len(bad):
        return 1.0
    cuts, at = np.unique(np.concatenate([forest.score(good), forest.score(bad)]), return_inverse=True)
    return _best_cut(cuts, *(np.bincount(x, minlength=len(cuts)) for x in (at[: len(good)], at[len(good) :])), max_loss)


def measured(docs: DataFrame, forest: Forest | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts of every row with its ``features`` or, given a forest, what ``judged`` says of them.

    Null texts are empty.  Rows stay rows, repeated and null ids among them; an empty table
    gives an empty result.  A text of any length is measured whole, in arrays of a few numbers
    a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, "text"):
                base, features = statistics(texts)
                columns = [part.column("doc_id"), *[pa.array(c) for c in base.T.astype(np.int64)]]
                columns.append(pa.array(features.tolist(), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "features"])

    counts = ", ".join(f"{c} bigint" for c in BASE)
    rows = plain(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text))
    found = rows.mapInArrow(run, f"doc_id bigint, {counts}, features array<double>")
    return found if forest is None else judged(found, forest)


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))


def judged(measures: DataFrame, forest: Forest) -> DataFrame:
    """``base_failed``, ``kept`` and ``anomaly`` in place of the features that ``measured`` found."""
    shared = measures.sparkSession.sparkContext.broadcast(forest)
    counts = ", ".join(f"{c} bigint" for c in BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*map(batch.column, ["doc_id", *BASE]), pa.array(shared.value.score(_features(batch)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "anomaly"])

    found = measures.mapInArrow(run, f"doc_id bigint, {counts}, anomaly double")
    kept = ~F.expr(BASE_FAILED) & (F.col("anomaly") <= forest.threshold)
    return found.select("doc_id", *BASE, F.expr(BASE_FAILED).alias("base_failed"), kept.alias("kept"), "anomaly")


def _leaf_counts(measures: DataFrame, forest: Forest) -> np.ndarray:
    """How many of all rows end in each leaf of each tree; a task passes on one number for each leaf at most."""
    shared = measures.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(shared.value.path.shape, np.int64)
        for batch in batches:
            counts += shared.value.counts(_features(batch))
        tree, node = np.nonzero(counts)
        columns = [pa.array(x.astype(np.int64)) for x in (tree, node, counts[tree, node])]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "n"])

    found = measures.mapInArrow(run, "tree bigint, node bigint, n bigint")
    found = found.groupBy("tree", "node").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(forest.path.shape, np.int64)
    counts[found["tree"].to_numpy(), found["node"].to_numpy()] = found["n"].to_numpy()
    return counts


#: Thresholds are whole multiples of one in so many, or half-way between two that part the rows equally well.
GRID = 1 << 16


def learn(measures: DataFrame, labels: DataFrame, max_loss: float = 0.01) -> Forest:
    """Grow a forest on what ``measured`` found, count all documents in its leaves and calibrate it on all labelled ones.

    Split values come from a draw from all documents, TREE_ROWS of its own for every tree, as an
    isolation forest is defined: trees over larger shares of the documents hide the anomalies
    (see the README).  The counts in the leaves are those of all documents, the threshold is
    the best on the grid for all labelled rows.  TREES * TREE_ROWS rows of features, a number a leaf
    and 2 * GRID numbers reach the driver at most.  Documents that fail the base rules take no
    part.  Labels other than 0 and 1 and null ids are left out of the calibration.
    """
    usable = measures.where(f"not ({BASE_FAILED})")
    pool = usable.select("doc_id", "features", F.lit(1).alias("group"))
    pool = bounded_sample(pool, "group", TREES * TREE_ROWS, "doc_id", "features").collect()
    pool.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"], r["features"]))
    x = np.array([r["features"] for r in pool]).reshape(-1, len(FEATURES))
    forest = grow(x[np.random.default_rng(19).permutation(len(x))])
    if len(x):
        forest.weigh(_leaf_counts(usable.select("features"), forest))
    known = plain(labels, doc_id=F.col("doc_id").cast("bigint"), quality=F.col("quality").cast("int"))
    known = known.where("quality in (0, 1) and doc_id is not null").distinct()
    scored = judged(usable, forest).select("doc_id", F.ceil(F.col("anomaly") * GRID).cast("int").alias("cut"))
    found = scored.join(known, "doc_id").groupBy("quality", "cut").agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros((2, GRID + 1), np.int64)
    counts[found["quality"].to_numpy(), found["cut"].to_numpy()] = found["n"].to_numpy()
    forest.threshold = _best_cut(np.arange(GRID + 1) / GRID, counts[1], counts[0], max_loss)
    return forest


def train(docs: DataFrame, labels: DataFrame, max_loss: float = 0.01) -> Forest:
    """``learn`` from documents, whose measures are kept in ``spark.checkpoint.dir`` meanwhile."""
    return learn(checkpointed(measured(docs)), labels, max_loss)
