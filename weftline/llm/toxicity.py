"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

Every word is the mean of the embeddings of its character n-grams, so a misspelled or
inflected word that training never saw shares most vectors with the ones it saw.  Embeddings
and softmax are trained jointly by Adam in numpy, on the driver, on a bounded sample of
labelled rows.

Training starts from evidence: the first component of an n-gram's embedding is the part of
its log odds (documents with it among toxic and other ones) beyond ``surety`` standard
errors, the rest is small noise.  N-grams without such evidence keep the vector 0, so the
floor follows from the sample and not from a fixed count.

A document's score is that of its most toxic passage of ``passage`` words: an average over
thousands of words would drown a few insults.  Each round of training takes the passage of
every toxic document that the round before scores highest, and of the others their three
highest and every seventh.  A quarter of the sample is set aside to place the threshold: its
best parting becomes the score 0.7.  A word that is repeated in a row counts once.

Sizes of n-grams, passage and surety were chosen by cross-validation within the rows that
training may see, never on held-out ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import bounded_sample, crc_mod, plain, segment_sums, text_chunks, word_ngrams
from weftline.llm.common import word_codes as all_word_codes

SIZES = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """``per_label`` rows of each label, of up to ``max_chars`` characters each, are what the driver receives at most."""

    buckets: int = 1 << 18
    dims: int = 4
    passage: int = 36
    per_label: int = 1300
    max_chars: int = 100_000
    epochs: tuple[int, ...] = (4,)
    surety: float = 2.0
    seed: int = 11


@dataclass
class Model:
    """For scoring, embeddings and softmax fold into one logit per n-gram bucket."""

    weights: np.ndarray
    bias: float
    settings: Settings

    def word_logits(self, words: list[str]) -> np.ndarray:
        total, count = np.zeros(len(words)), np.zeros(len(words))
        for owner, bucket in word_ngrams(words, SIZES, self.settings.buckets):
            total += np.bincount(owner, self.weights[bucket], len(words))
            count += np.bincount(owner, minlength=len(words))
        return total / np.maximum(count, 1)

    def passages(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The logit of every passage (half-overlapping), and the number of passages of each text (1 at least)."""
        words, codes, lengths = word_codes(texts)
        logits = self.word_logits(words)[codes] if len(codes) else np.zeros(0)
        return _passage_means(
            logits, lengths, self.settings.passage
        ) + self.bias, _passage_counts(lengths, self.settings.passage)

    def score(self, texts: list[str]) -> np.ndarray:
        logits, counts = self.passages(texts)
        most = np.maximum.reduceat(logits, np.cumsum(counts) - counts) if len(counts) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(most, -60, 60)))


def word_codes(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """As in common, but a run of one word in a text counts once."""
    words, codes, lengths = all_word_codes(texts)
    if not len(codes):
        return words, codes, lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    new = np.r_[True, (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])]
    return words, codes[new], np.bincount(text[new], minlength=len(lengths))


def _passage_counts(lengths: np.ndarray, size: int) -> np.ndarray:
    half = size // 2
    return np.maximum(1, -(-(lengths - half) // half))


def _passage_means(values: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Means over passages of up to ``size`` words that start every half passage; 0 for a text without words."""
    half = size // 2
    counts = _passage_counts(lengths, size)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.cumsum(lengths) - lengths
    start = base[text] + nth * half
    end = np.minimum(start + size, base[text] + lengths[text])
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[end] - total[start]) / np.maximum(end - start, size // 4)


def _evidence(words: list[str], codes: np.ndarray, lengths: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """For every n-gram bucket, the part of its log odds beyond ``surety`` standard errors (0 within)."""
    grams = [
        (bucket, np.bincount(owner, minlength=len(words))) for owner, bucket in word_ngrams(words, SIZES, s.buckets)
    ]
    starts = [np.cumsum(n) - n for _, n in grams]
    with_1, with_0 = np.full(s.buckets, 0.5), np.full(s.buckets, 0.5)
    size, base = 128, np.cumsum(lengths) - lengths
    for at in range(0, len(lengths), size):  # some documents at a time, which bounds memory
        own = lengths[at : at + size]
        document = np.repeat(np.arange(len(own)), own)
        used = np.unique(document * len(words) + codes[base[at] : base[at] + own.sum()])
        of_document, of_word = used // len(words), used % len(words)
        seen = [np.zeros(0, np.int64)]
        for (bucket, count), start in zip(grams, starts):
            n = count[of_word]
            place = np.repeat(start[of_word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            seen.append(np.repeat(of_document, n) * s.buckets + bucket[place])
        keys = np.unique(np.concatenate(seen))
        toxic = y[at + keys // s.buckets] == 1
        with_1 += np.bincount(keys[toxic] % s.buckets, minlength=s.buckets)
        with_0 += np.bincount(keys[~toxic] % s.buckets, minlength=s.buckets)
    odds = np.log(with_1 / ((y == 1).sum() + 1)) - np.log(with_0 / ((y == 0).sum() + 1))
    return np.sign(odds) * np.maximum(0, np.abs(odds) - s.surety * np.sqrt(1 / with_1 + 1 / with_0))


class _Trainer:
    """Joint training; an example is a bag of words with counts."""

    def __init__(self, words: list[str], evidence: np.ndarray, settings: Settings):
        self.s, self.n = settings, len(words)
        owner, bucket = [np.concatenate(x) for x in zip(*word_ngrams(words, SIZES, settings.buckets))]
        self.size = np.maximum(1, np.bincount(owner, minlength=self.n)).astype(np.float32)
        said = evidence[bucket] != 0
        owner, bucket = owner[said], bucket[said]
        used, at = np.unique(bucket, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        self.owner, self.at, self.used = owner[order].astype(np.int32), at[order].astype(np.int32), used
        self.kept = np.bincount(owner, minlength=self.n)
        rng = np.random.default_rng(settings.seed)
        e = rng.normal(0, 0.01, (len(used), settings.dims)).astype(np.float32)
        w = rng.normal(0, 0.1, (settings.dims, 2)).astype(np.float32)
        e[:, 0], w[0] = evidence[used], (-2, 2)
        self.p = {"e": e, "w": w, "b": np.array([1, -1], np.float32)}
        self.by_bucket = np.argsort(self.at, kind="stable")
        self.bucket_n = np.bincount(self.at, minlength=len(used))

    def fit(self, codes: np.ndarray, lengths: np.ndarray, labels: np.ndarray, epochs: int) -> None:
        s, p = self.s, self.p
        example = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        inverse = (1 / np.maximum(lengths, s.passage // 4)).astype(np.float32)
        share = [0.5 / max(1, (labels == k).sum()) for k in (0, 1)]
        weight = np.where(labels == 1, share[1], share[0]).astype(np.float32)
        codes = codes.astype(np.int32)
        by_word = np.argsort(codes, kind="stable").astype(np.int32)
        word_n = np.bincount(codes, minlength=self.n)
        target = np.eye(2, dtype=np.float32)[labels]
        moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
        for t in range(1, epochs + 1):
            vectors = segment_sums(p["e"][self.at], self.kept) / self.size[:, None]
            bags = segment_sums(vectors[codes], lengths) * inverse[:, None]
            logits = bags @ p["w"] + p["b"]
            prob = np.exp(logits - logits.max(1, keepdims=True))
            prob /= prob.sum(1, keepdims=True)
            slope = (prob - target) * weight[:, None]
            back = (slope @ p["w"].T) * inverse[:, None]
            of_word = segment_sums(back[example[by_word]], word_n) / self.size[:, None]
            of_bucket = segment_sums(of_word[self.owner[self.by_bucket]], self.bucket_n)
            grads = {"e": of_bucket, "w": bags.T @ slope, "b": slope.sum(0)}
            for k, g in grads.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                step = {"e": 0.03, "w": 0.03, "b": 0.1}[k]
                # the floor keeps n-grams of tiny slopes, rare ones, near their evidence
                p[k] = (p[k] - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-5)).astype(np.float32)

    def model(self) -> Model:
        side = self.p["w"][:, 1] - self.p["w"][:, 0]
        weights = np.zeros(self.s.buckets, np.float32)
        weights[self.used] = self.p["e"] @ side
        return Model(weights, float(self.p["b"][1] - self.p["b"][0]), self.s)


def fit(texts: list[str], labels: list[int], settings: Settings = Settings()) -> Model:
    """A model from labelled texts (0 or 1).  With one label only, or without words, every score is that of the bias."""
    if len(set(labels)) < 2 or not any(map(str.split, texts)):
        return Model(np.zeros(settings.buckets), {frozenset([1]): 6.0}.get(frozenset(labels), -6.0), settings)
    order = sorted(range(len(texts)), key=lambda i: (labels[i], i))
    aside = set(order[::4]) if min(labels.count(0), labels.count(1)) >= 40 else set()
    used = [i for i in range(len(texts)) if i not in aside]
    model = _fit([texts[i] for i in used], np.array([labels[i] for i in used], np.int64), settings)
    judged = [*aside] or used
    model.bias += _offset(model, [texts[i] for i in judged], np.array([labels[i] for i in judged]))
    return model


def _offset(model: Model, texts: list[str], labels: np.ndarray) -> float:
    """What to add to the logits so that 0.7 is the score that parts the labels best; one false alarm weighs five misses."""
    score = np.clip(model.score(texts), 1e-12, 1 - 1e-12)
    logits = np.log(score / (1 - score))
    order = np.argsort(-logits, kind="stable")
    gain = np.cumsum(np.where(labels[order] == 1, 1 / max(1, (labels == 1).sum()), -5 / max(1, (labels == 0).sum())))
    gain[:-1][logits[order][:-1] == logits[order][1:]] = -np.inf
    best = int(np.argmax(gain))
    cut = logits[order[best]] if best + 1 == len(order) else (logits[order[best]] + logits[order[best + 1]]) / 2
    return float(np.log(0.7 / 0.3) - cut)


def _fit(texts: list[str], y: np.ndarray, settings: Settings) -> Model:
    words, codes, lengths = word_codes(texts)
    trainer = _Trainer(words, _evidence(words, codes, lengths, y, settings), settings)
    size, half = settings.passage, settings.passage // 2
    counts, base = _passage_counts(lengths, size), np.cumsum(lengths) - lengths
    for epochs in settings.epochs:
        if not len(trainer.used):
            break
        logits = _passage_means(trainer.model().word_logits(words)[codes], lengths, size)
        chosen: list[tuple[int, int, int]] = []
        for i, (n, at) in enumerate(zip(counts, np.cumsum(counts) - counts)):
            ranked = np.argsort(-logits[at : at + n], kind="stable")
            own = ranked[:1] if y[i] else [*ranked[:3], *range(i % 7, int(n), 7)]
            chosen += [(base[i] + k * half, min(base[i] + k * half + size, base[i] + lengths[i]), y[i]) for k in own]
        spans = np.array(chosen, np.int64)
        spans = spans[spans[:, 1] > spans[:, 0]]
        said = np.concatenate([codes[a:b] for a, b, _ in spans])
        trainer.fit(said, spans[:, 1] - spans[:, 0], spans[:, 2], epochs)
    return trainer.model()


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), training=None) -> Model:
    """Fit on at most ``settings.per_label`` labelled rows of each label, of at most ``settings.max_chars`` characters.

    ``training`` is a condition on doc_id.  Labels other than 0 and 1, or null, and labels
    without a document are left out; so are longer texts, from training alone.  A doc_id with
    several rows or labels gives a labelled row for each pair; all of them count towards the
    bound.
    """
    known = plain(labels, doc_id=F.col("doc_id").cast("bigint"), toxic=F.col("toxic").cast("int"))
    known = known.where("toxic in (0, 1) and doc_id is not null")
    if training is not None:
        known = known.where(training)
    drawn = bounded_sample(known.distinct(), "toxic", 2 * settings.per_label, "doc_id")
    texts = plain(docs, doc_id=F.col("doc_id").cast("bigint"), text=F.coalesce(F.col("text"), F.lit("")))
    texts = texts.where(F.length("text") <= settings.max_chars)
    # of the drawn labels at most ``per_label`` rows of either, however many rows an id has
    rows = bounded_sample(
        texts.join(F.broadcast(drawn), "doc_id"), "toxic", settings.per_label, "doc_id", "text"
    ).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], settings)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row; null and empty texts are scored like a passage without words."""
    return with_scores(
        plain(docs, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text")), model, threshold
    ).drop("text")


def with_scores(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """All rows and columns of ``docs`` (which must not have ``score`` or ``predicted``) with both of these."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, "text", 2 << 20):
                score = shared.value.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    [*part.schema.names, "score", "predicted"]
                )

    added = T.StructType(
        [*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return docs.mapInArrow(run, added)


def held_out_condition():
    """Rows whose labels training must not see: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
