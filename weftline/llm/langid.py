"""Language identification by hierarchical discrimination.

Linear support vector machines over character n-grams first decide between language
families, one against one, and then, one against one, between the languages of the chosen
family.  All are trained in numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import bounded_sample, crc_mod, plain, segment_sums, text_chunks, word_codes, word_ngrams

#: Families of common languages (fixed values); any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su",
}
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
SCALE = 30.0


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs.split()), lang)


@dataclass
class Model:
    """Columns of ``weights`` are pairs: of families first, then of languages of one family."""

    langs: list[str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, texts: list[str]) -> np.ndarray:
        words, codes, lengths = word_codes(texts)
        sums, count = np.zeros((len(words), len(self.pairs))), np.zeros(len(words))
        for owner, bucket in word_ngrams(words, SIZES, BUCKETS):
            n = np.bincount(owner, minlength=len(words))  # owners come in order
            count += n
            sums += segment_sums(self.weights[bucket], n)
        total = segment_sums(sums[codes], lengths)
        n = segment_sums(count[codes], lengths)
        return SCALE * total / np.maximum(n, 1)[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without a letter (or without anything learned)."""
        has_letter = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        if not self.langs or not len(texts):
            return ["und"] * len(texts), np.zeros(len(texts))
        sure = 1 / (1 + np.exp(-np.clip(2 * self.margins(texts), -50, 50)))
        families = sorted({family(x) for x in self.langs})
        of, of_score = self._decide(sure, families, np.ones(len(texts), bool))
        lang, score = np.array([""] * len(texts), object), np.zeros(len(texts))
        for f in families:
            here = of == f
            if here.any():
                own, own_score = self._decide(sure, [x for x in self.langs if family(x) == f], here)
                lang[here], score[here] = own[here], (of_score * own_score)[here]
        lang[~has_letter], score[~has_letter] = "und", 0.0
        return lang.tolist(), score

    def _decide(self, sure: np.ndarray, names: list[str], where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The name that wins most duels, then by the sum of their certainties, and its mean certainty."""
        if len(names) == 1:
            return np.array([names[0]] * len(sure), object), np.ones(len(sure))
        won, wins = np.zeros((len(sure), len(names))), np.zeros((len(sure), len(names)))
        for k, (a, b) in enumerate(self.pairs):
            if a in names and b in names:
                i, j = names.index(a), names.index(b)
                won[:, i] += sure[:, k]
                won[:, j] += 1 - sure[:, k]
                wins[:, i] += sure[:, k] >= 0.5
                wins[:, j] += sure[:, k] < 0.5
        best = np.argmax(wins + won / len(names), axis=1)
        return np.array(names, object)[best], won[np.arange(len(sure)), best] / (len(names) - 1)


def _svm(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 3
) -> tuple[np.ndarray, float]:
    """Linear support vector machine with hinge loss by dual coordinate descent; classes weigh the same."""
    w, b = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    upper = np.where(y > 0, cost * len(y) / (2 * max(1, (y > 0).sum())), cost * len(y) / (2 * max(1, (y < 0).sum())))
    square = np.array([1 + v @ v for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * (w[at] @ v + b) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            change = (new - alpha[i]) * y[i]
            if change:
                w[at] += change * v
                b += change
                alpha[i] = new
    return w, b


def fit(texts: list[str], langs: list[str], max_pairs: int = 1000) -> Model:
    """A model from labelled texts; those without n-grams are left out."""
    rows, labels = [], []
    for text, lang in zip(texts, langs):
        words, codes, _ = word_codes([text])
        if not words:
            continue
        times = np.bincount(codes, minlength=len(words))
        bag = np.zeros(BUCKETS)
        for owner, bucket in word_ngrams(words, SIZES, BUCKETS):
            bag += np.bincount(bucket, times[owner], BUCKETS)
        at = np.flatnonzero(bag)
        rows.append((at, SCALE * bag[at] / bag.sum()))
        labels.append(lang)
    known = sorted(set(labels))
    families = sorted({family(x) for x in known})
    pairs = [*combinations(families, 2)] + [
        p for f in families for p in combinations([x for x in known if family(x) == f], 2)
    ]
    if len(pairs) > max_pairs:
        raise ValueError(f"{len(pairs)} pairs of languages or families, more than {max_pairs}")
    weights, bias = np.zeros((BUCKETS, len(pairs)), np.float32), np.zeros(len(pairs))
    for k, (a, b) in enumerate(pairs):
        names = [family(x) for x in labels] if k < len(families) * (len(families) - 1) // 2 else labels
        own = [i for i, x in enumerate(names) if x in (a, b)]
        weights[:, k], bias[k] = _svm([rows[i] for i in own], np.array([1.0 if names[i] == a else -1.0 for i in own]))
    return Model(known, pairs, weights, bias)


def train(
    docs: DataFrame, per_lang: int = 400, training=None, max_chars: int = 100_000, max_pairs: int = 1000
) -> Model:
    """Fit on at most ``per_lang`` documents of each non-null language, of at most ``max_chars`` characters each.

    ``training`` is a condition on doc_id.  Null ids take no part, longer texts only in
    prediction.  Rows that share a doc_id are rows of their own.  More than ``max_pairs``
    duels (weights of 256 kB each) are an error.  An empty table gives a model that knows no
    language.
    """
    rows = plain(docs, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text"), lang=F.col("lang").cast("string"))
    rows = rows.where(
        "text is not null and lang is not null and doc_id is not null"
    ).where(F.length("text") <= max_chars)
    if training is not None:
        rows = rows.where(training)
    sample = bounded_sample(rows, "lang", per_lang, "doc_id", "text").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    return fit([r["text"] for r in sample], [r["lang"] for r in sample], max_pairs)


def held_out_condition():
    """Documents that training must not see: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))


def predict_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row; ``und`` and 0 where the text is null or has no letter.

    Repeated rows and ids are predicted one by one; of languages that win as many duels with
    the same certainty the first in code-point order wins.  An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, "text", 2 << 20):
                lang, score = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"]
                )

    return plain(
        docs, doc_id=F.col("doc_id").cast("bigint"), text=F.col("text")
    ).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
