"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence offends with probability ``logistic(b + sum of the weights of
its words)``, a document is toxic unless none of its sentences offends (noisy-or).  Only documents
have labels; the weights are fitted by the gradient of the documents' likelihood through the
noisy-or, so the model learns which sentences carry the label and can point at them.

A word's features are the word itself and its first four to seven letters.  Features are chosen by how
much more often toxic documents hold them, and weights are not negative.  Sentences without any chosen
feature cannot offend, so a long clean document does not add up to a toxic one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import map_texts, pieces_of, text_of

SENTENCE = re.compile(r"[.!?…。]+[\s\"'”»)]*|\n+")
WORD = re.compile(r"[^\W\d_]+")
CACHED = 300_000  # words whose weight a worker remembers


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.split(text) if s and not s.isspace()]


def features(word: str) -> list[str]:
    """The word and its beginnings; ``~`` marks a beginning."""
    return [word, *[word[:n] + "~" for n in range(4, 8) if len(word) >= n]]


@dataclass
class Model:
    """Weights of features and the offset of a sentence that has one."""

    weights: dict[str, float]
    offset: float
    cache: dict[str, float | None] = field(default_factory=dict, repr=False, compare=False)

    def word(self, word: str) -> float | None:
        """Summed weight of a word, None if none of its features is known."""
        if word not in self.cache:
            if len(self.cache) > CACHED:
                self.cache.clear()
            known = [self.weights[f] for f in features(word) if f in self.weights]
            self.cache[word] = sum(known) if known else None
        return self.cache[word]

    def sentence_rates(self, text: str) -> list[tuple[str, float]]:
        """Each sentence with ``-log(1 - p)`` of its offending."""
        out = []
        for s in sentences(text):
            found = [w for w in map(self.word, set(WORD.findall(s.lower()))) if w is not None]
            out.append((s, float(np.logaddexp(0, self.offset + sum(found))) if found else 0.0))
        return out

    def score(self, text: str) -> float:
        cache, rate = self.cache, 0.0
        for s in SENTENCE.split(text.lower()):
            words = set(WORD.findall(s))
            try:
                found = [cache[w] for w in words]
            except KeyError:
                found = [self.word(w) for w in words]
            found = [w for w in found if w is not None]
            if found:
                rate += float(np.logaddexp(0, self.offset + sum(found)))
        return 1.0 - float(np.exp(-rate))


def fit(texts: list[str], labels: list[int], weights: list[float], max_features: int = 20_000, least: int = 4, penalty: float = 0.2, steps: int = 400) -> Model:
    """Fit by proximal gradient steps with per-weight step sizes; ``weights`` are those of the documents."""
    y, dw = np.array(labels, dtype=np.float64), np.array(weights, dtype=np.float64)
    seen = [Counter(), Counter()]
    for t, label in zip(texts, labels):
        seen[label].update({f for w in set(WORD.findall(t.lower())) for f in features(w)})
    n = [max(1, labels.count(0)), max(1, labels.count(1))]

    def uneven(f: str) -> float:
        """How far the share among toxic documents exceeds the other, in standard deviations."""
        a, b = seen[1][f], seen[0][f]
        share = (a + b) / (n[0] + n[1])
        return (a / n[1] - b / n[0]) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n[0] + 1 / n[1]))

    names = [f for f in {*seen[0], *seen[1]} if seen[0][f] + seen[1][f] >= least]
    names = sorted(names, key=lambda f: (-uneven(f), f))[:max_features]
    names = [f for f in names if uneven(f) >= 3.0]
    number = {f: i for i, f in enumerate(names)}
    doc, sent, feat = [], [], []
    for d, t in enumerate(texts):
        for s in sentences(t.lower()):
            known = {number[f] for w in set(WORD.findall(s)) for f in features(w) if f in number}
            if known:
                sent.extend([len(doc)] * len(known))
                feat.extend(sorted(known))
                doc.append(d)
    doc, sent, feat = np.array(doc, dtype=np.int64), np.array(sent, dtype=np.int64), np.array(feat, dtype=np.int64)
    w, offset = np.zeros(len(names)), -3.0
    square, square0 = np.full(len(names), 1e-8), 1e-8
    for _ in range(steps if len(doc) else 0):
        z = offset + np.bincount(sent, w[feat], len(doc))
        rate = np.bincount(doc, np.logaddexp(0, z), len(y))
        # d loss / d rate: 1 for clean documents, -exp(-r) / (1 - exp(-r)) for toxic ones
        slope = dw * np.where(y > 0, -1 / np.expm1(np.maximum(rate, 1e-6)), 1.0)
        by_sentence = slope[doc] / (1 + np.exp(-z))
        g, g0 = np.bincount(feat, by_sentence[sent], len(names)), by_sentence.sum()
        square += g * g
        square0 += g0 * g0
        step = 0.5 / np.sqrt(square)
        w -= step * g
        w = np.maximum(w - step * penalty, 0)
        offset -= 0.5 / np.sqrt(square0) * g0
        offset = min(offset, -1.0)
    return Model({f: float(x) for f, x in zip(names, w) if x}, float(offset))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = 2500, longest: int = 20_000) -> Model:
    """Fit on a bounded sample: of each label the ``per_class`` labelled keys of the smallest hashes.

    Keys are chosen from ``labels (key, label)`` alone, then their texts are read; texts of more than ``longest``
    characters leave the sample, so it fits the driver.  Rows weigh as much as their class
    has labels for each sampled one.  Without both labels the model scores 0.
    """
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and key is not null")
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = [marked.filter(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(per_class) for value in (0, 1)]
    # two limits bound the broadcast
    rows = (
        docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
        .filter(F.length("text") <= longest)
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "key")
        .orderBy("key", "label", F.xxhash64("text"))
        .limit(4 * per_class)  # over twice the sample: repeated keys stay bounded
        .collect()
    )
    taken = Counter(r["label"] for r in rows)
    if len(taken) < 2:
        return Model({}, -3.0)
    weights = [counts[r["label"]] / taken[r["label"]] for r in rows]
    scale = len(weights) / sum(weights)
    return fit([r["text"] for r in rows], [r["label"] for r in rows], [x * scale for x in weights])


def score(df: DataFrame, model: Model, threshold: float = 0.7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, predicted, worst_sentence, sentence_score``.

    Each row is scored from its own text alone.  Null and empty texts, and texts without a known word, have
    score 0 and no worst sentence; equal sentences tie to the first.
    """

    def run(keys: list, texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {key: keys, "score": [], "predicted": [], "worst_sentence": [], "sentence_score": []}
        for t in texts:
            s = model.score(t)
            worst, rate = max(model.sentence_rates(t), key=lambda x: x[1], default=(None, 0.0)) if s >= threshold else (None, 0.0)
            out["score"].append(s)
            out["predicted"].append(int(s >= threshold))
            out["worst_sentence"].append(worst)
            out["sentence_score"].append(1 - float(np.exp(-rate)))
        return out

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, score double, predicted int, worst_sentence string, sentence_score double"
    return map_texts(df, run, schema, key, text)


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1):
    """True for keys whose CRC-32 as text leaves ``fold``; a null key is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(True))


def is_held_out(key: int, folds: int = 3, fold: int = 1) -> bool:
    return zlib.crc32(str(key).encode()) % folds == fold


def keep_clean(df: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """Rows whose text scores below the threshold, with all their columns and types; null texts are kept."""
    at = df.columns.index(text)

    def run(batches):
        for batch in batches:
            for cut in pieces_of([batch]):
                yield cut.filter(pa.array([t is None or model.score(t) < threshold for t in cut.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
