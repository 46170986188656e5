"""Toxicity severity by cumulative-link ordinal regression over sparse word features.

P(grade <= k | x) = sigmoid(theta_k - w.x), with one weight vector w for all ordered thresholds theta_0 < theta_1. The output is the
expected severity, the sum over k of P(grade > k): 0 (clean) to 2 (severe).

Features are whole words (letters, lower case) and word beginnings of 4 to 7 letters (written with a star), since insults are also built as compounds;
their value is 1 + log(count) over the whole text. The vocabulary holds those that are significantly tied to the label
(likelihood ratio over distinct texts of the sample, which bounds it); they are kept as strings, not hashed, so no clean word can fall on a toxic one.

Labels give toxic 0 or 1. Grades are derived from them: 0 not toxic; a toxic text is of grade 2 (severe) if it is more clearly toxic than the median toxic text, else of
grade 1. How clearly is told by a two-grade model that was fitted on the other half of the sample, so no text has a part in its own grade. ``threshold_report`` gives, for each threshold, the
accuracy on a half of the sample that the model was not fitted on. With labels of 0 and 1 alone the upper grade remains a matter of vocabulary: severities from 1 to 2 order toxic texts
by it and say no more.

Training reads at most ``SAMPLE_ROWS`` labelled documents, those of the least hash of doc_id (a documented bound);
scoring reads every word of every text.

Defined cases: null and empty texts have no features and get the severity of the thresholds alone, which is below
``REJECT_AT`` unless most labels are toxic; a very long text counts whole; no labels: severity 0 for all; of several labels of a document the toxic one counts; repeated rows get equal results; an
empty table gives no rows; where a kept column is called as a new one the new one has underscores added.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import free_names, materialize

SAMPLE_ROWS = 20_000
MIN_TEXTS = 5
SIGNIFICANCE = 30.0  # likelihood ratio of a feature
REJECT_AT = 0.4
STEMS = range(4, 8)  # lengths of word beginnings
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def of_word(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings."""
    return [word, *(word[:n] + "*" for n in STEMS if n < len(word))]


def counts_of(text: str | None, known, gate: set[str]) -> Counter:
    """Counts of known features. gate: the first letters of all known ones, which most words fail at once."""
    n, out = STEMS[0], Counter()
    for w in words(text):
        if w[:n] in gate:
            out.update(f for f in of_word(w) if f in known)
    return out


def gate_of(known) -> set[str]:
    return {f.rstrip("*")[: STEMS[0]] for f in known}


class Model:
    """weights by feature, increasing thresholds."""

    def __init__(self, weights: dict[str, float], thresholds: list[float]):
        self.weights, self.thresholds, self.gate = weights, thresholds, gate_of(weights)

    def severity(self, text: str | None) -> float:
        if not self.thresholds:
            return 0.0
        counts = counts_of(text, self.weights, self.gate) if self.weights else {}
        score = sum(self.weights[w] * (1 + math.log(n)) for w, n in sorted(counts.items()))
        return sum(1 / (1 + math.exp(min(60.0, max(-60.0, t - score)))) for t in self.thresholds)


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text, toxic of the sampled labelled documents, distinct texts only."""
    picked = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = picked.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    joined = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(picked), "__id").where("text is not null")
    return joined.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def _associations(sample: DataFrame) -> DataFrame:
    """word, toxic_texts, clean_texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (toxic if y else clean).update({f for w in set(words(text)) for f in of_word(w)})
            keys = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], names=["word", "t", "c"])

    counted = sample.mapInArrow(count, "word string, t long, c long")
    return counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def _ratio(k, expected):
    return F.when(k > 0, 2 * k * F.log(k / expected)).otherwise(F.lit(0.0))


def vocabulary(sample: DataFrame) -> list[str]:
    """The significant features, in order."""
    totals = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = totals.t, totals.n - totals.t
    if not toxic or not clean:
        return []
    share = toxic / totals.n
    n = F.col("t") + F.col("c")
    g2 = _ratio(F.col("t"), n * share) + _ratio(F.col("c"), n * (1 - share)) + _ratio(F.lit(float(toxic)) - F.col("t"), (totals.n - n) * share) + _ratio(F.lit(float(clean)) - F.col("c"), (totals.n - n) * (1 - share))
    scored = _associations(sample).where(n >= MIN_TEXTS).withColumn("g2", g2).where(F.col("g2") >= SIGNIFICANCE)
    return sorted(r.word for r in scored.select("word").collect())


def _features(sample: DataFrame, index: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Row, column, count triplets, the half of each row (of a hash of its text) and its label; only vocabulary features of the bounded sample reach the driver."""

    gate = gate_of(index)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n, half = [], [], []
            for text in b.column(0).to_pylist():
                counts = counts_of(text, index, gate)
                at.append([index[f] for f in sorted(counts)])
                n.append([counts[f] for f in sorted(counts)])
                half.append(zlib.crc32(text.encode("utf-8", "surrogatepass")) >> 7 & 1)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32())), pa.array(half, pa.int32()), b.column(1)], names=["at", "n", "half", "toxic"])

    got = sample.select("text", "toxic").mapInArrow(pick, "at array<int>, n array<int>, half int, toxic int").toArrow()
    sizes = np.array([len(x) for x in got.column("at").to_pylist()], np.int64)
    flat = lambda c: np.array([v for x in got.column(c).to_pylist() for v in x], np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), flat("at"), flat("n"), got.column("half").to_numpy(), got.column("toxic").to_numpy()


def fit_ordinal(row, col, value, grade, features: int, grades: int = GRADES, l2: float = 1e-5, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the proportional-odds model, by Adam on the mean log-likelihood.

    Thresholds are a base and positive (exponential) gaps, so they stay ordered.
    """
    n = len(grade)
    counts = np.bincount(grade, minlength=grades) + 0.5
    below = np.cumsum(counts)[:-1] / counts.sum()
    theta = np.log(below / (1 - below))
    parts = np.concatenate([np.zeros(features), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, v = np.zeros_like(parts), np.zeros_like(parts)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, steps + 1):
        w, gaps = parts[:features], np.exp(parts[features + 1 :])
        theta = parts[features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(row, w[col] * value, n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        high, low = edges[grade + 1] - score, edges[grade] - score
        p_high, p_low = np.where(np.isinf(high), 1.0, sig(high)), np.where(np.isinf(low), 0.0, sig(low))
        p = np.maximum(p_high - p_low, 1e-12)
        d_high, d_low = p_high * (1 - p_high) / p, p_low * (1 - p_low) / p
        by_score = (d_high - d_low) / n  # of the loss
        by_edge = np.zeros(grades + 1)
        np.add.at(by_edge, grade + 1, -d_high / n)
        np.add.at(by_edge, grade, d_low / n)
        by_theta = by_edge[1:-1]
        grad = np.concatenate([np.bincount(col, by_score[row] * value, features) + l2 * w, [by_theta.sum()], [by_theta[i + 1 :].sum() * gaps[i] for i in range(len(gaps))]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        parts = parts - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return parts[:features], parts[features] + np.concatenate([[0], np.cumsum(np.exp(parts[features + 1 :]))])


def _of_rows(row: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which triplets belong to kept rows, and the numbers of their rows among those."""
    inside = keep[row]
    return inside, (np.cumsum(keep) - 1)[row[inside]]


def grades_of(row, col, value, half, toxic, features: int) -> np.ndarray:
    """Grades 0 to 2 of each row, by models of two grades fitted on the other half."""
    grade = (toxic == 1).astype(np.int64)
    for h in (0, 1):
        other, own = half != h, (half == h) & (toxic == 1)
        if not own.any() or not (toxic[other] == 1).any() or (toxic[other] == 1).all():
            continue
        inside, at = _of_rows(row, other)
        w, _ = fit_ordinal(at, col[inside], value[inside], grade[other].clip(0, 1), features, 2)
        score = np.bincount(row, w[col] * value, len(toxic)) if len(row) else np.zeros(len(toxic))
        grade[own & (score > np.median(score[own]))] = 2
    return grade


def _sampled(docs: DataFrame, labels: DataFrame, rows: int):
    sample = materialize(_sample(docs, labels, rows), "toxic-sample")
    vocab = vocabulary(sample)
    row, col, n, half, toxic = _features(sample, {w: i for i, w in enumerate(vocab)})
    value = 1 + np.log(np.maximum(n, 1))
    return vocab, row, col, value, half, toxic


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    vocab, row, col, value, half, toxic = _sampled(docs, labels, rows)
    if not len(toxic):
        return Model({}, [])
    weights, thresholds = fit_ordinal(row, col, value, grades_of(row, col, value, half, toxic, len(vocab)), len(vocab))
    return Model({w: float(weights[i]) for i, w in enumerate(vocab)}, thresholds.tolist())


def threshold_report(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[float]:
    """For each threshold k, how often P(grade > k) is over a half just where the grade is over k, in the half of the sample that the model wasn't fitted on."""
    vocab, row, col, value, half, toxic = _sampled(docs, labels, rows)
    grade = grades_of(row, col, value, half, toxic, len(vocab))
    inside, at = _of_rows(row, half == 0)
    w, theta = fit_ordinal(at, col[inside], value[inside], grade[half == 0], len(vocab))
    score = np.bincount(row, w[col] * value, len(toxic))[half == 1]
    return [float(((score > t) == (grade[half == 1] > k)).mean()) for k, t in enumerate(theta)]


def severity(docs: DataFrame, model: Model, keep: list[str], reject_at: float = REJECT_AT) -> DataFrame:
    """The columns ``keep`` of docs, severity double, rejected boolean."""
    base = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("__plinth_text"))
    names = [*keep, *free_names(keep, "severity", "rejected")]
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(names, [*(t for _, t in base.dtypes[:-1]), "double", "boolean"], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([model.severity(t) for t in b.column(b.num_columns - 1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(s), pa.array(s >= reject_at)], names=names)

    return base.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of docs below ``reject_at``; all columns as given."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([model.severity(t) < reject_at for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
