"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. Document evidence: a logistic regression on ``FEATURES`` of the whole text gives log-odds of good quality. It is fitted on at
   most ``SAMPLE_ROWS`` labelled documents, those of the least hash of doc_id (a documented bound).
2. Site evidence: labels are counted by host and by (host, path) in grouped aggregations over all labelled documents. Each
   level's rate is shrunk toward the one above: posterior = (good + kappa * parent) / (n + kappa), the global rate above all. kappa
   is estimated for each level by the method of moments, so noisy levels shrink more; a site without labels has its parent's rate.
3. A document's log-odds are the sum of its own and the shift of its path's posterior against the global rate.

Host and path default to the columns source and lang of documents.

Scale: labels are joined once and reduced before the shuffle; the site tables join back by ordinary joins (a hot host is split by adaptive
execution, the site side has one row per site).

A labelled document's own label is part of its site's posterior, as sites are judged by all that is known of them; the more labels a site has the less it weighs, and a site with one label
is shrunk nearly to its parent.

Defined cases: null host or path: ``unknown``; null and empty texts have all-zero features and a score like any other; a very long text counts whole; no
labels: quality 0.5 and all kept; repeated rows get equal results; several labels of one document count once (their least); sites with equal counts have equal posteriors; an empty table gives no rows; other columns,
whatever they are called, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import materialize

SAMPLE_ROWS = 20_000
KEEP_AT = 0.5
UNKNOWN = "unknown"
FEATURES = ("letters", "upper", "digits", "symbols", "marks", "pipes", "log_words", "word_length", "distinct_words", "top_word", "distinct_lines", "short", "exclaims", "long_words", "non_ascii")
_UPPER, _LETTER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")
_SYMBOL, _MARK, _EXCLAIM = re.compile(r"[#$%&*@~^<>=\\{}\[\]]+"), re.compile(r"[.,;:'\"()-]"), re.compile(r"[!?]")


def features(text: str | None) -> list[float]:
    """In the order of FEATURES; shares of characters, words or lines unless a logarithm."""
    t = text or ""
    if not t:
        return [0.0] * len(FEATURES)
    n = len(t)
    of = lambda rx: sum(map(len, rx.findall(t))) / n
    words = t.split()
    k = max(1, len(words))
    counts = Counter(words)
    lines = t.split("\n")
    top = max(counts.values(), default=0) / k
    return [of(_LETTER), of(_UPPER), of(_DIGIT), of(_SYMBOL), len(_MARK.findall(t)) / n, t.count(" | ") / k, float(np.log1p(k)), sum(map(len, words)) / k / 10, len(counts) / k, top, len(set(lines)) / len(lines), float(k < 20), len(_EXCLAIM.findall(t)) / k, sum(len(w) > 12 for w in words) / k, 1 - len(t.encode("ascii", "ignore")) / n]


class Model:
    """Standardised features with squares and pair products of them, linear in the log-odds."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    @staticmethod
    def expand(x: np.ndarray) -> np.ndarray:
        i, j = np.triu_indices(x.shape[1])
        return np.concatenate([np.ones((len(x), 1)), x, x[:, i] * x[:, j]], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        return np.clip(self.expand(np.clip((x - self.mean) / self.scale, -4, 4)) @ self.weights, -15, 15)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, steps: int = 25) -> Model:
    """Ridge logistic regression by Newton steps."""
    if not len(y) or y.min() == y.max():
        return Model(None, None, None)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = Model.expand(np.clip((x - mean) / scale, -4, 4))
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w)


def _labelled(labels: DataFrame) -> DataFrame:
    return labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min("quality").cast("int").alias("__y"))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    picked = _labelled(labels).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    joined = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(F.broadcast(picked), "__id").select("text", "__y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.float64())), b.column(1)], names=["x", "y"])

    got = joined.mapInArrow(run, "x array<double>, y int").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # the fit does not depend on how rows arrive
    return fit(x[order], got.column("y").to_numpy()[order].astype(np.float64))


def _shrunk(level: DataFrame, parent: str) -> DataFrame:
    """level (good, n, and the parent rate) with its posterior.

    With m the mean rate and s2 the spread of rates around their parents, weighted by n, the between-site variance is
    s2 less the sampling variance; kappa = m (1 - m) / variance - 1.
    """
    gap = F.col("good") / F.col("n") - F.col(parent)
    stats = level.agg(F.sum(F.col("n") * gap * gap).alias("q"), F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))).alias("v"), F.sum(F.col("n") * F.col("n")).alias("n2"))
    noise = F.col("v") / F.col("n")
    between = F.greatest((F.col("q") - F.col("k") * noise) / F.greatest(F.col("n") - F.col("n2") / F.col("n"), F.lit(1.0)), noise * 1e-4)
    kappa = stats.select(F.coalesce(F.greatest(noise / F.nullif(between, F.lit(0.0)) - 1, F.lit(1.0)), F.lit(1.0)).alias("kappa")).first()
    k = kappa.kappa if kappa else 1.0
    return level.withColumn("posterior", (F.col("good") + k * F.col(parent)) / (F.col("n") + k))


def site_posteriors(keyed: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(__host, __path, posterior of both levels) of labelled sites, and the global rate. keyed: __id, __host, __path."""
    sites = materialize(keyed.join(_labelled(labels), "__id").groupBy("__host", "__path").agg(F.sum("__y").alias("good"), F.count("*").alias("n")), "sites")
    total = sites.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    rate = (total.g + 1) / (total.n + 2) if total.n else 0.5
    hosts = _shrunk(sites.groupBy("__host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).withColumn("parent", F.lit(rate)), "parent").select("__host", F.col("posterior").alias("host_posterior"))
    paths = _shrunk(sites.join(hosts, "__host"), "host_posterior").select("__host", "__path", F.col("posterior").alias("path_posterior"))
    return hosts.join(paths, "__host", "left"), rate


def score(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", rows: int = SAMPLE_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, host, path, document_log_odds, host_posterior, path_posterior, quality (0 to 1), keep."""
    model = train(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t) for t in b.column(3).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(model.log_odds(x))], names=["__id", "__host", "__path", "log_odds"])

    base = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.col(host).cast("string"), F.lit(UNKNOWN)).alias("__host"), F.coalesce(F.col(path).cast("string"), F.lit(UNKNOWN)).alias("__path"), "text")
    scored = materialize(base.mapInArrow(run, "__id long, __host string, __path string, log_odds double"), "scored")
    sites, rate = site_posteriors(scored.select("__id", "__host", "__path"), labels)
    sites = materialize(sites, "posteriors")
    hosts = sites.groupBy("__host").agg(F.first("host_posterior").alias("host_posterior"))
    logit = lambda p: F.log(p / (1 - p))
    inside = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    joined = scored.join(hosts, "__host", "left").join(sites.where("path_posterior is not null").select("__host", "__path", "path_posterior"), ["__host", "__path"], "left")
    host_p = F.coalesce("host_posterior", F.lit(rate))
    path_p = F.coalesce("path_posterior", host_p)
    out = joined.select("__id", "__host", "__path", "log_odds", host_p.alias("hp"), path_p.alias("pp"))
    total = F.col("log_odds") + logit(inside(F.col("pp"))) - logit(inside(F.lit(rate)))
    quality = 1 / (1 + F.exp(-total))
    return out.select(F.col("__id").alias("doc_id"), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("log_odds").alias("document_log_odds"), F.col("hp").alias("host_posterior"), F.col("pp").alias("path_posterior"), quality.alias("quality"), (quality >= keep_at).alias("keep"))
