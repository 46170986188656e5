"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are mapped code point by code point (letters in lower case, anything else a space), n-grams of 1 to 3 code
points are hashed into ``BUCKETS``. The log-probability matrix (buckets x languages, float32) is the only thing
broadcast; its size is bounded by BUCKETS * 4 bytes per language. Scoring gathers matrix rows in numpy and sums
them by document, in slices, so that long texts need no more memory.

The prior of a language is its share of the training documents (all of them, not of the sample). A text's log-likelihood is scaled down to that of ``EVIDENCE`` n-grams
if it has more, as neighbouring n-grams aren't independent.

Training samples each language's documents by the hash of doc_id, at a rate that gives ``SAMPLE_PER_LANGUAGE`` of them or all if
there are fewer (a documented bound on labelled rows); every prediction uses the whole text.

Defined cases: text null or without a letter: ``und`` with score 0; no training rows: everything is ``und``; of languages of equal probability the first in order;
a very long text counts whole; repeated rows get equal results; an empty table gives no rows; where a kept column is called as a new one the new one has underscores added; more than ``MAX_LANGUAGES`` values of
lang are an error, since they would be no languages and the matrix would not be bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import free_names

BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 2000
SMOOTHING = 0.5
MAX_LANGUAGES = 512
EVIDENCE = 100  # n-grams that a posterior counts as independent, at most
_SLICE = 1 << 18
_PAD = np.full(2, 32, np.uint32)
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    fold = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            fold[c] = ord(low) if len(low) == 1 else c
    return fold


def _codes(text: str) -> np.ndarray:
    return _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _grams(codes: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that ends at each code point, for n of 1, 2, 3 (shorter at the start)."""
    one = codes * _MULT[0]
    two = (one ^ (one >> np.uint32(15))).copy()
    two[1:] += codes[:-1] * _MULT[1]
    three = two.copy()
    three[2:] += codes[:-2] * _MULT[2]
    return [((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(17)).astype(np.int32) & (BUCKETS - 1) for h in (one, two * _MULT[1], three * _MULT[2])]


def _sliced(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Folded code points of consecutive texts, each between spaces of its own, with the text number of each."""
    held, owner, size = [], [], 0
    for i, t in enumerate(texts):
        codes = np.concatenate([_PAD, _codes(t or ""), _PAD[:1]])
        for at in range(0, len(codes), _SLICE):
            part = codes[at : at + _SLICE]
            held.append(part)
            owner.append(np.full(len(part), i, np.int32))
            size += len(part)
            if size >= _SLICE:
                yield np.concatenate(held), np.concatenate(owner)
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owner)


class Model:
    def __init__(self, languages: list[str], log_p: np.ndarray, prior: np.ndarray):
        self.languages, self.log_p, self.prior = languages, np.ascontiguousarray(log_p.T, np.float32), prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.languages)
        total, letters = np.zeros((n, k)), np.zeros(n, np.int64)
        for codes, owner in _sliced(texts):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            ids = owner[first]
            is_letter = codes != 32
            np.add.at(letters, ids, np.add.reduceat(is_letter.astype(np.int64), first))
            # runs of spaces say nothing of a language
            told = is_letter.copy()
            told[1:] |= is_letter[:-1]
            for h in _grams(codes):
                for j in range(k):
                    np.add.at(total[:, j], ids, np.add.reduceat(np.where(told, self.log_p[j][h], 0), first, dtype=np.float64))
        names, score = ["und"] * n, np.zeros(n)
        if k:
            seen = np.maximum(letters, 1)
            scaled = total * (np.minimum(seen, EVIDENCE) / (3 * seen))[:, None] + self.prior
            best = scaled.argmax(axis=1)
            p = 1 / np.exp(scaled - scaled.max(axis=1, keepdims=True)).sum(axis=1)
            for i in np.flatnonzero(letters):
                names[i], score[i] = self.languages[best[i]], p[i]
        return names, score


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, learn, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fits on the rows of docs (doc_id, text, lang) for which the column ``learn`` holds."""
    base = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # No language is ever sorted or gathered as a whole. The rates are a row a language, as the columns of the matrix are.
    counts = base.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} values of lang")
    documents = {r.lang: r.n for r in counts}
    rates = docs.sparkSession.createDataFrame([(lang, per_language / n) for lang, n in documents.items()], "lang string, __rate double")
    u = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = base.select("doc_id", "lang", "text").join(F.broadcast(rates), "lang").where(u < F.col("__rate")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, np.ndarray] = {}
        for b in batches:
            texts: dict[str, list[str]] = {}
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                texts.setdefault(lang, []).append(t)
            for lang, own in texts.items():
                counts = by.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for codes, _ in _sliced(own):
                    is_letter = codes != 32
                    told = is_letter.copy()
                    told[1:] |= is_letter[:-1]
                    for h in _grams(codes):
                        counts += np.bincount(h[told], minlength=BUCKETS)
        for lang, counts in by.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["lang", "bucket", "n"])

    # at most BUCKETS rows a language
    rows = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    of = np.array(rows.column("lang").to_pylist(), object)
    languages = sorted(set(of.tolist()))
    table = np.zeros((BUCKETS, len(languages)))
    if languages:
        where = {x: i for i, x in enumerate(languages)}
        table[rows.column("bucket").to_numpy(), np.array([where[x] for x in of.tolist()], np.int64)] = rows.column("n").to_numpy()
    table += SMOOTHING
    prior = np.array([documents[x] for x in languages], np.float64)
    return Model(languages, np.log(table / table.sum(axis=0)), np.log(prior / max(sum(documents.values()), 1)))


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of docs, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(*[f"`{c}`" for c in keep], F.col("text").alias("__plinth_text"))
    columns = [*keep, *free_names(keep, "lang_pred", "score")]
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(columns, [*(t for _, t in base.dtypes[:-1]), "string", "double"], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score = shared.value.predict(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(names, pa.string()), pa.array(score)], names=columns)

    return base.mapInArrow(run, schema)
