import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.llm import langid as L, queries


def test_scores_match_a_plain_bayes(spark):
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate([("the cat and the hat", "en"), ("le chat et la tête", "fr"), ("the dog", "en"), ("où est le chien", "fr")] * 5)], "doc_id long, text string, lang string")
    m = L.train(docs, F.lit(True))
    assert m.languages == ["en", "fr"]

    def plain(text):
        codes = np.concatenate([[32, 32], L._codes(text), [32]]).astype(np.uint32)
        told = codes != 32
        told[1:] |= codes[:-1] != 32
        return [sum(m.log_p[j][h[told]].sum(dtype=np.float64) for h in L._grams(codes)) for j in range(2)]

    texts = ["the cat", "le chien", "x" * 3, "the " * 200_000, "tête " * 90_000]
    names, score = m.predict(texts)
    assert names == ["en", "fr", ["en", "fr"][int(np.argmax(plain("xxx")))], "en", "fr"] and ((score > 0) & (score <= 1)).all()


def plain_bucket(gram):
    """The hash of an n-gram of code points, number by number."""
    w = 0xFFFFFFFF
    a, b, c = ([0, 0, 0] + gram)[-3:]
    h = c * 0x9E3779B1 & w
    if len(gram) > 1:
        h = (h ^ h >> 15) + b * 0x85EBCA77 & w
    if len(gram) > 2:
        h = h + a * 0xC2B2AE3D & w
    if len(gram) > 1:
        h = h * (0x85EBCA77, 0xC2B2AE3D)[len(gram) - 2] & w
    return ((h ^ h >> 13) * 0x27D4EB2F & w) >> 17 & L.BUCKETS - 1


def plain_grams(text):
    fold = lambda c: 32 if not c.isalpha() else ord(c.lower()) if len(c.lower()) == 1 else ord(c)
    codes = [32, 32, *map(fold, text), 32]
    for i in range(2, len(codes)):
        if codes[i] != 32 or codes[i - 1] != 32:
            for n in (1, 2, 3):
                yield plain_bucket(codes[i - n + 1 : i + 1])


def test_against_brute_force(spark):
    """Counts, priors and posteriors by dictionaries, on whole texts."""
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    learn = [d for d in docs if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 4 != 2]
    langs = sorted({d.lang for d in learn})
    counts = {x: Counter() for x in langs}
    for d in learn:
        counts[d.lang].update(plain_grams(d.text))
    total = {x: sum(counts[x].values()) + L.SMOOTHING * L.BUCKETS for x in langs}
    prior = {x: math.log(sum(d.lang == x for d in learn) / len(learn)) for x in langs}
    got = {r.doc_id: r for r in queries.op10_langid(spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        letters = sum(c.isalpha() for c in d.text)
        if not letters:
            assert (got[d.doc_id].lang_pred, got[d.doc_id].score) == ("und", 0.0)
            continue
        grams = Counter(plain_grams(d.text))
        z = {x: sum(n * math.log((counts[x][g] + L.SMOOTHING) / total[x]) for g, n in grams.items()) * min(letters, L.EVIDENCE) / (3 * letters) + prior[x] for x in langs}
        best = max(langs, key=z.get)
        assert got[d.doc_id].score == pytest.approx(1 / sum(math.exp(v - z[best]) for v in z.values()), abs=1e-3)
        assert got[d.doc_id].lang_pred == best or abs(z[best] - z[got[d.doc_id].lang_pred]) < 1e-3


def test_clashes_and_too_many_languages(spark):
    docs = spark.createDataFrame([(i, f"text number {i}", f"l{i}", "x") for i in range(600)], "doc_id long, text string, lang string, score string")
    with pytest.raises(ValueError, match="values of lang"):
        L.train(docs, F.lit(True))
    m = L.train(docs.where("doc_id < 2"), F.lit(True))
    out = L.identify(docs, m, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "lang_pred", "score_"] and {r.score for r in out.collect()} == {"x"}


def test_edges(spark):
    docs = spark.createDataFrame([(1, "hello there", "en", "x"), (2, "hallo welt", "de", "x"), (3, None, "de", "x"), (None, "guten tag", None, "x")], "doc_id long, text string, lang string, score string")
    m = L.train(docs, F.lit(True))
    odd = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (2, "123 !?", "q"), (None, "hello there", "q")], "doc_id long, text string, score string")
    got = L.identify(odd, m, ["doc_id"]).collect()
    assert [(r.lang_pred, r.score) for r in got][:3] == [("und", 0.0)] * 3 and got[3].lang_pred == "en"
    nothing = L.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in L.identify(odd, nothing, ["doc_id"]).collect()} == {"und"}
    assert L.identify(odd.limit(0), m, ["doc_id"]).count() == 0


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_langid(spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    joined = got.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (joined.held_out == joined.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    out = joined[joined.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.98
