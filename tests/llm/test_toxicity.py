import math

import numpy as np
import pytest

from plinth.llm import queries, toxicity as T


def tables(spark, n=400):
    rng = np.random.default_rng(0)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    docs, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, 60))
        toxic = i % 5 == 0
        if toxic:
            for k in range(1 + i % 4):
                text.insert(k * 7, ["vilestuff", "grimword", "vilething"][(i + k) % 3])
        docs.append((i, " ".join(text), "en", "x"))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, severity string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_grades_and_stems(spark):
    docs, labels = tables(spark)
    m = T.train(docs, labels)
    assert m.thresholds == sorted(m.thresholds) and len(m.thresholds) == T.GRADES - 1
    clean, mild, severe = (m.severity(t) for t in ("waa wab wac", "waa grimword wab", "grimword vilestuff vilething grimword"))
    assert clean < T.REJECT_AT <= mild < severe <= 2
    assert m.severity("waa Vilenew") > clean  # a new compound of a known beginning
    out = T.severity(docs, m, ["doc_id"]).toPandas()
    assert (out.rejected == (out.doc_id % 5 == 0)).mean() > 0.98
    kept = T.without_toxic(docs, m)
    assert kept.columns == docs.columns and kept.count() == (~out.rejected).sum()


def test_edges(spark):
    docs, labels = tables(spark, 60)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "word " * 200_000)], "doc_id long, text string")
    m = T.train(docs, labels)
    assert [r.rejected for r in T.severity(odd, m, ["doc_id"]).collect()] == [False] * 4
    nothing = T.train(docs.limit(0), labels)
    assert nothing.severity("vilestuff") == 0.0
    assert T.train(docs, labels.limit(0)).severity("x") == 0.0
    assert T.severity(odd.limit(0), m, ["doc_id"]).count() == 0


def test_clashing_columns_and_grades(spark):
    docs, labels = tables(spark)
    m = T.train(docs, labels)
    out = T.severity(docs.withColumn("rejected", docs.lang), m, ["severity", "rejected", "doc_id"])
    assert out.columns == ["severity", "rejected", "doc_id", "severity_", "rejected_"] and {r.severity for r in out.collect()} == {"x"}
    low, high = T.threshold_report(docs, labels)
    assert low > 0.97 and high > 0.8
    _, row, col, value, half, toxic = T._sampled(docs, labels, 1000)
    grade = T.grades_of(row, col, value, half, toxic, col.max() + 1)
    assert ((grade > 0) == (toxic == 1)).all() and 0.2 < (grade[toxic == 1] == 2).mean() < 0.6


def test_gradient_of_the_ordinal_fit():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    latent = x @ [2.0, -1.0, 0.0] + rng.logistic(size=400)
    grade = (latent > -0.5).astype(int) + (latent > 1.5)
    row, col = np.repeat(np.arange(400), 3), np.tile(np.arange(3), 400)
    w, theta = T.fit_ordinal(row, col, x.ravel(), grade, 3, 3)
    assert w == pytest.approx([2, -1, 0], abs=0.5) and theta == pytest.approx([-0.5, 1.5], abs=0.5)


def plain_severity(text, weights, thresholds):
    """Word by word, beginning by beginning, without gates or counters."""
    found, word = {}, ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
            continue
        for f in [word, *(word[:n] + "*" for n in (4, 5, 6, 7) if n < len(word))] if word else []:
            found[f] = found.get(f, 0) + 1
        word = ""
    z = sum(weights[f] * (1 + math.log(n)) for f, n in found.items() if f in weights)
    return sum(1 / (1 + math.exp(t - z)) for t in thresholds)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf)
    assert got.columns == ["doc_id", "severity", "rejected"]
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    m = T.train(docs, labels)
    assert m.weights
    want = {r.doc_id: plain_severity(r.text, m.weights, m.thresholds) for r in docs.collect()}
    rows = got.collect()
    assert len(rows) == len(want) and all(r.severity == pytest.approx(want[r.doc_id], abs=1e-6) and r.rejected == (r.severity >= T.REJECT_AT) for r in rows)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert np.mean([r.rejected == (known[r.doc_id] == 1) for r in rows if r.doc_id in known]) > 0.95
