import numpy as np
import pytest

from plinth.llm import quality as Q, queries


def test_features():
    assert Q.features(None) == Q.features("") == [0.0] * len(Q.FEATURES)
    assert all(np.isfinite(Q.features(t)).all() for t in ("a", " ", "\n\n", "#" * 100_000, "wörd " * 100_000))


def test_shrinkage(spark):
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(1200):
        host = "good" if i % 3 == 0 else "bad" if i % 3 == 1 else f"rare{i}"
        docs.append((i, f"plain words {i}", host, "p"))
        y = rng.random() < {"good": 0.95, "bad": 0.3}.get(host, 0.6)
        labels.append((i, int(y)))
    d, l = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = Q.score(d, l).toPandas().set_index("doc_id")
    good, bad, rare = (got[got.host.str.startswith(h)].path_posterior for h in ("good", "bad", "rare"))
    assert good.min() > 0.85 and bad.max() < 0.45
    assert rare.between(0.3, 0.9).all()  # one label moves a site only a little from the global rate


def test_edges(spark):
    d = spark.createDataFrame([(None, None, None, None, 1), (1, "", "s", None, 1), (1, "", "s", None, 1)], "doc_id long, text string, source string, lang string, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.score(d, none).collect()
    assert len(got) == 3 and all(r.quality == 0.5 and r.keep for r in got)
    assert Q.score(d.limit(0), none).count() == 0
    some = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    assert Q.score(d, some).count() == 3


def plain_features(t):
    """Character by character and word by word."""
    if not t:
        return [0.0] * 15
    n, words, lines = len(t), t.split(), t.split("\n")
    k = max(1, len(words))
    upper = sum("A" <= c <= "Z" or "À" <= c <= "Ö" or "Ø" <= c <= "Þ" for c in t)
    letters = sum((c.isalnum() or c == "_") and not c.isdecimal() and c != "_" for c in t)
    counts = [sum(c in of for c in t) for of in ("0123456789", "#$%&*@~^<>=\\{}[]", ".,;:'\"()-", "!?")]
    top = max((words.count(w) for w in set(words)), default=0)
    return [letters / n, upper / n, counts[0] / n, counts[1] / n, counts[2] / n, t.count(" | ") / k, float(np.log1p(k)), sum(map(len, words)) / k / 10, len(set(words)) / k, top / k, len(set(lines)) / len(lines), float(k < 20), counts[3] / k, sum(len(w) > 12 for w in words) / k, sum(ord(c) > 127 for c in t) / n]


def plain_kappa(sites):
    """Method of moments from (good, n, parent) rows."""
    q = sum(n * (g / n - p) ** 2 for g, n, p in sites)
    n1, n2, v = sum(n for _, n, _ in sites), sum(n * n for _, n, _ in sites), sum(n * p * (1 - p) for _, n, p in sites)
    noise = v / n1
    between = max((q - len(sites) * noise) / max(n1 - n2 / n1, 1.0), noise * 1e-4)
    return max(noise / between - 1, 1.0)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    x = {d.doc_id: plain_features(d.text) for d in docs}
    assert all(x[d.doc_id] == pytest.approx(Q.features(d.text)) for d in docs)
    train = sorted(x[d.doc_id] + [labels[d.doc_id]] for d in docs if d.doc_id in labels)
    a = np.array([r[:-1] for r in train])
    order = np.lexsort(a.T)
    model = Q.fit(a[order], np.array([r[-1] for r in train], np.float64)[order])
    by_path, by_host = {}, {}
    for d in docs:
        if d.doc_id in labels:
            for k, of in (((d.source or "unknown", d.lang or "unknown"), by_path), (d.source or "unknown", by_host)):
                g, n = of.get(k, (0, 0))
                of[k] = (g + labels[d.doc_id], n + 1)
    rate = (sum(g for g, _ in by_host.values()) + 1) / (sum(n for _, n in by_host.values()) + 2)
    k = plain_kappa([(g, n, rate) for g, n in by_host.values()])
    host = {h: (g + k * rate) / (n + k) for h, (g, n) in by_host.items()}
    k = plain_kappa([(g, n, host[h]) for (h, _), (g, n) in by_path.items()])
    path = {(h, p): (g + k * host[h]) / (n + k) for (h, p), (g, n) in by_path.items()}
    got = {r.doc_id: r for r in queries.op8_quality(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        h, p = d.source or "unknown", d.lang or "unknown"
        pp = path.get((h, p), host.get(h, rate))
        z = float(model.log_odds(np.array([x[d.doc_id]]))[0]) + np.log(pp / (1 - pp)) - np.log(rate / (1 - rate))
        r = got[d.doc_id]
        assert (r.host_posterior, r.path_posterior, r.quality) == pytest.approx((host.get(h, rate), pp, 1 / (1 + np.exp(-z))), abs=1e-6)
        assert r.keep == (r.quality >= Q.KEEP_AT)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_quality(spark, sf)
    assert got.columns == ["doc_id", "host", "path", "document_log_odds", "host_posterior", "path_posterior", "quality", "keep"]
    joined = got.select("doc_id", "keep").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (joined.keep == (joined.quality == 1)).mean() > 0.95
    assert joined[joined.quality == 1].keep.mean() > 0.99
