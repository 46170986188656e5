import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plinth.llm import queries, simhash_dedup as S

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def brute_print(text, k=4):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split() if w]
    shingles = [b" ".join(words)] if 0 < len(words) < k else [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(pairs, d=4):
    """pairs: (doc_id, fingerprint)."""
    label = list(range(len(pairs)))
    changed = True
    while changed:
        changed = False
        for i, (_, x) in enumerate(pairs):
            for j, (_, y) in enumerate(pairs):
                if (x ^ y).bit_count() <= d and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for (doc, _), c in zip(pairs, label, strict=True):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return [least.get(c) for c in label]


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ABab \t\n\x0b  é", max_size=60), st.lists(st.sampled_from(WORDS), max_size=40).map(" ".join)))
def test_fingerprint(text):
    assert S.fingerprint(text) == brute_print(text)


def texts():
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(WORDS, n)) for n in (3, 40, 200, 400)]
    near = [b + f" tail{i}" for b in base for i in range(6)]
    return [None, "", " \t", "One", "one", *base, *base, *near, "x" * 200_000, " ".join(WORDS * 3000)]


def test_components(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())] + [(3, "One", "clash", 1), (None, "one", "clash", 1), (None, "other text alone here", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    for options in ({}, {"shard_rows": 3}, {"blocks": 3}):
        got = S.components(docs, **options).collect()
        prints = [(r[0], brute_print(r[1])) for r in rows]
        want = sorted(zip([p[0] for p in prints], [p[1] for p in prints], brute_components(prints), strict=True), key=repr)
        assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want
    kept = S.representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({c for _, _, c in want if c is not None})


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.components(docs).count() == 0 and S.representatives(docs).count() == 0


def test_near_prints_are_found_with_any_blocks(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    prints = base + [b ^ sum(1 << int(k) for k in rng.choice(64, int(rng.integers(1, 5)), replace=False)) for b in base]
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(set(prints))], "fp long")
    for blocks in (2, 3, 4, 5):
        labels = S.connected_components(S.links(df, 4, blocks)).collect()
        group = {r.node % (1 << 64): r.label for r in labels}
        for a, b in zip(base, prints[40:], strict=True):
            assert group[a] == group[b], blocks


def test_default_trees_have_a_radius_and_visit_other_shards():
    for rows, radii in ((1, 1), (10_000_000, 1), (1 << 28, 2)):
        trees = S.trees_for(rows=rows)
        assert sum(bool(t.steps) for t in trees) == radii
        assert len(next(t for t in trees if t.steps).pivots) >= 4
    rng = np.random.default_rng(7)
    fps = rng.integers(0, 1 << 63, 2000, np.uint64)
    tree = S.trees_for()[0]
    rows, leaves, visitor = tree.shards(fps)
    assert visitor.sum() > 2000 and (~visitor).sum() == 2000
    home = dict(zip(rows[~visitor].tolist(), leaves[~visitor].tolist(), strict=True))
    at = set(zip(rows[visitor].tolist(), leaves[visitor].tolist(), strict=True))
    near = fps ^ (np.uint64(1) << rng.integers(0, 16, 2000).astype(np.uint64))  # one bit of the first block
    _, other, is_visitor = tree.shards(near)
    for i, (h, (a, b)) in enumerate(zip(home.values(), zip(fps, near, strict=True), strict=True)):
        assert h != other[i] and ((i, other[i]) in at or (h in other[np.flatnonzero(is_visitor)].tolist()))
    order = np.lexsort((np.arange(len(leaves)), leaves))
    _, leaf = np.unique(leaves, return_inverse=True)
    _, compared = S.forest(leaf[order], np.zeros(len(leaf), int), visitor[order], fps[rows][order], 4)
    assert compared < 0.05 * 2000 * 1999 / 2  # pruned by rings and the pivot inside a shard


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = [(d.doc_id, brute_print(d.text)) for d in docs]
    want = sorted((d, f"{f:016x}", c) for (d, f), c in zip(prints, brute_components(prints), strict=True))
    assert sorted(tuple(r) for r in queries.op3_simhash(spark, sf_dir).collect()) == want


def test_radii():
    for d in range(9):
        for m in range(1, d + 2):
            assert sum(r + 1 for r in S.block_radii(d, m)) >= d + 1


def test_chain_components(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert S.connected_components(edges).select("label").distinct().count() == 1
