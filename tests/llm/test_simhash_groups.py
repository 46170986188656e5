import numpy as np
import pytest

from plinth.llm import simhash_groups as G


def corpus(n=60, seed=0):
    """Texts with near copies of known similarity."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(n):
        base = list(rng.choice(vocabulary, int(rng.integers(60, 900))))
        out.append(base)
        for share in (0.005, 0.01, 0.02, 0.06):
            near = [rng.choice(vocabulary) if rng.random() < share else w for w in base]
            out.append(near)
    return [" ".join(t) for t in out]


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_groups_hold_similar_texts(spark):
    texts = corpus()
    sets = [G.shingle_hashes(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r.doc_id: r.group_id for r in G.groups(df).collect()}
    found = missed = 0
    for i in range(0, len(texts), 5):
        for j in range(i, i + 5):
            for k in range(j + 1, i + 5):
                s = jaccard(sets[j], sets[k])
                if s >= 0.82:
                    found += group[j] == group[k]
                    missed += group[j] != group[k]
    assert found and missed / (found + missed) < 0.03
    for i in range(len(texts)):
        if group[i] != i:  # whoever follows has a similar text before or after it in its group
            assert max(jaccard(sets[i], sets[j]) for j in range(len(texts)) if j != i and group[j] == group[i]) > 0.75
    for i in range(0, len(texts), 5):
        assert group[i] // 5 == i // 5


def test_chunks_of_a_large_shard_lose_nothing(spark):
    base = " ".join(f"word{i}" for i in range(300))
    texts = [base + f" tail{i}" for i in range(120)] + [" ".join(f"other{i}x{j}" for j in range(50)) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for shard_rows in (16, 4096):
        group = [r.group_id for r in G.groups(df, shard_rows=shard_rows).orderBy("doc_id").collect()]
        assert group == [0] * 120 + list(range(120, 150))


def test_spanning_forest_is_minimal():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, (60, 2), np.uint64)
    fps[30:] = fps[:30] ^ (np.uint64(1) << rng.integers(0, 40, (30, 1), np.uint64))
    links = G.spanning_links(fps, np.zeros(60, np.int64), 8)
    d = lambda i, j: int(np.bitwise_count(fps[i] ^ fps[j]).sum())
    assert len(links) == 30 and all(d(i, j) <= 2 for i, j in links)
    assert len(G.spanning_links(fps, np.zeros(60, np.int64), 128)) == 59
    assert len(G.spanning_links(fps, np.array([1] * 30 + [2] * 30), 8)) == 30
    assert len(G.spanning_links(fps, np.array([1] * 60), 128)) == 0


@pytest.mark.parametrize("n", [0, 1, 5, 300, 5000])
def test_bits_and_sketches(n):
    h = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64))
    naive = np.array([int(((h >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)])
    assert (G._counts(h) == naive).all()
    half = h[::2]
    assert G.sketch_similarity(h[:256].tobytes(), h[:256].tobytes()) == 1
    assert G.sketch_similarity(h[:256].tobytes(), half[:256].tobytes()) == pytest.approx(jaccard(h, half), abs=0.12)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (None, None), (6, "x" * 100_000), (7, "many words " * 30_000)]
    df = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, fp string, group_id int")
    kept = G.representatives(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept.collect()) == sorted([(1, ""), (4, "One two"), (0, "one two"), (0, ""), (6, "x" * 100_000), (7, "many words " * 30_000)])
    assert G.representatives(df.limit(0)).count() == 0


def test_plan_grows_with_the_corpus():
    small, large = G.plan(10**4), G.plan(10**8)
    assert small[0] < large[0] and small[1] < large[1]
    for n in (1, 10**3, 10**6, 10**9):
        bits, blocks, most = G.plan(n)
        assert -(-bits * blocks // 64) * 64 - bits < bits * blocks and most < bits * blocks / 2


def brute_groups(sets, similarity=G.SIMILARITY):
    """The least index of each single-linkage group."""
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if group[i] != group[j] and jaccard(sets[i], sets[j]) >= similarity:
                lo, hi = sorted((group[i], group[j]))
                group = [lo if g == hi else g for g in group]
    return group


def edited(rng, base, share):
    """base with words replaced until the similarity of the shingle sets is about ``share``."""
    out, own, mark = list(base), G.shingle_hashes(" ".join(base)), int(rng.integers(1 << 40))
    for n, at in enumerate(rng.permutation(len(base))):
        tried = [*out[:at], f"z{mark}x{n}", *out[at + 1 :]]
        if jaccard(G.shingle_hashes(" ".join(tried)), own) < share:
            return out
        out = tried
    return out


def test_copies_of_one_text_that_differ_among_themselves(spark):
    """Copies at 0.8 to 0.87 of one text are about 0.7 to each other: each has its link to the text only."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 204)]
    texts = [" ".join(base)] + [" ".join(edited(rng, base, share)) for share in rng.uniform(0.8, 0.87, 150)]
    sets = [G.shingle_hashes(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_groups(sets)
    assert want == [0] * len(texts)
    assert [r.group_id for r in G.groups(df).orderBy("doc_id").collect()] == want


def test_large_components_are_dealt_out(spark):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 204)]
    texts = [" ".join(base)] + [" ".join(edited(rng, base, share)) for share in rng.uniform(0.77, 0.87, 40)]
    sets = [G.shingle_hashes(t) for t in texts]
    key = lambda i: i.to_bytes(2, "big")
    candidates = spark.createDataFrame([(key(i), b"c") for i in range(len(sets))], "fp binary, component binary")
    held = spark.createDataFrame([(key(i), h.tobytes()) for i, h in enumerate(sets)], "fp binary, hashes binary")
    group = list(range(len(sets)))
    for r in G.verified_links(candidates, held, unit=8).collect():
        lo, hi = sorted((group[int.from_bytes(r.a, "big")], group[int.from_bytes(r.b, "big")]))
        group = [lo if g == hi else g for g in group]
    assert group == brute_groups(sets) and len(set(group)) > 1


def test_long_texts_are_decided_by_whole_sets(spark):
    """Pairs of 1,200 shingles next to 0.8, where the least 256 hashes say otherwise for many."""
    rng, texts = np.random.default_rng(7), []
    for _ in range(30):
        base = [f"w{i}" for i in rng.integers(0, 10**6, 1204)]
        texts += [" ".join(base), " ".join(edited(rng, base, rng.uniform(0.78, 0.82)))]
    sets = [G.shingle_hashes(t) for t in texts]
    pairs = range(0, len(sets), 2)
    want = [jaccard(sets[i], sets[i + 1]) >= 0.8 for i in pairs]
    assert 5 < sum(want) < 25
    assert [G.sketch_similarity(sets[i][:256].tobytes(), sets[i + 1][:256].tobytes()) >= 0.8 for i in pairs] != want
    key = lambda i: i.to_bytes(2, "big")
    candidates = spark.createDataFrame([(key(i), key(i // 2)) for i in range(len(sets))], "fp binary, component binary")
    held = spark.createDataFrame([(key(i), h.tobytes()) for i, h in enumerate(sets)], "fp binary, hashes binary")
    linked = {int.from_bytes(r.a, "big") // 2 for r in G.verified_links(candidates, held).collect()}
    assert linked == {i // 2 for i, w in zip(pairs, want, strict=True) if w}


def test_short_texts_lose_no_link(spark):
    """Nine words against the same without the last: five and four shingles, similarity 0.8. And all other lengths up to FEW."""
    rng, texts = np.random.default_rng(8), []
    for i in range(400):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 9 + i % 28)]
        cut = max(1, (len(words) - 4) // 5)
        texts += [" ".join(words), " ".join(words[:-cut])]
    sets = [G.shingle_hashes(t) for t in texts]
    assert all(jaccard(sets[i], sets[i + 1]) >= 0.8 for i in range(0, len(sets), 2))
    few = spark.createDataFrame([(i.to_bytes(2, "big"), h.tobytes()) for i, h in enumerate(sets)], "fp binary, few binary")
    found = {tuple(sorted((int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")))) for r in G.few_links(few, len(sets)).collect()}
    assert found == {(i, i + 1) for i in range(0, len(sets), 2)}
