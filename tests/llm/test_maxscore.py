import numpy as np

from conftest import rows_of
from plinth.llm import maxscore as M, queries


def brute(ids, x, q_ids, q, k):
    out = set()
    for i, v in zip(q_ids, q, strict=True):
        scored = sorted(((-int(s), int(d)) for d, s in zip(ids, x @ v, strict=True) if d != i))[:k]
        out |= {(int(i), r + 1, d, -s) for r, (s, d) in enumerate(scored)}
    return out


def test_shards_match_brute_force():
    rng = np.random.default_rng(2)
    for n, dims, spread in ((5, 3, 2), (300, 16, 3), (2000, 64, 1000)):
        x = rng.integers(-spread, spread + 1, (n, dims)).astype(float)
        ids = rng.permutation(n)
        q = x[:20]
        a, b, c = M.search_shard(ids, x, ids[:20], q, 10)
        got = {(int(i), int(d), int(s)) for i, d, s in zip(a, b, c, strict=True)}
        assert got == {(i, d, s) for i, _, d, s in brute(ids, x, ids[:20], q, 10)}


def test_merging_and_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (400, 8))
    df = spark.createDataFrame([(i, [int(v) for v in x[i]]) for i in range(400)], "id long, v array<long>")
    got = M.top_k(df, df.where("id % 10 = 0"), 10, shard_rows=37).collect()
    want = brute(np.arange(400), x, np.arange(0, 400, 10), x[::10], 10)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_numbers_beyond_floats_and_repeated_rows(spark):
    big = 1_500_000_001
    rows = [(i, [big + i, -big + 2 * i, i]) for i in range(40)] + [(7, [big + 7, -big + 14, 7])] * 30 + [(50, [1] * 9)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    q = [(10 * i, rows[10 * i][1]) for i in range(4)]
    want = set()
    for i, v in q:
        scored = sorted((-sum(a * b for a, b in zip(v, x, strict=False)), d) for d, x in rows if d != i)[:10]
        want |= {(i, r + 1, d, -s) for r, (s, d) in enumerate(scored)}
    got = M.top_k(df, spark.createDataFrame(q, "id long, v array<long>"), 10, shard_rows=9).collect()
    assert {tuple(r) for r in got} == want and len(got) == 40


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (None, [1.0, 1.0]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, [float("inf"), 1.0]), (100, [0.25]), (100, [0.25]), (7, []), (8, [-0.0001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = M.quantise(df)
    assert {(r.id, tuple(r.v)) for r in v.collect()} == {(0, (1024, 512)), (100, (256,)), (7, ()), (8, (-1, 0))}
    got = {tuple(r) for r in M.top_k(v, v.where("id % 100 = 0")).collect()}
    assert {g for g in got if g[0] == 0} == {(0, 1, 100, 262144), (0, 2, 100, 262144), (0, 3, 7, 0), (0, 4, 8, -1024)}
    assert {g for g in got if g[0] == 100} == {(100, 1, 0, 262144), (100, 2, 7, 0), (100, 3, 8, -256)}
    assert M.top_k(v.limit(0), v.limit(0)).count() == 0


def test_query(spark, duck, sf_dir):
    assert rows_of(queries.op4_maxscore(spark, sf_dir).toPandas()) == rows_of(duck.execute(queries.oracle_sql()["op4_maxscore"]).df())
