"""Hand-derived cases of the functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as G, similarity as S, text as T
from plinth.operators import catalogue as C, datasets as D, pages as P, ranking as R, reports


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "out"), [(" Torn-Lap. ", "torn lap "), ("Other.", "other "), ("Other", "other"), ("Café/Überlauf (N)", "café überlauf n ")])
def test_canon(spark, raw, out):
    assert one(spark, T.canon(F.col("c")), c=raw) == out


def test_newlines(spark):
    assert one(spark, T.fold_newlines(F.col("c")), c="Observation:\nTorn lap –\nnorth.\n\nFix\r\nit.") == "Observation: Torn lap - north.\n\nFix it."


@pytest.mark.parametrize(("raw", "out"), [("6.0 - Shingle", "6.0"), ("3) Walls", "3.0"), ("8.0 X", "8.0 X"), ("2", "2.0"), ("12.0", "12.0"), ("2.5 B", "2.0")])
def test_sheet_key(spark, raw, out):
    assert one(spark, T.sheet_key(F.col("c")), c=raw) == out


@pytest.mark.parametrize(("raw", "out"), [("(a)", "a"), ("b.", "b"), ("C:", "c"), ("ab", None), ("1", None), ("", None)])
def test_letter(spark, raw, out):
    assert one(spark, T.letter(F.col("c")), c=raw) == out


@pytest.mark.parametrize(("raw", "out"), [("pipes", "pip"), ("pipe", "pipe"), ("bodies", "body"), ("ties", "ti"), ("glass", "glass"), ("laps", "lap"), ("boxes", "box"), ("gas", "gas"), ("hoses", "hos")])
def test_singular(spark, raw, out):
    assert one(spark, T.singular(F.col("c")), c=raw) == out


def test_observation_ends_at_a_heading(spark):
    text = "Observation: torn lap.\nRecommendations: fix\nRecommendation: x"
    assert one(spark, T.observation_field(F.col("c")), c=text) == "torn lap.\nRecommendations: fix"
    assert one(spark, T.observation_field(F.col("c")), c="no heading") is None


def test_report_order(spark):
    rows = spark.createDataFrame([(x,) for x in ("20-063", "B-2", "17-057-16", "17-057-4", "b10")], "id string").orderBy(T.report_sort_key(F.col("id"))).collect()
    assert [r.id for r in rows] == ["B-2", "b10", "17-057-4", "17-057-16", "20-063"]


@pytest.mark.parametrize(("a", "b", "out"), [("torn laps", "torn lap", 0.99), ("torn lap edge", "torn lap", 0.9573), ("torn lap at north edge", "torn lap", 0), ("lap torn", "torn lap", 0)])
def test_containment(spark, a, b, out):
    assert one(spark, S.containment(F.col("a"), F.col("b")), a=a, b=b) == pytest.approx(out, abs=5e-5)


@pytest.mark.parametrize(("a", "b", "out"), [("torn lap at wall", "torn lap", 100), ("torn lap", "torn seam", 70.5882), ("open seam", "torn lap", 23.5294), ("any other issue", "other", 100)])
def test_token_set(a, b, out):
    assert S.token_set_ratio(a, b) == pytest.approx(out, abs=5e-4)


def test_keep_window_is_open(spark):
    box = lambda x0, x1, y0, y1: one(spark, G.in_keep_window(G.rect(*[F.lit(float(v)) for v in (x0, y0, x1, y1)])))
    assert not box(40, 226, 51, 201) and not box(125, 226, 51, 201) and box(41, 226, 51, 201)


def test_header_row(spark):
    assert one(spark, C.is_header(F.array(F.lit("Ridge cap")))) is True
    assert one(spark, C.is_header(F.array(F.lit("Lap")))) is False


def test_bm25(spark):
    docs = ["torn lap 1.0", "open seam", "torn edge metal cap"]
    items = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "ord int, t string").select("ord", F.split("t", " ").alias("terms"))
    asked = spark.createDataFrame([(0, ["torn", "lap"]), (1, ["torn", "torn", "lap"])], "q int, terms array<string>")
    got = {(r.q, r.ord): round(r.score, 4) for r in R.bm25(asked, items).collect()}
    assert got == {(0, 0): 1.4508, (0, 2): 0.4087, (1, 0): 1.9208, (1, 2): 0.8174}


def test_latch(spark):
    kinds = ["OTHER", "OBS", "OTHER", "BLOCK", "OTHER"]
    df = spark.createDataFrame([("r", i, k) for i, k in enumerate(kinds)], "g string, i int, k string")
    got = P.latch(df, "g", ["i"], "s", F.col("k") == "OBS", F.col("k") == "BLOCK").orderBy("i").collect()
    assert [r.s for r in got] == ["NONE", "OBS", "OBS", "NONE", "NONE"]


def test_toc_run(spark):
    rows = [("a", i, 6, t) for i, t in enumerate([False, False, True, True, False, True])] + [("b", i, 2, True) for i in range(2)]
    got = P.toc_ranges(spark.createDataFrame(rows, "report_id string, page0 int, n_pages int, toc boolean")).collect()
    assert [tuple(r) for r in got] == [("a", 2, 3)]


def test_diff(spark):
    schema = "key string, pages_used int, images int"
    before = spark.createDataFrame([("r1", 2, 5), ("r2", 1, 1), ("__totals__", 2, 6)], schema)
    now = spark.createDataFrame([("r1", 2, 7), ("r3", 1, 2)], schema)
    assert {r.key: r.status for r in reports.diff(before, now).collect()} == {"r1": "CHANGED", "r2": "REMOVED", "r3": "NEW", "__totals__": "REMOVED"}


def test_weights(spark):
    classes = spark.createDataFrame([(0,), (1,), (2,)], "class_index int")
    counts = spark.createDataFrame([(0,)] * 4 + [(1,)], "class_index int")
    got = {r.class_index: round(r.weight, 4) for r in D.normalised_weights(classes, counts).collect()}
    assert got == {0: 0.3333, 1: 1.3333, 2: 1.3333}


def test_temperature(spark):
    rows = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 1.0]), (1, [3.0, 0.0])], "y int, logits array<double>")
    r = D.best_temperature(rows).first()
    assert r.temperature == 3.0 and r.mean_nll == pytest.approx(0.7560, abs=5e-5)


def test_splits(spark):
    rows = spark.createDataFrame([(f"g{i % 7}", i) for i in range(50)], "g string, i int")
    split = {r.g: r.split for r in D.group_holdout(rows, "g").collect()}
    assert len(split) == 7 and sum(s == "test" for s in split.values()) == 2
    folds = {r.g: r.fold for r in D.group_kfold(rows, "g").collect()}
    assert len(folds) == 7 and set(folds.values()) == set(range(5))


def test_draws(spark):
    rows = spark.createDataFrame([(i, 1.0 if i % 2 else 3.0) for i in range(100)], "i int, w double")
    got = {r.i: r.times for r in D.weighted_draws(rows, "w", "i", 400).collect()}
    assert sum(got.values()) == 400 and all(v in (2, 3, 1, 6, 5, 7) for v in got.values())


def test_buckets(spark):
    rows = spark.createDataFrame([("a", "l", ".5"), ("b", "l", ".501"), ("c", "l", "x"), ("d", "l", None)], "image_file string, label string, confidence string")
    assert {r.image_file: r.bucket for r in reports.bucket_rows(rows).collect()} == {"a": "low", "b": "high", "c": "low", "d": "low"}


def test_folds_are_dealt_as_one_by_one():
    rng = np.random.default_rng(0)
    for _ in range(200):
        load, size, groups = [int(x) for x in rng.integers(0, 60, 5)], int(rng.integers(1, 9)), int(rng.integers(0, 40))
        plain, counts = list(load), [0] * 5
        for _ in range(groups):
            f = min(range(5), key=lambda j: (plain[j], j))
            plain[f] += size
            counts[f] += 1
        assert D.dealt(load, size, groups) == counts


def test_kfold_of_many_groups(spark):
    rows = spark.createDataFrame([(g,) for g in range(300) for _ in range(g % 7 + 1)], "g int")
    got = D.group_kfold(rows, "g").collect()
    assert len(got) == 300 and len({r.g for r in got}) == 300
    load = [sum(r.g % 7 + 1 for r in got if r.fold == f) for f in range(5)]
    assert max(load) - min(load) <= 1


def test_remap_weights_and_decoding(spark):
    rows = spark.createDataFrame([(1, 7), (2, 3), (3, 7), (4, 9)], "i int, class_index int")
    remap = D.dense_remap(rows.where("i < 4"))
    assert {(r.i, r.class_index_remap) for r in D.remapped(rows, remap).collect()} == {(1, 1), (2, 0), (3, 1)}
    weights = D.inverse_weights(remap, rows)
    assert {(r.i, r.weight) for r in D.row_weights(rows, weights).collect()} == {(1, 0.5), (2, 1.0), (3, 0.5), (4, 0.0)}
    items = spark.createDataFrame([(7, "x", "X", "1.0")], "ord int, id string, label string, sheet string")
    got = D.decoded(spark.createDataFrame([(1, 1), (2, 0), (3, 5)], "i int, pred int"), remap, items).collect()
    assert {(r.i, r.class_index, r.observation_id) for r in got} == {(1, 7, "x"), (2, 3, None), (3, None, None)}


def test_fixed_digits_are_those_of_the_binary_value(spark):
    rng = np.random.default_rng(5)
    values = [0.7995, 0.8125, 0.0005, 0.0, 1.0, 0.9996, 1.03, 12.3455, *((np.arange(1000) * 10 + 5) / 10000), *rng.random(500), *rng.random(50) / 1000]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (2, 3, 6):
        assert [(r.v, r.t) for r in frame.select("v", T.fixed(F.col("v"), digits).alias("t")).collect()] == [(float(v), f"{v:.{digits}f}") for v in values]


def test_rounded_goes_by_the_scaled_double(spark):
    assert one(spark, S.rounded(F.col("c"), 4), c=0.35505) == 0.355 and one(spark, S.rounded(F.col("c"), 4), c=0.27546) == 0.2755
