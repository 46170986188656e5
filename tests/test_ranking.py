"""Texts are ranked where they are; beyond the index they are joined, with the same results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.operators import cascade as K, ranking as R
from plinth.plans import catalogue

QUERIES = catalogue.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["bm25_rank", "tfidf_rank", "light_infer"])
def test_terms_are_never_rows(spark, sf_dir, name):
    shown = plan(QUERIES[name](spark, sf_dir))
    assert "Generate" not in shown and "Window" not in shown


def test_rankers_in_place_and_joined(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(80)] + [(90, None), (91, ""), (92, "unknown only"), (93, "w1")]
    items = spark.createDataFrame([(7 * i + 1, [str(w) for w in rng.choice(words[:50], rng.integers(1, 9))]) for i in range(30)], "ord long, terms array<string>")
    asked = spark.createDataFrame(texts, "q long, text string")
    rows = lambda: {r.q: r.asDict(True) for r in R.best_by_terms(asked, items).collect()}
    placed = rows()
    monkeypatch.setattr(R, "INDEX_ROWS", 0)
    joined = rows()
    assert placed.keys() == joined.keys() == {q for q, _ in texts}
    for q, a in placed.items():
        for kind in ("bm25", "tfidf"):
            x, y = a[kind], joined[q][kind]
            assert (x is None) == (y is None)
            if x:
                assert x["ord"] == y["ord"] and x["score"] == pytest.approx(y["score"], abs=2e-6) and (x["second"] is None) == (y["second"] is None)
    assert placed[90]["bm25"] is None and placed[92]["tfidf"] is None


def test_light_needs_no_shuffle_of_texts(spark):
    items = spark.createDataFrame([(1, "A", "torn lap seam", "2.0", "torn lap seam"), (2, "B", "debris", "3.0", "debris")], "ord long, id string, label string, sheet_key string, label_terms string")
    texts = spark.createDataFrame([(1, "trash and leaves blocked the flow of debris"), (2, "a torn lap at the seam, torn lap"), (3, "nothing here"), (4, None)], "q long, text string")
    found = K.lighted(texts, items)
    assert "Exchange" not in plan(found)
    got = {r.q: (r.light.method, r.light.ord) if r.light else None for r in found.collect()}
    assert got == {1: ("rules", 2), 2: ("bm25", 1), 3: None, 4: None}


def test_rules_of_many_parts_are_dealt(spark, tmp_path):
    """A table of one row group is dealt to all cores, and a part's text is normalised once."""
    spark.range(3000).select(F.col("id").alias("p_partkey"), F.lit("pipe").alias("p_name"), F.lit("SMALL").alias("p_type")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("rule_info", "keyword_prior", "rule_score", "char_grams"):
        shown = QUERIES[name](spark, str(tmp_path))
        assert shown.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_cascade_writes_no_texts(spark, monkeypatch, sf_dir):
    written = []
    real = K.staged
    monkeypatch.setattr(K, "staged", lambda df, tag: written.append((tag, df.columns)) or real(df, tag))
    QUERIES["label_cascade"](spark, sf_dir).count()
    assert {t for t, _ in written} == {"items", "maps", "decided"}
    assert not {"text", "panel_raw", "observation_raw", "page_text"} & {c for _, columns in written for c in columns}


def test_gate_sorts_no_texts(spark, sf_dir):
    from plinth.plans import page_plans as PP

    assert "raw_text" not in PP.gated(spark, sf_dir).columns  # the windows stand below, with the same rows


def test_right_texts_are_made_as_needed(spark):
    """Where a strategy finds enough, the texts of those behind it are not made: they stand behind a test of its length."""
    from plinth.operators import pages as P

    rect = "struct<x0: double, y0: double, x1: double, y1: double>"
    page = (0.0, 0.0, 612.0, 792.0)
    images = spark.createDataFrame([("r", 1, 1, (50.0, 100.0, 250.0, 300.0), page), ("s", 1, 1, (50.0, 100.0, 250.0, 300.0), page)], f"report_id string, page int, image_id int, r {rect}, pg {rect}")
    blocks = spark.createDataFrame([("r", 1, 1, (300.0, 120.0, 500.0, 160.0), "x" * 90 + "\nPage 1 of 2"), ("s", 1, 1, (300.0, 400.0, 500.0, 440.0), "y" * 50)], f"report_id string, page int, block_no int, r {rect}, text string")
    got = {r.report_id: (r.strategy, r.right_text, r.footer_dropped) for r in P.right_text(images, blocks).collect()}
    assert got == {"r": ("primary", "x" * 90, True), "s": ("proximity-right-half", "y" * 50, False)}
    shown = P.right_text(images, blocks)._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("CASE WHEN") >= 3 and "n0" in shown
