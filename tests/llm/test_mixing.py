import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from plinth.llm import mixing as M, queries


CELL = "__plinth_source string, __plinth_lang string, __plinth_topic string, tokens long"


def test_marginals(spark):
    cells = [(s, l, t, (i * 37 + 11) % 90 + 5) for i, (s, l, t) in enumerate((s, l, t) for s in "abc" for l in ("en", "de") for t in ("x", "y"))]
    df = spark.createDataFrame(cells, CELL)
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.25, "y": 0.75, "absent": 3.0}}
    targets["topic"] = {k: v * 2 for k, v in targets["topic"].items()}  # shares need no unit, absent values don't count
    got = M.rake(df, targets, fraction=0.3).toPandas()
    got["w"] = got.tokens * got.probability / got.tokens.sum() / 0.3
    assert got.w.sum() == pytest.approx(1) and got.probability.max() <= 1
    for d, t in (("source", targets["source"]), ("lang", targets["lang"]), ("topic", {"x": 0.25, "y": 0.75})):
        assert got.groupby(f"__plinth_{d}").w.sum().to_dict() == pytest.approx(t, abs=1e-3)


def test_default_targets_favour_small_groups(spark):
    df = spark.createDataFrame([("big", "en", "g", 900), ("small", "en", "g", 100)], CELL)
    w = {r["__plinth_source"]: r.tokens * r.probability for r in M.rake(df, power=0.5, fraction=0.2).collect()}
    assert w == pytest.approx({"big": 150, "small": 50})


def test_short_values_give_all_and_others_make_up_for_it(spark):
    df = spark.createDataFrame([("big", "en", "g", 800), ("mid", "en", "g", 150), ("small", "en", "g", 50)], CELL)
    got = {r["__plinth_source"]: r.tokens * r.probability for r in M.rake(df, {"source": {"big": 1, "mid": 1, "small": 2}}, fraction=0.6).collect()}
    assert got == pytest.approx({"big": 400, "mid": 150, "small": 50})  # small can give 50 of 300, mid 150 of 275
    none = M.rake(df, {"topic": {"other": 1.0}}, fraction=0.6).toPandas()
    assert (none.tokens * none.probability).sum() == pytest.approx(600)


def test_topics_come_first_where_targets_exclude_each_other(spark):
    """All of topic t is in source a, and t needs more of it than a's share leaves."""
    df = spark.createDataFrame([("a", "en", "t", 300), ("a", "en", "g", 100), ("b", "en", "g", 600)], CELL)
    got = M.rake(df, {"source": {"a": 0.2, "b": 0.8}, "topic": {"t": 0.5, "g": 0.5}}, fraction=0.6).toPandas()
    has = got.tokens * got.probability
    assert got.probability.between(0, 1).all() and has.groupby(got["__plinth_topic"]).sum().to_dict() == pytest.approx({"t": 300, "g": 300}, rel=1e-3)
    assert has.groupby(got["__plinth_source"]).sum()["a"] == pytest.approx(300, rel=0.01)


def water_filled(supply, share, total):
    """The plain way: saturate the values that run short until none does."""
    full = np.zeros(len(supply), bool)
    while True:
        factor = (total - supply[full].sum()) / share[~full].sum()
        more = full | (factor * share >= supply)
        if (more == full).all():
            return np.where(full, supply, factor * share)
        full = more


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_shares_on_the_drivers_tables(spark, sf):
    got = M.shares(queries.table(spark, f"/root/testdata/{sf}", "documents")).toPandas()
    tokens = queries.table(spark, f"/root/testdata/{sf}", "documents").select(M.tokens(F.col("text")).alias("t")).agg(F.sum("t")).first()[0]
    supply = {d: g for d, g in M.margins(M.cells_of(queries.table(spark, f"/root/testdata/{sf}", "documents")).where("tokens > 0")).toPandas().groupby("dim")}
    for d, g in got.groupby("dimension"):
        g = g.sort_values("value")
        has = supply[f"__plinth_{d}"].sort_values("value").supply.to_numpy()
        assert g.share.to_numpy() == pytest.approx(np.sqrt(has) / np.sqrt(has).sum())
        want = water_filled(has, g.share.to_numpy(), M.FRACTION * tokens) / (M.FRACTION * tokens)
        assert np.abs(g.wanted - want).max() < 1e-9 and np.abs(g.achieved - want).max() < 1e-3
        assert g.achieved_of_all.sum() == pytest.approx(M.FRACTION, abs=1e-3)


def docs(spark):
    rows = [(i, "word " * (i % 9 + 1), ["en", "de", None][i % 3], f"s{i % 4}" if i % 11 else None, "clash") for i in range(600)]
    rows += [(None, "no id", "en", "s1", "c"), (700, None, "en", "s1", "c"), (701, "", "fr", "empty", "c"), (3, "word " * 4, "en", "s3", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, probability string")


def test_sampling(spark):
    df = docs(spark)
    out = M.mixed(df).toPandas()
    assert len(out) == df.count() and out.probability.between(0, 1).all()
    assert set(out.source) >= {"unknown", "empty"} and out[out.source == "empty"].selected.all()
    kept = M.sample(df)
    assert kept.columns == df.columns and kept.count() == out.selected.sum()
    assert rows_of(M.mixed(df.repartition(13)).toPandas()) == rows_of(out)
    expected = (out.probability * out.tokens).sum()
    assert expected == pytest.approx(M.FRACTION * out.tokens.sum(), rel=0.001)
    assert out[out.selected].tokens.sum() == pytest.approx(expected, rel=0.15)
    assert M.mixed(df.limit(0)).count() == 0 and M.sample(df.limit(0)).count() == 0


def test_plan_is_native(spark, sf_dir):
    plan = queries.op6_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query(spark, duck, sf_dir):
    got = queries.op6_mixing(spark, sf_dir)
    assert rows_of(got.toPandas()) == rows_of(duck.execute(queries.oracle_sql()["op6_mixing"]).df())
    assert got.where("tokens > 0").agg(F.min("probability")).first()[0] > 0
