"""Every registered query of the engine's own operators against its SQL."""

import pytest

from conftest import rows_of
from plinth.functions import similarity as S
from plinth.plans import catalogue
from plinth.plans.text_plans import PART_TEXT_SQL

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got)
    if name in SQL:
        assert rows_of(got) == rows_of(duck.execute(SQL[name]).df())
    else:
        assert name in PLAIN
        PLAIN[name](got, duck)


def plain_token_set(got, duck):
    """Each text against each item, one by one."""
    parts = duck.execute(f"SELECT p_partkey, {PART_TEXT_SQL} AS t FROM part").fetchall()
    items = duck.execute("SELECT min(p_partkey) AS ord, p_type FROM part GROUP BY p_type ORDER BY ord").fetchall()
    best = {}
    for k, t in parts:
        scores = [(max(S.token_set_ratio(t.lower(), label.lower()) / 100, 0.0), -o) for o, label in items]
        best[k] = max((round(s, 6), o) for s, o in scores)
    for r in got.itertuples():
        assert r.score >= best[r.p_partkey][0] - 1e-6  # containment can lift it
    assert len(got) == len(parts)


def plain_kfold(got, duck):
    """Groups by size, each to the lightest fold; which of equal groups goes where is free."""
    sizes = dict(duck.execute("SELECT source, count(*) FROM documents GROUP BY source").fetchall())
    load = [0] * 5
    for n in sorted(sizes.values(), reverse=True):
        load[min(range(5), key=lambda j: (load[j], j))] += n
    assert got.groupby(got.fold).source.apply(lambda s: sum(sizes[x] for x in s)).to_dict() == dict(enumerate(load)) and len(got) == len(sizes)


PLAIN = {"fuzzy_token_set": plain_token_set, "group_kfold": plain_kfold}


def test_entry_needs_no_training_data_operators():
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "plinth"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "plinth.llm" not in p.read_text(), p
