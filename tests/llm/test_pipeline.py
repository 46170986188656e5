"""The pipeline against a plain version of itself."""

import importlib.util

import pytest

from plinth.llm import common, mixing, packing, pii, simhash_groups, toxicity

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("the pipeline isn't here", allow_module_level=True)
import corpus_pipeline as C


def plain_rake(cells):
    """Probability of each cell, by scaling each value's cells to its wanted tokens, step by step."""
    total, p = sum(cells.values()), {k: mixing.FRACTION for k, n in cells.items() if n}
    wanted = []
    for d in range(3):
        supply = {}
        for k, n in cells.items():
            if n:
                supply[k[d]] = supply.get(k[d], 0) + n
        share = {v: n**mixing.POWER / sum(m**mixing.POWER for m in supply.values()) for v, n in supply.items()}
        full = set()
        while True:  # values that run short give all they have
            rest = mixing.FRACTION * total - sum(supply[v] for v in full)
            factor = rest / sum(share[v] for v in supply if v not in full)
            more = {v for v in supply if v not in full and factor * share[v] >= supply[v]}
            if not more:
                break
            full |= more
        wanted.append({v: supply[v] if v in full else factor * share[v] for v in supply})
    for _ in range(mixing.ROUNDS):
        for d in range(3):
            for v, want in wanted[d].items():
                own = sorted((k for k in p if k[d] == v), key=lambda k: -p[k])
                cuts = [(want - sum(cells[k] for k in own[:i])) / sum(cells[k] * p[k] for k in own[i:]) for i in range(len(own))]
                for k in own:
                    p[k] *= max(cuts)
    return {k: min(1.0, p.get(k, 1.0)) for k in cells}


def plain_topic(text):
    return next((name for name, part in mixing.TOPICS if part in text.lower()), "general")


def test_stages_and_run(spark):
    sf_dir = "/root/testdata/sf0.01"  # in fewer rows there is nothing to learn toxicity from
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "packing"]
    docs = common.table(spark, sf_dir, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    clean = {d: r for d, r in rows.items() if model.severity(r.text) < toxicity.REJECT_AT}
    assert 0 < len(clean) < len(rows)

    stage = {}
    df = docs
    for name, f in C.STAGES:
        df = common.materialize(f(spark, df, sf_dir), f"test-{name}")
        stage[name] = df
        if name != "packing":
            assert df.columns == docs.columns and df.dtypes == docs.dtypes
    ids = lambda n: {r.doc_id for r in stage[n].select("doc_id").collect()}
    assert ids("toxicity") == set(clean)
    assert ids("near_dedup") < set(clean)
    check_survivors(clean, ids("near_dedup"))

    p = pii.Pseudonymiser(pii.session_key(spark))
    private = {r.doc_id: r.text for r in stage["pii"].collect()}
    assert private == {d: p.replace(clean[d].text)[0] for d in ids("near_dedup")}

    import hashlib
    import re

    cells, key = {}, {}
    for d, t in private.items():
        key[d] = (clean[d].source, clean[d].lang, plain_topic(t))
        n = len(re.findall(r"[^ \t\n\x0b\f\r]+", t))
        cells[key[d]] = cells.get(key[d], 0) + n
    probability = plain_rake(cells)
    chosen = {d for d in private if int(hashlib.md5(str(d).encode()).hexdigest()[:8], 16) / 2**32 < probability[key[d]]}
    assert ids("mixing") == chosen

    packed = stage["packing"].toPandas()
    assert set(packed.doc_id) == chosen
    assert packed.sequence_id.nunique() <= 1 + 1.01 * packing.lower_bound(packed.length.to_numpy())
    again = C.run(spark, sf_dir).toPandas()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, again[columns].itertuples(index=False))) == sorted(map(tuple, packed[columns].itertuples(index=False)))


def check_survivors(clean, kept):
    """Of texts surely similar one stays; whoever went has a similar text that stayed or went."""
    sets = {d: set(simhash_groups.shingle_hashes(r.text).tolist()) for d, r in clean.items()}
    near = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    for d in clean:
        likeness = [(near(d, e), e) for e in clean if e != d]
        if d in kept:
            assert not any(s > 0.9 and e in kept for s, e in likeness), d
        else:
            assert max(likeness)[0] > 0.75, d
    assert min(clean) in kept


def test_odd_tables(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, __p string, severity double"
    odd = spark.createDataFrame([(None, None, None, None, None, "x", 1.0), (1, "", "en", "s", 0, "x", 1.0), (1, "", "en", "s", 0, "x", 1.0), (2, "word " * 20_000, "en", "s", 5, "x", 1.0)], schema)
    for df in (odd, odd.limit(0)):
        for name, f in C.STAGES:
            df = common.materialize(f(spark, df, sf_dir), f"odd-{name}")
            assert name == "packing" or df.columns == odd.columns
