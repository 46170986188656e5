from collections import Counter

import pytest

from plinth.llm import queries, token_rollup as R

KEYS = "doc_id long, kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"


def test_batches(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    assert r.totals().count() == 0
    first = spark.createDataFrame([(1, "insert", "a", "en", "v1", 10, None), (2, "insert", "a", "en", "v1", 5, None), (3, "insert", None, None, "v1", None, None)], KEYS)
    second = spark.createDataFrame([(1, "revise", "a", "en", "v1", 12, 10), (2, "delete", "a", "en", "v1", 5, None), (4, "insert", "a", "en", "v2", 7, None), (4, "insert", "a", "en", "v2", 7, None)], KEYS)
    want = {("a", "en", "v1"): (1, 12), ("unknown", "unknown", "v1"): (1, 0), ("a", "en", "v2"): (2, 14)}
    got = lambda: {tuple(x)[:3]: tuple(x)[3:] for x in r.totals().collect()}
    assert r.commit("b1", first) and r.commit("b2", second) and not r.commit("b1", first)
    assert got() == want
    r.compact()
    assert got() == want and r.committed() == ["b1", "b2"] and not r.commit("b2", second)
    assert r.commit("b3", first.limit(0)) and got() == want
    r.compact()
    assert got() == want and r.committed() == ["b1", "b2", "b3"]


def test_commit_during_a_compaction_counts_once(spark, tmp_path, monkeypatch):
    r, other = R.Rollup(spark, str(tmp_path / "r")), R.Rollup(spark, str(tmp_path / "r"))
    batch = lambda i: spark.createDataFrame([(i, "insert", "a", "en", "v1", 10, None)], KEYS)
    r.commit("b1", batch(1))
    before = r.totals()
    plain = r._sum
    monkeypatch.setattr(r, "_sum", lambda folders: other.commit("b2", batch(2)) and plain(folders))
    assert r.compact()
    monkeypatch.undo()
    assert [(x.documents, x.tokens) for x in r.totals().collect()] == [(2, 20)]
    assert [(x.documents, x.tokens) for x in before.collect()] == [(1, 10)]  # what was asked for before can still be read
    assert r.committed() == ["b1", "b2"] and not r.commit("b1", batch(1)) and not r.commit("b2", batch(2))
    assert r.compact()
    r.vacuum()
    assert [(x.documents, x.tokens) for x in r.totals().collect()] == [(2, 20)]


def test_two_writers_of_one_batch(spark, tmp_path, monkeypatch):
    """Both see that the batch isn't there; one manifest is made. Two compactions of one base likewise."""
    r, other = R.Rollup(spark, str(tmp_path / "r")), R.Rollup(spark, str(tmp_path / "r"))
    batch = spark.createDataFrame([(1, "insert", "a", "en", "v1", 10, None)], KEYS)
    won = []
    plain = r._write
    monkeypatch.setattr(r, "_write", lambda df: won.append(other.commit("b1", batch)) or plain(df))
    assert not r.commit("b1", batch) and won == [True]
    monkeypatch.setattr(r, "_write", lambda df: won.append(other.compact()) or plain(df))
    assert not r.compact() and won == [True, True]
    assert [(x.documents, x.tokens) for x in r.totals().collect()] == [(1, 10)]


def test_lost_writer_leaves_nothing(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "r"))
    bad = spark.createDataFrame([(1, "merge", "a", "en", "v1", 1, None)], KEYS)
    with pytest.raises(Exception, match="unknown kind"):
        r.commit("b", bad)
    assert r.totals().count() == 0 and r.committed() == []
    with pytest.raises(ValueError, match="batch id"):
        r.commit("a/b", bad)


def test_query_matches_a_recount(spark, sf_dir):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = Counter()
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for name, n in ((R.BPE, len(t.encode(d.text, add_special_tokens=False).ids)), (R.WORDS, len(d.text.split()))):
            want[(d.source, d.lang, name, "d")] += 1
            want[(d.source, d.lang, name, "t")] += n
    got = Counter()
    for r in queries.op7_token_rollup(spark, sf_dir).collect():
        got[(r.source, r.lang, r.tokenizer, "d")] += r.documents
        got[(r.source, r.lang, r.tokenizer, "t")] += r.tokens
    assert got == want


def test_odd_documents(spark):
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, "", "s", "en", "x"), (1, "a b" * 50_000, "s", "en", "x")], "doc_id long, text string, source string, lang string, bpe string")
    got = {(r.source, r.words > 0) for r in R.counted(df).collect()}
    assert got == {("unknown", False), ("s", False), ("s", True)}
