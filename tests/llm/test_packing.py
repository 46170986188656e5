import itertools
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from plinth.llm import common, packing as K, queries


def fewest(lengths, size):
    """The optimum, by trying all orders of first fit."""
    best = len(lengths)
    for order in set(itertools.permutations(lengths)):
        bins = []
        for x in order:
            for i, b in enumerate(bins):
                if b + x <= size:
                    bins[i] += x
                    break
            else:
                bins.append(x)
        best = min(best, len(bins))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=6))
def test_bound_and_packing(lengths):
    a = np.array(lengths)
    bins, offsets, n = K.best_fit_decreasing(a, 12)
    assert K.lower_bound(a, 12) <= fewest(lengths, 12) <= n
    check(bins, offsets, a, 12)


def check(bins, offsets, lengths, size):
    order = np.lexsort((offsets, bins))
    at, last = 0, None
    for b, o, n in zip(bins[order], offsets[order], lengths[order], strict=True):
        at = 0 if b != last else at
        assert o == at
        at, last = at + n, b
        assert at <= size


def test_repacking_helps(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), 0, 0, int(n), 0) for i, n in enumerate(rng.integers(150, 700, 3000))]
    found = common.materialize(spark.createDataFrame(rows, K._PIECE), "pieces")
    plain = K.pack(found, rounds=0, partition_pieces=100).toPandas()
    better = K.pack(found, rounds=2, partition_pieces=100).toPandas()
    assert len(plain) == len(better) == 3000
    assert K.lower_bound(better.length.to_numpy()) <= better.sequence_id.nunique() < plain.sequence_id.nunique()
    for t in (plain, better):
        check(t.sequence_id.to_numpy(), t.offset.to_numpy(), t.length.to_numpy(), K.SIZE)


def test_query_against_tokenizers(spark, sf_dir):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    got = queries.op9_packing(spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    by = {d: g.sort_values("piece") for d, g in got.groupby("doc_id")}
    for d in docs:
        ids = [*t.encode(d.text or "", add_special_tokens=False).ids, 2]
        g = by[d.doc_id]
        assert list(g.piece) == list(range(len(g))) and g.length.sum() == len(ids) and (g.length.iloc[1:] == K.SIZE).all()
        for start, n, crc in zip(g.start, g.length, g.ids_crc32, strict=True):
            assert zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()) == crc
    check(got.sequence_id.to_numpy(), got.offset.to_numpy(), got.length.to_numpy(), K.SIZE)
    assert got.sequence_id.nunique() <= K.lower_bound(got.length.to_numpy()) * 1.01 + 1


def test_added_tokens_are_those_of_tokenizers(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "<|endoftext", "end <|endoftext|>", "plain\u2003wide  spaces \n\n 123 ñ 漢字 🙂"]
    got = K.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        ids = [*t.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_pools_widen_until_one_is_left(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), 0, 0, int(n), 0) for i, n in enumerate(rng.integers(150, 700, 3400))]
    found = common.materialize(spark.createDataFrame(rows, K._PIECE), "pieces")
    two, all_ = (K.certificate(common.materialize(K.pack(found, rounds=r, partition_pieces=100), "packed")) for r in (2, None))
    assert all_["bound"] == two["bound"] <= all_["sequences"] <= two["sequences"]


def test_odd_documents(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "word " * 30_000, 1)], "doc_id long, text string, offset int")
    got = K.pack(common.materialize(K.pieces(df), "pieces")).toPandas()
    assert (got[got.doc_id != 2].length == 1).all() and len(got[got.doc_id != 2]) == 3
    assert K.pack(common.materialize(K.pieces(df.limit(0)), "pieces")).count() == 0
