import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from plinth.llm import common, edit_embedding as E, queries


def slow_print(text):
    """The walk step by step."""
    bits = np.random.default_rng(E.SEED).integers(0, 2, (256, E.PERIOD), np.uint8).astype(bool)
    bits[:, -1] = True
    out, i, j = [], 0, 0
    while i < len(text):
        out.append(text[i])
        i += int(bits[ord(text[i]) % 251, j % E.PERIOD])
        j += 1
    if not out:
        return "0:"
    return f"{j:x}:" + bytes((ord(out[p]) * 0x9E3779B1 >> 11) & 255 for p in E._positions(j)).hex()


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_walk(text):
    text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    assert E.fingerprint(text) == slow_print(text)


def test_likeness_falls_with_edits():
    rng = np.random.default_rng(0)
    text = "".join(rng.choice(list("abcdefghij klmno"), 6000))
    scores = []
    for edits in (0, 2, 20, 200):
        t = list(text)
        for at in rng.integers(0, 5900, edits):
            t[at] = "#" if at % 2 else ""
        scores.append(E.likeness(E.fingerprint(text), E.fingerprint("".join(t))))
    other = E.likeness(E.fingerprint(text), E.fingerprint("".join(rng.permutation(list(text)))))
    assert scores[0] == 1 > scores[1] > scores[3] > other and scores[1] > 0.9
    assert E.likeness("0:", "0:") == 1 and E.likeness("0:", E.fingerprint("a")) == 0


def expected(rows):
    """rows of (doc_id, text) by brute force."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    out = []
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = map(slow_print, (t, edited, nxt))
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, E.likeness(a, b), E.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_documents(spark, bucket_rows):
    rows = [(i * 7, f"text {i} " * (i % 9)) for i in range(40)] + [(5, None), (6, ""), (7, "ünï😀code"), (7, "ünï😀code"), (7, "again"), (0, "zero"), (None, "no id"), (10**15, "far away and long " * 400)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fingerprint string")
    got = sorted((tuple(r) for r in E.fingerprint_documents(df, bucket_rows).collect()), key=repr)
    assert got == expected(rows)


def test_few_rows(spark):
    schema = "doc_id long, text string"
    assert E.fingerprint_documents(spark.createDataFrame([], schema)).count() == 0
    r = E.fingerprint_documents(spark.createDataFrame([(1, "abcd")], schema)).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def brute_classes(rows):
    """doc_id -> least doc_id of its component of pairs at NEAR or more, and those pairs."""
    label, pairs = {d: d for d, _ in rows}, []
    opened = [(d, f, *E._open(f)) for d, f in rows]
    for i, (a, f, n, _) in enumerate(opened):
        for b, g, m, _ in opened[:i]:
            if f == g or (min(n, m) >= 0.7 * max(n, m) and E.likeness(f, g) >= E.NEAR):
                pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return label, pairs


def edited(rng, text, edits):
    t = list(text)
    for at in rng.integers(0, len(t), edits):
        t[at] = ("", "#", t[at] + "x")[int(rng.integers(3))]
    return "".join(t)


def test_classes(spark):
    """Chains, copies, near copies of many lengths, and a group larger than a unit: recall against all pairs, and no false member."""
    rng = np.random.default_rng(4)
    rows, group = [], "".join(rng.choice(list("abcdefgh ijk"), 900))
    for i in range(120):
        text = "".join(rng.choice(list("abcdefgh ijk"), int(rng.integers(5, 3000))))
        rows += [(10 * i, text), (10 * i + 1, edited(rng, text, max(1, len(text) // 120))), (10 * i + 2, text)]
    rows += [(5000 + i, edited(rng, group, 4)) for i in range(330)] + [(9000, None), (9001, ""), (None, rows[0][1]), (None, rows[0][1]), (None, "alone")]
    df = spark.createDataFrame([(d, E.fingerprint(t), "x") for d, t in rows], "doc_id long, fingerprint string, class_id_ string")
    got = E.with_classes(common.materialize(df, "prints"))
    assert got.columns == [*df.columns, "class_id"]
    by = {r.doc_id: r.class_id for r in got.collect() if r.doc_id is not None}
    want, pairs = brute_classes([(d, E.fingerprint(t)) for d, t in rows if d is not None])
    found = sum(by[a] == by[b] for a, b in pairs)
    assert len(pairs) > 10_000 and found / len(pairs) >= 0.98
    loose = [(a, b) for a, b in pairs if a < 5000]
    assert sum(by[a] == by[b] for a, b in loose) / len(loose) >= 0.95
    assert all(want[d] == want[c] for d, c in by.items())  # whatever shares a class is linked in truth
    nulls = [r.class_id for r in got.where("doc_id is null").collect()]
    assert sorted(map(repr, nulls)) == ["0", "0", "None"]


def test_classes_of_the_drivers_documents(spark):
    got = {r.doc_id: r for r in queries.op5_edit_embedding(spark, "/root/testdata/sf0.01").collect()}
    want, pairs = brute_classes([(d, r.fingerprint) for d, r in got.items()])
    assert len(pairs) > 20 and sum(got[a].class_id == got[b].class_id for a, b in pairs) / len(pairs) >= 0.9
    assert all(want[d] == want[r.class_id] for d, r in got.items())


def test_no_classes(spark):
    none = spark.createDataFrame([], "doc_id long, fingerprint string")
    assert E.with_classes(common.materialize(none, "prints")).count() == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r.text) < 3000]
    got = queries.op5_edit_embedding(spark, sf_dir)
    assert got.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    by = {r.doc_id: r for r in got.collect()}
    assert all(by[d].fingerprint == slow_print(t) for d, t in docs[:40])
