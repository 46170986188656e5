"""Document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it writes the character it stands on and moves on if the shared
random bit r(j, character) is 1. All texts use the same bits, so two texts that differ by few edits fall back into step,
and their edit distance becomes a Hamming distance of what is written. Here a character's stay is looked up at once:
``_stays()[class][j % PERIOD]`` is the number of steps until its next 1.

The written string is sampled at shared positions. They are a fixed random set of (priority, position) points, of
uniform density over all positions; a text with L steps keeps the ``SAMPLES`` points of least priority below L. So
texts of any length are sampled throughout, and the samples of two texts agree on positions wherever both reach.
A fingerprint is the length L and one byte per sample, in hexadecimal. ``likeness`` is the share of the longer
text's samples at which both wrote the same byte.

``classes`` links texts of a likeness of ``NEAR`` or more. Bits are sampled from the bytes: a band is a bucket key of some bits, and texts that share a
band's bits meet in a bucket. For that both must read the same positions, so bands belong to a class of lengths (2^c to 2^(c+1) steps) and use positions below 2^c; a text
also goes to the class below if a text of that class could be near it. In a bucket texts are compared by a sketch of 64 more sampled bits. Those that have a candidate there are then verified:
all pairs of them in the bucket, by likeness. Bands are as wide as the number of texts needs and so many that two texts
at the least likeness share one with a probability of ``RECALL``; README has the measured recall.

Defined cases: a null text is an empty text, with fingerprint ``0:``; two empty texts are alike (1.0), an empty and another
are not (0.0); a very long text is walked whole; rows of equal doc_id follow in the order of their texts; a null doc_id comes first and never names a class; equal texts are of one class; an empty table gives no
rows; other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import connected_components, materialize, pieces_for
from plinth.llm.simhash_groups import _units, checked, set_links

SAMPLES = 128
PERIOD = 4096
SEED = 20240501
BUCKET_ROWS = 2000
MAX_BUCKETS = 1 << 15
NEAR = 0.8
RECALL = 0.95
SKETCH_BITS = 64
SKETCH_MOST = 13  # differing bits; about 6 at the least likeness, 28 of texts that have nothing to do with each other
UNIT_ROWS = 4096


@lru_cache(1)
def _stays() -> list[list[int]]:
    """For 256 classes of characters and each step of the period, the steps up to and with the next 1."""
    bits = np.random.default_rng(SEED).integers(0, 2, (256, PERIOD), np.uint8).astype(bool)
    bits[:, -1] = True
    out = []
    for row in bits:
        ones = np.flatnonzero(row)
        out.append((ones[np.searchsorted(ones, np.arange(PERIOD))] - np.arange(PERIOD) + 1).tolist())
    return out


@lru_cache(1)
def _points() -> np.ndarray:
    """Positions in order of priority: in each range 2^k .. 2^(k+1), arrivals of unit density."""
    rng = np.random.default_rng(SEED + 1)
    priority, position = [], []
    for k in range(-1, 45):
        low, high = (0, 1) if k < 0 else (1 << k, 2 << k)
        priority.append(np.cumsum(rng.exponential(size=3 * SAMPLES)) / (high - low))
        position.append(rng.integers(low, high, 3 * SAMPLES))
    return np.concatenate(position)[np.argsort(np.concatenate(priority), kind="stable")]


@lru_cache(1 << 16)
def _positions(length: int) -> tuple[int, ...]:
    points = _points()
    return tuple(points[points < length][:SAMPLES].tolist())


def _walk(text: str, at: int, ends: list[int]) -> None:
    """Adds to ends, for each character, the step at which the walk leaves it."""
    stays, mask, add = _stays(), PERIOD - 1, ends.append
    codes = text.encode("utf-32-le", "surrogatepass")
    for row in map(stays.__getitem__, (np.frombuffer(codes, np.uint32) % np.uint32(251)).tolist()):
        at += row[at & mask]
        add(at)


def _print(text: str, ends: list[int]) -> str:
    if not ends:
        return "0:"
    marks = bytes([(ord(text[bisect_right(ends, p)]) * 0x9E3779B1 >> 11) & 255 for p in _positions(ends[-1])])
    return f"{ends[-1]:x}:{marks.hex()}"


def fingerprint(text: str | None) -> str:
    ends: list[int] = []
    _walk(text or "", 0, ends)
    return _print(text or "", ends)


def _open(print_: str) -> tuple[int, bytes]:
    length, _, marks = print_.partition(":")
    return int(length, 16), bytes.fromhex(marks)


def likeness(one: str, other: str) -> float:
    """0 to 1, of two fingerprints."""
    if one == other:
        return 1.0
    (long_n, long_marks), (short_n, short_marks) = sorted((_open(one), _open(other)), key=lambda x: -x[0])
    if not short_n:
        return 0.0
    if long_n == short_n:
        same = sum(map(int.__eq__, long_marks, short_marks))
    else:
        reached = (m for m, p in zip(long_marks, _positions(long_n), strict=True) if p < short_n)
        same = sum(map(int.__eq__, reached, short_marks))
    return same / len(long_marks)


class _Text:
    """A text with its walk."""

    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text, self.ends = doc_id, text or "", []
        _walk(self.text, 0, self.ends)
        self.print = _print(self.text, self.ends)

    def edited(self, following: str) -> tuple[str, str]:
        """The text whose last half is replaced by the start of the following one, and its fingerprint.

        The walk over the first half is that of the text itself.
        """
        half = len(self.text) // 2
        if not half:
            return self.text, self.print
        kept = len(self.text) - half
        text, ends = self.text[:kept] + following[:half], self.ends[:kept]
        _walk(following[:half], ends[-1], ends)
        return text, _print(text, ends)


def _bucket_of(key, bounds: list[int]):
    """The number of bounds that are at most key: a binary search in an array literal."""
    size = 1
    while size <= len(bounds):
        size *= 2
    padded = F.lit(bounds + [(1 << 63) - 1] * (2 * size - len(bounds)))
    steps = []
    while size:
        steps.append(size)
        size //= 2
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(F.element_at(padded, at + s) <= key, at + s).otherwise(at))


def with_following(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Rows (__b, __borrowed, __key, doc_id, text) in buckets of consecutive doc_id, and the number of buckets.

    The first document of each bucket is also in the bucket before, marked as borrowed (that of the first bucket in the
    last), so that each row's follower is in its bucket: one shuffle, no global sort. Only bucket bounds, at
    most MAX_BUCKETS numbers, pass through the driver.
    """
    low = -(1 << 63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(low))
    ids = docs.select(key.alias("k"))
    rows = ids.count()
    n = min(MAX_BUCKETS, pieces_for(rows, bucket_rows))
    bounds = []
    if n > 1:
        bounds = sorted(set(ids.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 4 * MAX_BUCKETS)).first()[0]))
    bucket = _bucket_of(F.col("k"), bounds) if bounds else F.lit(0)
    firsts = {r.b: r.k for r in ids.select(bucket.alias("b"), "k").groupBy("b").agg(F.min("k").alias("k")).collect()}
    used = sorted(firsts)
    before = {b: used[i - 1] for i, b in enumerate(used)}
    first_of, before_of = (F.lit([d.get(b, 0) for b in range(len(bounds) + 1)]) for d in (firsts, before))
    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("k"))
    rows_ = rows_.withColumn("b", bucket)
    place = F.array(F.struct(F.col("b").alias("b"), F.lit(False).alias("borrowed")), F.when(F.col("k") == F.element_at(first_of, F.col("b") + 1), F.struct(F.element_at(before_of, F.col("b") + 1).cast("int").alias("b"), F.lit(True).alias("borrowed"))))
    placed = rows_.withColumn("p", F.explode(F.filter(place, lambda x: x.isNotNull())))
    return placed.select(F.col("p.b").alias("__b"), F.col("p.borrowed").alias("__borrowed"), F.col("k").alias("__key"), "doc_id", "text"), len(used)


def fingerprint_documents(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of docs."""
    placed, buckets = with_following(docs, bucket_rows)
    dealt = placed.repartition(max(1, buckets), "__b").sortWithinPartitions("__b", "__borrowed", "__key", F.coalesce("text", F.lit("")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, out = None, None, []

        def emit(own: _Text, following: _Text) -> None:
            text, print_ = own.edited(following.text)
            out.append((own.doc_id, len(own.text), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), own.print, print_, likeness(own.print, print_), likeness(own.print, following.print)))

        for b in batches:
            for at, borrowed, _, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if at != bucket:
                    bucket, held = at, None
                if borrowed and held is None:
                    continue  # the bucket is done
                now = _Text(doc_id, text)
                if held is not None:
                    emit(held, now)
                held = None if borrowed else now
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], names=names)
                out.clear()

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def plan(rows: int) -> tuple[int, int]:
    """Bits of a band, and bands, for a number of distinct texts."""
    bits = max(8, math.ceil(math.log2(max(rows, 2))) - 9)
    same = 1 - (1 - NEAR) / 2  # of a bit at the least likeness
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same**bits))


def _longest(c: int) -> int:
    """Texts up to so many steps go to the class c: those of the class, and those that a text of it can be near to."""
    return int((2 << c) / NEAR) + 1


@lru_cache(64)
def _class(c: int, bits: int, bands: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """The limit of positions, how many points below it all texts of the class have, and the sampled (point, bit) pairs of bands and sketch, as point * 8 + bit."""
    limit = 1 << c
    below = np.array(_positions(_longest(c)))
    below = below[below < limit]
    n = max(1, len(below))
    own = np.unique(below, return_index=True)[1] if len(below) else np.zeros(1, np.int64)  # points of different positions
    rng = np.random.default_rng(SEED + 2 + c)
    pick = lambda k: rng.choice(own, k, replace=len(own) < k) * 8 + rng.integers(0, 8, k)
    return limit, n, np.stack([pick(bits) for _ in range(bands)]), pick(SKETCH_BITS)


def band_rows(fps: np.ndarray, prints: list[str], bits: int, bands: int) -> tuple[np.ndarray, ...]:
    """shard, fp, and the sketch, of each band of each fingerprint."""
    by: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for i, text in enumerate(prints):
        length, marks = _open(text)
        if not length:
            continue
        marks, own = np.frombuffer(marks, np.uint8), length.bit_length() - 1
        for c in (own, own - 1):
            if c < 0 or length > _longest(c):
                continue
            limit, n, _, _ = _class(c, bits, bands)
            at, rows = by.setdefault(c, ([], []))
            at.append(i)
            rows.append(marks if c == own and length == limit else marks[np.array(_positions(length)) < limit])
            rows[-1] = rows[-1][:n]
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    for c, (at, rows) in by.items():
        _, _, of_band, of_sketch = _class(c, bits, bands)
        flat = np.unpackbits(np.stack(rows), axis=1)
        sketch = np.ascontiguousarray(np.packbits(flat[:, of_sketch], axis=1)).view(np.int64)
        for b in range(bands):
            key = flat[:, of_band[b]].astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
            for held, column in zip(out, (((c * 256 + b) << 48) | key, fps[at], sketch[:, 0]), strict=True):
                held.append(column)
    return tuple(np.concatenate(x) for x in out)


def have_partners(unit: np.ndarray, side: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Which rows have another in their unit whose sketch differs in SKETCH_MOST bits at most (rows sorted by unit; sides as in simhash_dedup.forest)."""
    sketch = sketch.view(np.uint64)
    n, out, at, k = len(unit), np.zeros(len(unit), bool), np.arange(len(unit)), 0
    while len(at):
        k += 1
        at = at[at + k < n]
        at = at[unit[at] == unit[at + k]]
        to = at + k
        hit = (np.bitwise_count(sketch[at] ^ sketch[to]) <= SKETCH_MOST) & ((side[at] == 0) | (side[at] != side[to]))
        out[at[hit]] = True
        out[to[hit]] = True
    return out


def alike_links(prints: list[np.ndarray], sub: np.ndarray, side: np.ndarray, least: float = NEAR) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of a likeness of least or more (as simhash_groups.similar_links, each row a sub-group of its own). prints: length (big-endian) and marks, in 64-bit words.

    Grown row by row: each is compared with those not reached yet, so a group of copies costs little more than one comparison a row.
    """
    table = np.stack(prints)
    length, marks = table[:, 0].byteswap().astype(np.int64), np.ascontiguousarray(table[:, 1:]).view(np.uint8)
    positions = np.stack([_positions(int(n)) for n in length])
    out, unseen = [], np.ones(len(prints), bool)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        """Of the other rows those alike: the longer one's positions that the shorter one reaches are the shorter one's first."""
        longer = (length[others] > length[i])[:, None]
        reached = np.where(longer, positions[others] < length[i], positions[i][None, :] < length[others, None])
        at = np.maximum(np.cumsum(reached, axis=1) - 1, 0)
        long_marks = np.where(longer, marks[others], marks[i][None, :])
        short_marks = np.take_along_axis(np.where(longer, marks[i][None, :], marks[others]), at, axis=1)
        return others[((long_marks == short_marks) & reached).sum(axis=1) >= least * SAMPLES]

    for start in range(len(prints)):
        if not unseen[start]:
            continue
        unseen[start], open_ = False, [start]
        while open_:
            i = open_.pop()
            others = np.flatnonzero(unseen & ((side[i] == 0) | (side != side[i])) & (np.minimum(length, length[i]) >= least / 2 * np.maximum(length, length[i])))
            for lo in range(0, len(others), 4096):
                found = near(i, others[lo : lo + 4096]).tolist()
                unseen[found] = False
                open_ += found
                out += [(i, j) for j in found]
    return out


def candidates(distinct: DataFrame, rows: int, unit_rows: int = UNIT_ROWS) -> DataFrame:
    """unit, side, fp: the fingerprints (fp long, fingerprint) of each bucket that have another with a like sketch there; buckets over unit_rows are dealt as pairs of chunks."""
    bits, bands = plan(rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = band_rows(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist(), bits, bands)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "fp", "sketch"])

    routed = distinct.select("fp", "fingerprint").mapInArrow(route, "shard long, fp long, sketch long")
    large = materialize(routed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > unit_rows), "large-buckets")
    dealt = routed.select(F.col("shard").alias("unit"), F.lit(0).alias("side"), "fp", "sketch") if large.isEmpty() else _units(routed, large, unit_rows, "left")
    # the side (0 to 2) is kept in the last two bits, to move less
    dealt = dealt.select(F.xxhash64("unit").bitwiseAND(-4).bitwiseOR(F.col("side").cast("long")).alias("unit"), "fp", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            unit, fp, sketch = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(unit) if last else int(np.searchsorted(unit, unit[-1] & -4))
            held = [] if last else [(unit[cut:], fp[cut:], sketch[cut:])]
            if cut:
                found = have_partners(unit[:cut] & -4, unit[:cut] & 3, sketch[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(unit[:cut][found] & -4), pa.array((unit[:cut][found] & 3).astype(np.int32)), pa.array(fp[:cut][found])], names=["unit", "side", "fp"])

        for b in batches:
            if b.num_rows:
                held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
                if sum(len(h[0]) for h in held) > 50_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    group = F.col("unit").bitwiseAND(-4)
    units = dealt.repartition(pieces_for(rows * bands, 200_000, 8), group).sortWithinPartitions("unit")
    return units.mapInArrow(compare, "unit long, side int, fp long")


def classes(prints: DataFrame) -> DataFrame:
    """fp, class_id: the least doc_id of the class of each fingerprint that another row or a near fingerprint shares.

    prints: doc_id, fingerprint, materialised. fp is the 64-bit hash of a fingerprint; rows that aren't in a class of several are left out.
    """
    named = prints.select("doc_id", "fingerprint", F.xxhash64("fingerprint").alias("fp"), F.monotonically_increasing_id().alias("row"))
    repeated = materialize(named.groupBy("fp").agg(F.count("*").alias("n"), F.min("row").alias("first"), F.min("doc_id").alias("least_id")).where("n > 1"), "repeated")
    distinct = named.join(checked(repeated.select("fp", "first")), "fp", "left").where("first is null or first = row").select("fp", "fingerprint", "doc_id")
    found = materialize(candidates(distinct, prints.count()), "near-candidates")
    marks = F.unhex(F.rpad(F.substring_index("fingerprint", ":", -1), 2 * SAMPLES, "0"))
    size = F.unhex(F.lpad(F.substring_index("fingerprint", ":", 1), 16, "0"))
    asked = materialize(found.select("fp").distinct(), "near-ids")
    packed = distinct.join(checked(asked), "fp", "left_semi").select("fp", "doc_id", F.concat(size, marks).alias("hashes"))
    packed = materialize(packed, "near-prints")
    units = found.withColumn("sub", F.col("fp")).join(packed.select("fp", "hashes"), "fp")
    links = materialize(set_links(units, found.count(), NEAR, alike_links), "near-links")
    labels = connected_components(links).withColumnRenamed("node", "fp")
    least = packed.select("fp", F.col("doc_id").alias("least_id")).join(labels, "fp").join(repeated.select("fp", F.col("least_id").alias("other_id")), "fp", "left").select("fp", "label", F.coalesce("other_id", "least_id").alias("least_id"))
    of = least.groupBy("label").agg(F.min("least_id").alias("class_id"))
    linked = materialize(least.join(of, "label").select("fp", "class_id"), "near-classes")
    alone = repeated.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least_id").alias("class_id"))
    return linked.unionByName(alone)


def with_classes(prints: DataFrame) -> DataFrame:
    """prints (materialised, with doc_id and fingerprint) with class_id: the least doc_id of the row's class of equal and near fingerprints."""
    of = materialize(classes(prints), "classes")
    joined = prints.withColumn("__fp", F.xxhash64("fingerprint")).join(checked(of.withColumnRenamed("fp", "__fp")), "__fp", "left")
    return joined.withColumn("class_id", F.coalesce("class_id", "doc_id")).drop("__fp")
