"""SimHash near-duplicates by sharded vantage-point trees.

Fingerprints: 64 bits, a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of a text's
word shingles. Two fingerprints within ``max_distance`` bits are linked; links make components.

Search. The 64 bits are cut into blocks with radii, such that linked fingerprints are within the radius on one block at least (``block_radii``). By
default there is a block less than ``max_distance + 1``, so one has radius 1 (from ``WIDE_ROWS`` on two less and two of radius 1): four blocks of 16 bits with radii
1, 0, 0, 0. Each block has a vantage-point tree of fixed pivots, whose children are the rings of equal distance to a pivot. By
the triangle inequality a fingerprint within t of another on the block is in one of the rings d - t .. d + t of each pivot, and, as each differing bit moves each
distance by one, in a ring of the parity of d + t only. All other branches are pruned: a fingerprint is at home in one shard (leaf), and is sent as a visitor to those shards that its ball overlaps beyond the
boundary, of these only to the ones numbered above its home, since the other way round the pair is found in the other's home. A tree of radius 1 has the more pivots the more rows there are, so shards stay bounded.
Within a shard, fingerprints are ordered by their full distance to one more pivot and compared only inside the band d .. d + max_distance; visitors are not compared with each other.
Equal fingerprints are merged first, so copies cost nothing, and a shard gives a spanning forest
of its links, never all pairs. A shard over ``shard_rows`` is dealt out as pairs of chunks, so no
task gets an unbounded group. The search is exact.

Defined cases: a null text counts as empty; a text without words has fingerprint 0 and is linked like any
other; a very long text counts whole; repeated rows get equal results; ties are linked like any others, and of several ids the smallest names the component; a null doc_id is kept but never names a
component; an empty table gives no rows; other columns, whatever they are called, are not read by ``components`` and stay as they are in ``representatives``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import connected_components, materialize, pieces_for

MAX_DISTANCE = 4
SHINGLE_WORDS = 4
SHARD_ROWS = 4096
PIVOTS = 8
WIDE_ROWS = 1 << 27
_SLICE = 1 << 16


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(b" ".join(found), 42)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    begin = [0, *ends[: -words].tolist()]
    end = (ends[words - 1 :] - 1).tolist()
    counts, n = np.zeros(64, np.int64), len(begin)
    for at in range(0, n, _SLICE):
        counts += _bit_counts(np.array([digest(line[b:e], 42) for b, e in zip(begin[at : at + _SLICE], end[at : at + _SLICE], strict=True)], np.uint64))
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def block_radii(max_distance: int, blocks: int) -> list[int]:
    """Radii that sum to max_distance - blocks + 1: a pair beyond all of them differs in more bits."""
    spare = max(0, max_distance - blocks + 1)
    return [spare // blocks + (i < spare % blocks) for i in range(blocks)]


class BlockTree:
    """A static vantage-point tree over some of the bits."""

    def __init__(self, bits: range, radius: int, seed: int, pivots: int = PIVOTS):
        self.mask = np.uint64(sum(1 << b for b in bits))
        rng = np.random.default_rng(seed)
        self.pivots = rng.integers(0, 1 << 63, pivots, np.uint64) * np.uint64(2) ^ rng.integers(0, 2, pivots, np.uint64)
        self.most = len(bits)
        #: How the rings of a fingerprint within the radius can differ; each bit moves each ring by one.
        self.steps = sorted({o for t in range(1, radius + 1) for o in product(range(-t, t + 1, 2), repeat=pivots)} - {(0,) * pivots})

    def _rings(self, fps: np.ndarray) -> np.ndarray:
        own = fps & self.mask
        return np.stack([np.bitwise_count(own ^ (p & self.mask)).astype(np.int64) for p in self.pivots], axis=1)

    def _leaf(self, rings: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(rings), np.int64)
        for k in range(rings.shape[1]):
            leaf = leaf * 65 + rings[:, k]
        return leaf

    def shards(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, leaves, and whether the row is a visitor: of each fingerprint its home, and the leaves above it that its ball overlaps."""
        d = self._rings(fps)
        home = self._leaf(d)
        rows, leaves = [np.arange(len(fps))], [home]
        for step in self.steps:
            ring = d + np.array(step)
            leaf = self._leaf(ring)
            at = np.flatnonzero(((ring >= 0) & (ring <= self.most)).all(axis=1) & (leaf > home))
            rows.append(at)
            leaves.append(leaf[at])
        return np.concatenate(rows), np.concatenate(leaves), np.arange(sum(map(len, rows))) >= len(fps)


def trees_for(max_distance: int = MAX_DISTANCE, blocks: int | None = None, rows: int = 1, shard_rows: int = SHARD_ROWS) -> list[BlockTree]:
    """The trees of a search among so many fingerprints."""
    blocks = blocks or max(1, max_distance + 1 - (1 if rows < WIDE_ROWS else 2))
    cuts = np.linspace(0, 64, blocks + 1).round().astype(int)
    radii = block_radii(max_distance, blocks)
    # two random fingerprints share a ring of a pivot with a probability of 1 / sqrt(pi * bits)
    depth = min(PIVOTS, max(4, math.ceil(2 * math.log(max(1.0, rows / shard_rows)) / math.log(math.pi * 64 / blocks))))
    return [BlockTree(range(cuts[i], cuts[i + 1]), radii[i], 1000 + i, PIVOTS if not radii[i] else depth if radii[i] == 1 else 4) for i in range(blocks)]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking rows a with rows b; a label is the least row of its group."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label != (up := label[label])).any():
            label = up
    return label


def forest(leaf: np.ndarray, side: np.ndarray, visitor: np.ndarray, fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, int]:
    """Links (as row pairs n x 2) that span the components within each leaf, and the number of comparisons.

    side: rows with sides 1 and 2 are compared across only, rows with side 0 with each other. Two visitors are not compared.
    """
    pivot = np.uint64(0x9E3779B97F4A7C15)
    d = np.bitwise_count(fps ^ pivot).astype(np.int64)
    order = np.lexsort((d, leaf, visitor))  # residents first, by leaf and distance
    side, visitor, fps = side[order], visitor[order], fps[order]
    place = leaf[order].astype(np.int64) * 128 + d[order]
    n, homes = len(fps), int((~visitor).sum())
    # each row meets the residents of its leaf inside the band; a resident only those behind itself
    low = np.where(visitor, np.searchsorted(place[:homes], place - np.minimum(d[order], max_distance)), np.arange(n) + 1)
    high = np.searchsorted(place[:homes], place + max_distance, "right")
    label, at, k, held_a, held_b, held, compared = np.arange(n), np.arange(n), 0, [], [], 0, 0
    while len(at):
        at = at[low[at] + k < high[at]]
        to = low[at] + k
        k += 1
        compared += len(at)
        hit = np.bitwise_count(fps[at] ^ fps[to]) <= max_distance
        hit &= (side[at] == 0) | (side[at] != side[to])
        if hit.any():
            held_a.append(at[hit])
            held_b.append(to[hit])
            held += len(held_a[-1])
            if held > 500_000:
                label = _merge(label, np.concatenate(held_a), np.concatenate(held_b))
                held_a, held_b, held = [], [], 0
    if held:
        label = _merge(label, np.concatenate(held_a), np.concatenate(held_b))
    child = np.flatnonzero(label != np.arange(n))
    return np.stack([order[child], order[label[child]]], axis=1), compared


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, blocks: int | None = None, shard_rows: int = SHARD_ROWS, rows: int | None = None) -> DataFrame:
    """Edges (a, b) of a forest that spans the components of distinct fingerprints ``fps`` (fp long)."""
    rows = fps.count() if rows is None else rows
    trees = trees_for(max_distance, blocks, rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for t, tree in enumerate(trees):
                row, leaf, visitor = tree.shards(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), t, np.int32)), pa.array(leaf), pa.array(visitor), pa.array(own[row].view(np.int64))], names=["tree", "leaf", "visitor", "fp"])

    routed = fps.select("fp").mapInArrow(route, "tree int, leaf long, visitor boolean, fp long")
    sizes = materialize(routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows), "large-shards")
    if sizes.isEmpty():
        dealt = routed.select("tree", "leaf", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "visitor", "fp")
    else:  # a shard over the limit becomes pairs of chunks (i <= j), each its own unit of work
        chunks = F.coalesce(F.ceil(F.col("n") / shard_rows).cast("int"), F.lit(1))
        dealt = routed.join(sizes, ["tree", "leaf"], "left").withColumn("chunk", F.pmod(F.xxhash64("fp"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        dealt = dealt.select("tree", "leaf", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).alias("side"), "visitor", "fp")
    unit = F.xxhash64("tree", "leaf", "i", "j").alias("unit")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept
            key, side, visitor, own = (np.concatenate(x) for x in zip(*kept, strict=True))
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            kept = [] if last else [(key[cut:], side[cut:], visitor[cut:], own[cut:])]
            if cut:
                _, small = np.unique(key[:cut], return_inverse=True)
                own = own[:cut].view(np.uint64)
                pairs, _ = forest(small, side[:cut], visitor[:cut], own, max_distance)
                yield pa.RecordBatch.from_arrays([pa.array(own[pairs[:, i]].view(np.int64)) for i in (0, 1)], names=["a", "b"])

        for b in batches:
            if b.num_rows:
                kept.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
                if sum(len(x[0]) for x in kept) > 50_000:
                    yield from flush(False)
        if kept:
            yield from flush(True)

    copies = len(trees) + sum(len(t.steps) // 2 for t in trees)
    units = dealt.select(unit, "side", "visitor", "fp").repartition(pieces_for(rows * copies, 400_000, 8), "unit")
    return units.sortWithinPartitions("unit").mapInArrow(compare, "a long, b long")


def components(docs: DataFrame, max_distance: int = MAX_DISTANCE, words: int = SHINGLE_WORDS, blocks: int | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable) for each row of docs (doc_id, text)."""
    prints = materialize(fingerprints(docs, words), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    labels = connected_components(links(distinct, max_distance, blocks, shard_rows, distinct.count()))
    named = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of = named.join(ids, "label").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """docs without those that follow another of their component; columns as given.

    The document of the smallest doc_id of a component stays, once. Rows without doc_id stay.
    """
    found = components(docs, **options)
    extra = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "followers")
    kept = docs.join(extra.withColumnRenamed("doc_id", "__plinth_follower"), F.col("doc_id").cast("long") == F.col("__plinth_follower"), "left_anti")
    repeated = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(kept.where("doc_id is null"))
