"""Near-duplicate groups by similarity: wide SimHash, vantage-point trees over bit blocks, components decided by whole shingle sets.

Four bits of 64 is a narrow link: two texts whose shingle sets have a Jaccard similarity of 0.8 differ in about 15 % of SimHash bits. Here fingerprints are as wide as
the number of documents needs: blocks of b bits (more for more documents, so that shards stay small), and so many blocks that two texts at
the least similarity share a block, and so a shard, with probability ``RECALL``. Each block has a vantage-point tree of radius 0 (see
``simhash_dedup``); in a shard all pairs are compared by their whole fingerprints, in blocks of rows.

A shard gives the minimum spanning forest of its pairs within the widest distance that similar texts reach, so at most one link per fingerprint and never all
pairs of a group. These links only say which texts belong to one candidate component; the two measures rank pairs differently, so they don't
decide. In a component all pairs are compared by their whole shingle sets, and the groups are those of the pairs that reach the least similarity. Sets are made
again from the texts of components only.

What is not exact: two texts of more than ``FEW`` shingles at the least similarity come into one component by their own shards with a probability designed to be RECALL (more
above it, and by way of other texts). Shorter texts have many ties in their bits; they get a shard for each of their least shingle hashes and lose no link.

Defined cases: null and empty texts, and texts without words, are copies of each other; shorter texts than a shingle are one shingle; repeated rows and null doc_ids as in
``simhash_dedup``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import connected_components, materialize, pieces_for
from plinth.llm.simhash_dedup import BlockTree

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.97
SKETCH = 256
FEW = 32  # texts of up to so many shingles are found by shared hashes
UNIT = 256  # sets compared at once
BROADCAST_ROWS = 200_000  # keys of up to some 100 bytes; longer lists are joined by shuffle
SHARD_ROWS = 2048
_ODD = 0x9E3779B97F4A7C15


def plan(rows: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int, int]:
    """Bits per block, blocks, and the widest distance, for a number of distinct texts."""
    bits = min(20, max(8, math.ceil(math.log2(max(2, rows) / 128))))
    same = 1 - math.acos(2 * similarity / (1 + similarity)) / math.pi  # of a bit, for sets of that Jaccard similarity
    blocks = math.ceil(math.log(1 - recall) / math.log(1 - same**bits))
    width = -(-bits * blocks // 64) * 64
    most = width * (1 - same) + 2.5 * math.sqrt(width * same * (1 - same))
    return bits, width // bits, math.ceil(most)


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct XXH64 hashes (seed 42) of a text's word shingles, in order."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    digest, line = xxhash.xxh64_intdigest, b" ".join(found)
    if len(found) <= words:
        return np.array([digest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    spans = zip([0, *ends[:-words].tolist()], (ends[words - 1 :] - 1).tolist(), strict=True)
    return np.unique(np.fromiter((digest(line[b:e], 42) for b, e in spans), np.uint64, len(found) - words + 1))


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    x = h + np.uint64(_ODD * k & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _counts(x: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit set. Bits are added as bytes, eight to a lane, 255 rows at a time."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(x), 255 * 64):
        part = x[at : at + 255 * 64]
        lanes = np.unpackbits(part.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        for lo in range(0, len(part), 255):
            total += lanes[lo : lo + 255].sum(axis=0).view(np.uint8)
    return total


def wide_fingerprint(hashes: np.ndarray, width: int) -> bytes:
    if not len(hashes):
        return bytes(width // 8)
    bits = [2 * _counts(_mixed(hashes, k)) > len(hashes) for k in range(1, width // 64 + 1)]
    return np.packbits(np.concatenate(bits), bitorder="little").tobytes()


def prints(docs: DataFrame, width: int, words: int = WORDS) -> DataFrame:
    """doc_id, fp binary, few (the shingle hashes, 8 bytes each, of a text of up to FEW shingles, else null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_hashes(t, words) for t in b.column(1).to_pylist()]
            few = [h.tobytes() if 0 < len(h) <= FEW else None for h in hashes]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([wide_fingerprint(h, width) for h in hashes], pa.binary()), pa.array(few, pa.binary())], names=["doc_id", "fp", "few"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp binary, few binary")


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int, words: int = WORDS) -> DataFrame:
    """fp, hashes (all shingle hashes) of the fingerprints in nodes (fp, least_id); only texts of those doc_ids are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_hashes(t, words) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([wide_fingerprint(h, width) for h in hashes], pa.binary()), pa.array([h.tobytes() for h in hashes], pa.binary())], names=["fp", "hashes"])

    ids = materialize(nodes.select("least_id").distinct(), "wide-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(checked(ids), F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi")
    found = texts.select("text").mapInArrow(run, "fp binary, hashes binary")
    return found.join(checked(nodes.select("fp")), "fp", "left_semi").groupBy("fp").agg(F.min("hashes").alias("hashes"))


def similar_links(sets: list[np.ndarray], sub: np.ndarray, side: np.ndarray, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets whose Jaccard similarity is at least ``similarity``.

    Pairs of one sub-group (which are linked already) and of one side (unless 0) are left out. Common shingles are counted by matrix products over slabs of shingles.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets], np.int64)
    open_ = (sub[:, None] != sub) & ((side[:, None] == 0) | (side[:, None] != side))
    if not open_.any():
        return []
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    who, twice = np.repeat(np.arange(n), sizes), count[at] > 1
    column, who = (np.cumsum(count > 1) - 1)[at[twice]], who[twice]
    order = np.argsort(column, kind="stable")
    column, who = column[order], who[order]
    shared, last = np.zeros((n, n), np.float32), int((count > 1).sum())
    for lo in range(0, last, 4096):
        b, e = np.searchsorted(column, (lo, lo + 4096))
        slab = np.zeros((n, min(4096, last - lo)), np.float32)
        slab[who[b:e], column[b:e] - lo] = 1
        shared += slab @ slab.T
    union = sizes[:, None] + sizes - shared.astype(np.int64)
    return spanning(open_ & (np.where(union > 0, shared / np.maximum(union, 1), 1.0) >= similarity))


def spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a graph, given as a symmetric matrix."""
    unseen, out = np.ones(len(near), bool), []
    for start in range(len(near)):
        if not unseen[start]:
            continue
        unseen[start], reached = False, [start]
        while reached:
            i = reached.pop()
            new = np.flatnonzero(near[i] & unseen).tolist()
            unseen[new] = False
            out += [(i, j) for j in new]
            reached += new
    return out


def set_links(dealt: DataFrame, rows: int, similarity: float = SIMILARITY, near=similar_links) -> DataFrame:
    """a, b: the links ``near`` finds (as similar_links does) in each unit of dealt (unit long, side int, fp, sub of its type, hashes)."""
    kind, arrow = dict(dealt.dtypes)["fp"], pa.int64() if dict(dealt.dtypes)["fp"] == "bigint" else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve() -> pa.RecordBatch:
            links = []
            if len(held) > 1:
                _, sub = np.unique(np.array([h[3] for h in held], object), return_inverse=True)
                links = near([np.frombuffer(h[4], np.uint64) for h in held], sub, np.array([h[1] for h in held]), similarity)
            return pa.RecordBatch.from_arrays([pa.array([held[i][2] for i, _ in links], arrow), pa.array([held[j][2] for _, j in links], arrow)], names=["a", "b"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if held and held[0][0] != row[0]:
                    yield solve()
                    held = []
                held.append(row)
        if held:
            yield solve()

    units = dealt.select("unit", "side", "fp", "sub", "hashes").repartition(pieces_for(rows, 5_000, 8), "unit").sortWithinPartitions("unit")
    return units.mapInArrow(run, f"a {kind}, b {kind}").where("a <> b").distinct()


def few_links(few: DataFrame, rows: int, similarity: float = SIMILARITY) -> DataFrame:
    """a, b (binary): all links of short texts (fp, few), but those within the forest of a shared hash.

    Sets of similarity s share one of their n - ceil(s n) + 1 least hashes, so a shard for each of these loses none.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, sets, shards = [], [], []
            for fp, few in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = np.frombuffer(few, np.int64)
                least = h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1].tolist()
                shards += least
                fps += [fp] * len(least)
                sets += [few] * len(least)
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(fps, pa.binary()), pa.array(sets, pa.binary())], names=["shard", "fp", "hashes"])

    routed = few.select("fp", "few").mapInArrow(route, "shard long, fp binary, hashes binary")
    counts = materialize(routed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "few-shards")
    return set_links(_units(routed, counts, UNIT, "inner").withColumn("sub", F.col("fp")), rows * 4, similarity)


def _units(routed: DataFrame, counts: DataFrame, size: int, how: str) -> DataFrame:
    """routed (shard, fp, ...) with unit and side: shards over ``size`` rows (n in counts) become pairs of chunks."""
    chunks = F.coalesce(F.ceil(F.col("n") / size).cast("int"), F.lit(1))
    dealt = routed.join(counts, "shard", how).withColumn("chunk", F.pmod(F.xxhash64("fp"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    unit = F.xxhash64("shard", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit")
    side = F.when(F.col("chunk") == F.col("other"), 0).when(F.col("chunk") < F.col("other"), 1).otherwise(2).alias("side")
    return dealt.select(unit, side, *[c for c in routed.columns if c != "shard"])


def verified_links(candidates: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, unit: int = UNIT, near=similar_links) -> DataFrame:
    """a, b: links whose groups are the single-linkage groups of each component of candidates (fp, component).

    All pairs of a component are decided by their whole shingle sets (fp, hashes). A component of up to ``unit`` texts is one unit. A larger one is
    first dealt into units three times, each time otherwise; then all texts outside its main group so far meet all its texts, in pairs of chunks.
    """
    sizes = materialize(candidates.groupBy("component").agg(F.count("*").alias("n")), "wide-sizes")
    number = candidates.count()

    def dealt_once(of: DataFrame, salt: int) -> DataFrame:
        chunk = F.pmod(F.xxhash64(F.lit(salt), "fp"), F.ceil(F.col("n") / unit))
        return of.select(F.xxhash64("component", chunk).alias("unit"), F.lit(0).alias("side"), "fp", F.col("fp").alias("sub")).join(sets, "fp")

    out = materialize(set_links(dealt_once(candidates.join(sizes, "component"), 0), number, similarity, near), "wide-verified")
    large = sizes.where(F.col("n") > unit)
    if large.isEmpty():
        return out
    of = materialize(candidates.join(large, "component"), "wide-large")
    for salt in (1, 2):
        out = out.unionByName(materialize(set_links(dealt_once(of, salt), number, similarity, near), "wide-verified"))
    sub = connected_components(out).select(F.col("node").alias("fp"), F.col("label").alias("sub"))
    of = materialize(of.join(sub, "fp", "left").withColumn("sub", F.coalesce("sub", "fp")), "wide-subs")
    by_sub = of.groupBy("component", "sub").agg(F.count("*").alias("k"), F.first("n").alias("n"))
    main = by_sub.groupBy("component").agg(F.max_by("sub", F.struct("k", "sub")).alias("main"), (F.first("n") - F.max("k")).alias("others")).where("others > 0")
    main = materialize(main, "wide-main")
    if main.isEmpty():
        return out
    of = of.join(main, "component").withColumn("ends", F.ceil(F.col("n") / unit).cast("int")).withColumn("rows", F.ceil(F.col("others") / unit).cast("int"))
    at = lambda chunks: F.pmod(F.xxhash64(F.lit(3), "fp"), F.col(chunks)).cast("int")
    every = lambda chunks: F.explode(F.sequence(F.lit(0), F.col(chunks) - 1))
    left = of.where(F.col("sub") != F.col("main")).withColumn("r", at("rows")).withColumn("e", every("ends")).withColumn("side", F.lit(1))
    right = of.withColumn("e", at("ends")).withColumn("r", every("rows")).withColumn("side", F.lit(2)).select(left.columns)
    both = left.unionByName(right).select(F.xxhash64("component", "r", "e").alias("unit"), "side", "fp", "sub")
    return out.unionByName(materialize(set_links(both.join(sets, "fp"), both.count(), similarity, near), "wide-verified"))


def sketch_similarity(a: bytes, b: bytes, k: int = SKETCH) -> float:
    """Jaccard similarity of two shingle sets from their k least hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    least = np.union1d(x, y)
    if len(x) >= k or len(y) >= k:
        least = least[:k]  # below this every hash of either text is known
    return float(np.isin(least, np.intersect1d(x, y, assume_unique=True), assume_unique=True).mean())


def _matrix(fps: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(fps), np.uint64).reshape(-1, width // 64)


def _block_values(fps: np.ndarray, bits: int, blocks: int) -> np.ndarray:
    flat = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")[:, : bits * blocks].reshape(len(fps), blocks, bits)
    return (flat.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=2)


def spanning_links(fps: np.ndarray, side: np.ndarray, most: int) -> np.ndarray:
    """Row pairs of a minimum spanning forest of the pairs within ``most`` bits (sides as in ``simhash_dedup.forest``)."""
    n = len(fps)
    near_a, near_b, near_d = [], [], []
    step = max(1, 400_000 // max(1, n))
    for lo in range(0, n, step):
        part = fps[lo : lo + step]
        d = np.zeros((len(part), n - lo), np.int16)
        for w in range(fps.shape[1]):
            d += np.bitwise_count(part[:, w : w + 1] ^ fps[None, lo:, w])
        a, b = np.nonzero(d <= most)
        d = d[a, b]
        a, b = a + lo, b + lo
        fine = (b > a) & ((side[a] == 0) | (side[a] != side[b]))
        near_a.append(a[fine])
        near_b.append(b[fine])
        near_d.append(d[fine])
    a, b, d = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (near_a, near_b, near_d))
    order = np.argsort(d, kind="stable")
    a, b, d = a[order], b[order], d[order]
    root, out = np.arange(n), []
    for lo, hi in zip(*_runs(d), strict=True):  # shortest first
        ra, rb = root[a[lo:hi]], root[b[lo:hi]]
        open_ = np.flatnonzero(ra != rb)
        if not len(open_):
            continue
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.get(x, x)) != x:  # noqa: B023
                x = y
            return x

        _, first = np.unique(ra[open_] * n + rb[open_], return_index=True)
        for i in (lo + open_[np.sort(first)]).tolist():
            x, y = find(int(root[a[i]])), find(int(root[b[i]]))
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((a[i], b[i]))
        moved = np.arange(n)
        for x in list(up):
            moved[x] = find(x)
        root = moved[root]
    return np.array(out, np.int64).reshape(-1, 2)


def _runs(d: np.ndarray) -> tuple[list[int], list[int]]:
    cuts = np.flatnonzero(np.diff(d)) + 1
    return ([0, *cuts.tolist()], [*cuts.tolist(), len(d)]) if len(d) else ([], [])


def candidate_links(fps: DataFrame, rows: int, bits: int, blocks: int, most: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """a, b (binary): spanning links of each shard of distinct fingerprints (fp binary)."""
    width = -(-bits * blocks // 64) * 64
    trees = [BlockTree(range(bits), 0, 2000 + t) for t in range(blocks)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_pylist()
            if not own:
                continue
            values = _block_values(_matrix(own, width), bits, blocks)
            column = pa.array(own, pa.binary())
            for t, tree in enumerate(trees):
                _, leaf, _ = tree.shards(values[:, t])
                yield pa.RecordBatch.from_arrays([pa.array(xx(leaf, t)), column], names=["shard", "fp"])

    routed = fps.select("fp").mapInArrow(route, "shard long, fp binary")
    large = routed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
    large = materialize(large, "large-shards")
    if large.isEmpty():
        dealt = routed.select(F.col("shard").alias("unit"), F.lit(0).alias("side"), "fp")
    else:
        dealt = _units(routed, large, shard_rows, "left")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            unit, side = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            fps = [f for h in held for f in h[2]]
            cut = len(unit) if last else int(np.searchsorted(unit, unit[-1]))
            held = [] if last else [(unit[cut:], side[cut:], fps[cut:])]
            if not cut:
                return
            matrix = _matrix(fps[:cut], width)
            ends = [*(np.flatnonzero(np.diff(unit[:cut])) + 1).tolist(), cut]
            a, b, lo = [], [], 0
            for hi in ends:
                if hi - lo > 1:
                    for i, j in spanning_links(matrix[lo:hi], side[lo:hi], most).tolist():
                        a.append(fps[lo + i])
                        b.append(fps[lo + j])
                lo = hi
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for b in batches:
            if b.num_rows:
                held.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_pylist()))
                if sum(len(h[0]) for h in held) > 50_000:
                    yield from flush(False)
        if held:
            yield from flush(True)

    units = dealt.repartition(pieces_for(rows * blocks, 200_000, 8), "unit").sortWithinPartitions("unit")
    found = units.mapInArrow(compare, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def xx(leaf: np.ndarray, tree: int) -> np.ndarray:
    """Shard numbers: leaves of different trees are different shards."""
    return (_mixed(leaf.view(np.uint64), 2 * tree + 1) >> np.uint64(1)).view(np.int64)


def checked(keys: DataFrame) -> DataFrame:
    """Materialised keys, to be broadcast only if there are few; else the join is dealt by key."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def groups(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, shard_rows: int = SHARD_ROWS, rows: int | None = None) -> DataFrame:
    """doc_id, group_id (the smallest doc_id of the group, null if it has none) of each row of docs (doc_id, text)."""
    rows = docs.count() if rows is None else rows
    bits, blocks, most = plan(rows, similarity)
    width = -(-bits * blocks // 64) * 64
    found = materialize(prints(docs, width, words), "wide-prints")
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "wide-distinct")
    links = materialize(candidate_links(distinct, distinct.count(), bits, blocks, most, shard_rows), "wide-links")
    few = materialize(found.where("few is not null").select("fp", "few").distinct(), "wide-few")
    short = materialize(few_links(few, few.count(), similarity), "few-links")
    candidates = materialize(connected_components(links.unionByName(short)).select(F.col("node").alias("fp"), F.col("label").alias("component")), "wide-nodes")
    nodes = materialize(distinct.join(checked(candidates.select("fp")), "fp", "left_semi").select("fp", "least_id"), "wide-linked")
    sets = materialize(shingle_sets(docs, nodes, width, words), "wide-sets")
    labels = connected_components(verified_links(candidates, sets, similarity)).withColumnRenamed("node", "fp")
    named = distinct.select("fp", "least_id").join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("group_id"))
    return found.select("doc_id", "fp").join(named.join(ids, "label").select("fp", "group_id"), "fp").select("doc_id", "group_id")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group, that of the smallest doc_id, once; columns as given. Rows without doc_id stay."""
    found = materialize(groups(docs, **options), "groups")
    extra = materialize(found.where("doc_id <> group_id").select(F.col("doc_id").alias("__plinth_follower")).distinct(), "followers")
    kept = docs.join(checked(extra), F.col("doc_id").cast("long") == F.col("__plinth_follower"), "left_anti")
    if found.where("doc_id = group_id").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
