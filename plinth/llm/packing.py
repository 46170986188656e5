"""Best-fit-decreasing packing with certificates and repacking.

Documents become pieces of at most ``SIZE`` tokens. Pieces are dealt to partitions and packed by best-fit decreasing. Each
partition's number of bins is certified against a lower bound from dual-feasible functions: if they are equal, it is optimal.
Partitions with a gap give up their emptiest bins (at most ``RELEASED`` pieces each; all other bins stay as they are), pool them with those of
their neighbours and rerun best-fit decreasing; a pool is taken over only if it needs fewer bins. This is repeated with wider pools, until one pool spans all partitions or
none has a gap. ``certificate`` compares the whole packing with the bound for all pieces.

Lower bound: for each t in 1 .. SIZE/2, the function that counts sizes over SIZE - t as 1, sizes under t as 0 and others as their
share of SIZE is dual-feasible, so the sum over all pieces, rounded up, is a bound. A histogram of sizes gives all t at once.

Scale: only (doc_id, piece, start, length, crc32) are moved, never texts or ids; partitions hold ``PARTITION_PIECES`` pieces and pools
are bounded by POOL * RELEASED, whatever the input.

Defined cases: a null or empty text is the single end token; repeated rows are packed each; documents longer than SIZE, however long, are cut
with the short piece first; of several bins that fit equally well the one opened or filled last is taken, and pieces of equal length are packed as they come; empty input: no rows; other columns of docs,
whatever they are called, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plinth.llm.common import materialize, pieces_for
from plinth.llm.token_rollup import TOKENIZER, encoder

SIZE = 1024
END = 2
PARTITION_PIECES = 25_000
RELEASED = 4096
POOL = 4
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end: int = END) -> DataFrame:
    """The token pieces of each row: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = encode(text or "")
                ids.append(end)
                raw = np.array(ids, "<u4").tobytes()
                first = len(ids) % size or size
                cuts = [0, *range(first, len(ids) + 1, size)]
                out += [(doc_id, i, lo, hi - lo, zlib.crc32(raw[4 * lo : 4 * hi])) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECE)


def lower_bound(lengths: np.ndarray, size: int = SIZE) -> int:
    """Bins that any packing needs at least."""
    count = np.bincount(lengths, minlength=size + 1)[: size + 1].astype(np.int64)
    over = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])  # over[s]: pieces of size s or more
    volume = np.concatenate([[0], np.cumsum(count * np.arange(size + 1))])  # volume[s]: of sizes below s
    t = np.arange(1, size // 2 + 1)
    shared = volume[size - t + 1] - volume[t]
    return int(max(-(-volume[-1] // size), (over[size - t + 1] + -(-shared // size)).max(initial=0)))


def best_fit_decreasing(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    Open bins are kept in one list per remaining space and the spaces in a bit set, so the best fit is found in constant time.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(size + 1)]
    spaces, n = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for at, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fit = spaces >> length
        if fit:
            space = (fit & -fit).bit_length() - 1 + length
            held = by_space[space]
            b = held.pop()
            if not held:
                spaces ^= 1 << space
        else:
            space, b = size, n
            n += 1
        bins[at], offsets[at] = b, size - space
        space -= length
        if space:
            by_space[space].append(b)
            spaces |= 1 << space
    return bins, offsets, n


def _released(bins: np.ndarray, lengths: np.ndarray, n: int, gap: int, size: int, most: int) -> np.ndarray:
    """Marks the pieces of the emptiest bins of a partition with a gap, at most ``most`` pieces."""
    if gap <= 0:
        return np.zeros(len(bins), bool)
    used = np.bincount(bins, lengths, n)
    held = np.bincount(bins, minlength=n)
    order = np.argsort(used, kind="stable")
    order = order[used[order] < size]
    give = np.zeros(n, bool)
    give[order[np.cumsum(held[order]) <= most]] = True
    return give[bins]


def _repacker(r: int, names: list[str], size: int, released: int):
    """Repacks a pool of given-up bins; the new packing counts only if it has fewer bins."""

    def again(t: pd.DataFrame) -> pd.DataFrame:
        lengths = t["length"].to_numpy(np.int64)
        bins, offsets, n = best_fit_decreasing(lengths, size)
        old = t["sequence_id"].nunique()
        if n < old:
            t = t.assign(sequence_id=(r << 60) + (int(t["part"].iloc[0]) << 32) + bins, offset=offsets)
        else:
            n, bins = old, pd.factorize(t["sequence_id"])[0]
        return t.assign(give=_released(bins, lengths, n, n - lower_bound(lengths, size), size, released))[names]

    return again


def pack(found: DataFrame, size: int = SIZE, rounds: int | None = None, partition_pieces: int = PARTITION_PIECES, released: int = RELEASED) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece (materialised pieces)."""
    parts = pieces_for(found.count(), partition_pieces)
    columns = [c.split()[0] for c in _PIECE.split(", ")]
    schema = f"{_PIECE}, sequence_id long, offset long, part long, give boolean"
    names = [*columns, "sequence_id", "offset", "part", "give"]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if rows:
            t = pa.Table.from_batches(rows)
            lengths, part = t.column("length").to_numpy(), TaskContext.get().partitionId()
            bins, offsets, n = best_fit_decreasing(lengths, size)
            give = _released(bins, lengths, n, n - lower_bound(lengths, size), size, released)
            t = t.append_column("sequence_id", pa.array((part << 32) + bins)).append_column("offset", pa.array(offsets)).append_column("part", pa.array(np.full(len(bins), part, np.int64))).append_column("give", pa.array(give))
            yield from t.to_batches()

    done = materialize(found.select(*columns).repartition(parts).mapInArrow(first, schema), "packed-0")
    for r in count(1):
        pool = F.floor(F.col("part") / POOL).cast("long")
        rows = done.where("give")
        if parts == 1 or rows.isEmpty() or (rounds is not None and r > rounds):
            break
        moved = rows.withColumn("part", pool).groupBy("part").applyInPandas(_repacker(r, names, size, released), schema)
        kept = done.where("not give").withColumn("part", pool)
        parts = pieces_for(parts, POOL)
        done = materialize(kept.select(*names).unionByName(moved), f"packed-{r}")
    return done.select(*columns, "sequence_id", "offset")


def certificate(packed: DataFrame, size: int = SIZE) -> dict[str, int]:
    """sequences, and bound: no packing of these pieces has fewer. From the histogram of lengths, at most ``size`` rows."""
    lengths = np.repeat(*np.array([(r.length, r.n) for r in packed.groupBy("length").agg(F.count("*").alias("n")).collect()], np.int64).reshape(-1, 2).T)
    return {"sequences": packed.select("sequence_id").distinct().count(), "bound": lower_bound(lengths, size)}
