"""Token counts as delta-maintained rollups.

A rollup is a set of additive totals (documents, tokens) by source, language and tokenizer version. It is never recounted:
changes arrive in batches, each batch is reduced to signed deltas per key, and the totals are the sums of committed deltas.

| change | delta |
|-|-|
| insert | +1 document, +tokens |
| delete | -1 document, -tokens |
| revise | 0 documents, tokens - old_tokens |

Commits are idempotent: a batch's deltas are written to a folder of their own, and then a manifest ``batches/<id>`` that names it is created without overwriting. If that
manifest is there, the batch has been committed and a retry does nothing, so a driver or executor lost at any time, or a second writer, leaves either all or
nothing of a batch. ``compact`` folds batches into a base that names them.

Scale: documents are reduced to (key, delta) before the shuffle; a rollup holds as many rows as there are keys.

Defined cases: null source or language: ``unknown``; null or empty text: 0 tokens, still a document; a very long text counts whole; repeated change rows
count each time, as they do in the feed; unknown kinds of change are refused; a key whose totals are 0 stays with 0; an empty batch commits and adds nothing; columns beyond those named are not read,
whatever they are called.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plinth.llm import common

UNKNOWN = "unknown"
KEY = ("source", "lang", "tokenizer")
TOKENIZER = "byte_bpe_50k"  # a file name of public_tokenizers: .json for tokenizers, .tiktoken with the same vocabulary as ranks
BPE, WORDS = "byte_bpe_50k", "words_v1"
FILES = 8  # of a batch or base: totals are small, but not one task's work at any number of keys
CHANGES = "doc_id long, kind string, source string, lang string, tokenizer string, tokens long, old_tokens long"


@lru_cache(2)
def encoder(name: str = TOKENIZER) -> Callable[[str], list[int]]:
    """The ids that ``tokenizers`` gives with this vocabulary and add_special_tokens=False, made by tiktoken from the ranks file.

    The vocabulary's added tokens are single tokens where a text holds them, as they are for ``tokenizers``.
    """
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        return own.encode(text, allowed_special="all") if any(t in text for t in added) else own.encode_ordinary(text)

    return encode


def counted(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, lang, and tokens by BPE and by words of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            texts = [t or "" for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array([len(encode(t)) for t in texts], pa.int64()), pa.array([len(t.split()) for t in texts], pa.int64())], names=["doc_id", "source", "lang", "bpe", "words"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit(UNKNOWN)).alias("source"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return base.mapInArrow(run, "doc_id long, source string, lang string, bpe long, words long")


def changes(counts: DataFrame, kind: str, tokenizer: str, tokens: str, old: str | None = None) -> DataFrame:
    """A batch of changes of one kind from counted documents."""
    return counts.select("doc_id", F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.col(tokens).alias("tokens"), (F.col(old) if old else F.lit(None)).cast("long").alias("old_tokens"))


def deltas(batch: DataFrame) -> DataFrame:
    """KEY, documents, tokens: the signed sums of a batch of changes."""
    kind = F.col("kind")
    sign = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null")))).cast("int"))
    count = F.coalesce("tokens", F.lit(0))
    change = F.when(kind == "revise", count - F.coalesce("old_tokens", F.lit(0))).when(kind == "delete", -count).otherwise(count)
    keyed = batch.select(F.coalesce("source", F.lit(UNKNOWN)).alias("source"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("tokenizer", F.lit(UNKNOWN)).alias("tokenizer"), sign.cast("long").alias("documents"), change.cast("long").alias("tokens"))
    return keyed.groupBy(*KEY).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Committed deltas in a folder that all executors share.

    ``data`` holds folders of deltas, each written once under a name of its own and never changed. ``batches/<id>`` and ``base/<number>`` are manifests, files
    of a few bytes that name such a folder. A manifest is made in one step that fails if it is there, so of several writers one wins.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _write(self, df: DataFrame) -> str:
        name = common.uuid.uuid4().hex
        df.coalesce(FILES).write.parquet(f"{self.path}/data/{name}")
        return name

    def _claim(self, manifest: str, content: dict) -> bool:
        return common.create_file(self.spark, f"{self.path}/{manifest}", json.dumps(content))

    def _base(self) -> tuple[int, dict]:
        """The number of the newest base, and its manifest (data: folder, folded: batch id -> its folder)."""
        names = common.children(self.spark, f"{self.path}/base")
        return (int(names[-1]), json.loads(common.read_file(self.spark, f"{self.path}/base/{names[-1]}"))) if names else (-1, {"data": None, "folded": {}})

    def _open(self, folded: dict) -> dict[str, str]:
        """Batches that are committed and not in a base: id -> folder."""
        names = [b for b in common.children(self.spark, f"{self.path}/batches") if b not in folded]
        return {b: json.loads(common.read_file(self.spark, f"{self.path}/batches/{b}"))["data"] for b in names}

    def committed(self) -> list[str]:
        folded = self._base()[1]["folded"]
        return sorted({*folded, *common.children(self.spark, f"{self.path}/batches")})

    def commit(self, batch_id: str, batch: DataFrame) -> bool:
        """Applies a batch once; False if it has been applied before, by this or another writer."""
        if not batch_id or "/" in batch_id or batch_id[0] in "._":
            raise ValueError("a batch id is a non-empty name without slashes that doesn't begin with a point or an underscore")
        if common.exists(self.spark, f"{self.path}/batches/{batch_id}"):
            return False
        name = self._write(deltas(batch))
        done = self._claim(f"batches/{batch_id}", {"data": name})
        if not done:  # another writer was first
            common.delete(self.spark, f"{self.path}/data/{name}")
        return done

    def _sum(self, folders: list[str]) -> DataFrame:
        schema = "source string, lang string, tokenizer string, documents long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)
        return rows.groupBy(*KEY).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """The sums of what is committed now; what is committed later doesn't change them."""
        base = self._base()[1]
        return self._sum([base["data"]] * bool(base["data"]) + sorted(self._open(base["folded"]).values()))

    def compact(self) -> bool:
        """Folds the batches that are committed now into a new base; False if another compaction was first.

        Just the folders that the new base names are summed, so a batch that is committed meanwhile stays open. Manifests and folders stay, so that retries are known and
        totals that were asked for before can still be read; ``vacuum`` deletes the folders.
        """
        number, base = self._base()
        batches = self._open(base["folded"])
        name = self._write(self._sum([base["data"]] * bool(base["data"]) + sorted(batches.values())))
        return self._claim(f"base/{number + 1:08d}", {"data": name, "folded": base["folded"] | batches})

    def vacuum(self) -> None:
        """Deletes the folders that the newest base has folded, and those of older bases. Only while no earlier totals are being read."""
        number, base = self._base()
        older = [json.loads(common.read_file(self.spark, f"{self.path}/base/{n}"))["data"] for n in common.children(self.spark, f"{self.path}/base") if int(n) < number]
        for folder in {*base["folded"].values(), *older}:
            common.delete(self.spark, f"{self.path}/data/{folder}")
