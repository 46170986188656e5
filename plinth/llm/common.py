"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import math
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ROUNDS = 200  # of contraction; a chain of any length needs some 2 log2 of it
_written: list[str] = []


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with so many underscores added that no column is called so (letter case aside)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    A temporary folder is set only in a local session without that setting (tests, a laptop); on a cluster its lack is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="plinth-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _filesystem(spark, path)
    return fs.exists(hadoop)


def create_file(spark: SparkSession, path: str, content: str) -> bool:
    """Makes a file that holds a JSON object; False if there is one. Never overwrites: the file system's exclusive creation decides between writers.

    A local disk shows the file before it is filled, so ``read_file`` waits for the closing brace.
    """
    fs, hadoop = _filesystem(spark, path)
    fs.mkdirs(hadoop.getParent())
    try:
        out = fs.create(hadoop, False)
    except Exception as e:
        if fs.exists(hadoop):
            return False
        raise e
    out.write(bytearray(content.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str, tries: int = 50) -> str:
    """The content of a file that ``create_file`` made, a JSON object."""
    fs, hadoop = _filesystem(spark, path)
    for _ in range(tries):
        source = fs.open(hadoop)
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        if text.endswith("}"):
            return text
        time.sleep(0.2)
    raise RuntimeError(f"{path} is not complete")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _filesystem(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _filesystem(spark, path)
    fs.delete(hadoop, True)


def _clean_up() -> None:
    spark = SparkSession.getActiveSession()
    for path in _written if spark else []:
        try:
            delete(spark, path)
        except Exception:  # the session may be closing
            return


atexit.register(_clean_up)


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/plinth/{tag}-{uuid.uuid4().hex[:12]}"
    _written.append(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    Cuts lineage, keeps an expensive result from being computed twice, and survives lost
    executors since the files are not theirs.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces_for(rows: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / each))


def connected_components(edges: DataFrame) -> DataFrame:
    """Labels the nodes of an edge list (a, b): node, label.

    Randomised contraction: every node joins the neighbour of least priority (its own if it is
    less), edges are renamed and loops dropped, until none is left. The priority is salted anew in each
    round, so chains shrink by a constant factor. Nothing is sent to the driver but a row count.
    """
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = materialize(edges.select("a", "b").where("a <> b").select(*ordered).distinct(), "edges")
    few = pieces_for(edges.count(), 50_000, 4)  # tasks for what is left of a round: the links are few, the shuffle's partitions many
    cut = lambda df, tag: materialize(df.coalesce(few), tag)
    labels = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    for salt in range(ROUNDS + 1):
        if edges.isEmpty():
            break
        if salt == ROUNDS:
            raise RuntimeError(f"{edges.count()} links are left after {ROUNDS} rounds of contraction")

        def priority(c, salt=salt):
            return F.struct(F.xxhash64(F.lit(salt), c).alias("p"), c.alias("n"))

        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        parent = both.groupBy("a").agg(F.min(priority(F.col("b"))).alias("best")).select(F.col("a").alias("n"), F.least(F.col("best"), priority(F.col("a")))["n"].alias("parent"))
        parent = cut(parent, "parents")
        labels = cut(labels.join(parent, labels.label == parent.n, "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        left, right = parent.select(F.col("n").alias("a"), F.col("parent").alias("pa")), parent.select(F.col("n").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = cut(moved.distinct(), "edges")
    return labels
