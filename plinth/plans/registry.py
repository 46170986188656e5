"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals a scan of fewer partitions with rows than cores to all cores, for work that costs far more than moving the rows.

    A table with a single row group is one task, however long its texts take and however many partitions its file is cut into; rows are counted without reading a column. Large inputs have more and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        per = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
        if (per.most or 0) * cores <= 4 * (per.rows or 0):
            return df
    return df.repartition(cores)


def query(sql: str | None):
    """Registers a query under its function's name; None where SQL can't express it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
