"""Preparing training sets and evaluating on them."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from plinth.functions import similarity as S


def class_index(items: DataFrame) -> DataFrame:
    """observation_id, class_index: the catalogue position (the last one of a repeated id)."""
    return items.groupBy(F.col("id").alias("observation_id")).agg(F.max("ord").cast("int").alias("class_index"))


def labelled(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of the manifest whose class is known, with class_index."""
    return manifest.join(index, "observation_id")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with the position (from 0, long) of each row in the order.

    Range-partitioned ranks: each part is ranked by itself and shifted by the sizes of the parts before it, so no task orders all rows.
    """
    parts = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    sizes = parts.groupBy("__part").agg(F.count("*").alias("n"))  # parts are numbered in the order
    before = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"))  # a row per partition
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn("__rank", rank).join(F.broadcast(before), "__part").withColumn(name, F.col("__rank") + F.col("__before")).drop("__part", "__rank", "__before")


def dense_remap(used: DataFrame, column: str = "class_index") -> DataFrame:
    """column, remapped: distinct classes numbered from 0 in ascending order."""
    distinct = used.select(column).where(F.col(column).isNotNull()).distinct()
    return numbered(distinct, [F.col(column)], "remapped").select(column, F.col("remapped").cast("int").alias("remapped"))


def remapped(rows: DataFrame, remap: DataFrame, column: str = "class_index", name: str = "class_index_remap") -> DataFrame:
    """Rows with their class in the dense numbering; rows of other classes go."""
    return rows.join(remap.withColumnRenamed("remapped", name), column)


def row_weights(rows: DataFrame, weights: DataFrame, column: str = "class_index") -> DataFrame:
    """Rows with the sampling weight of their class, 0 without one."""
    return rows.join(weights.select(column, "weight"), column, "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def decoded(predictions: DataFrame, remap: DataFrame, items: DataFrame, column: str = "pred") -> DataFrame:
    """Predictions in the dense numbering with class_index, and id, label and sheet of the item; null where there is none."""
    back = remap.select(F.col("class_index"), F.col("remapped").alias(column))
    named = items.select(F.col("ord").alias("class_index"), F.col("id").alias("observation_id"), "label", "sheet")
    return predictions.join(back, column, "left").join(named, "class_index", "left")


def inverse_weights(classes: DataFrame, counts: DataFrame, column: str = "class_index") -> DataFrame:
    """column, weight = 1 / max(count, 1) of the active classes."""
    own = counts.groupBy(column).agg(F.count("*").alias("n"))
    return classes.select(column).distinct().join(own, column, "left").select(column, (1.0 / F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))).alias("weight"))


def normalised_weights(classes: DataFrame, counts: DataFrame, column: str = "class_index") -> DataFrame:
    """column, weight: inverse frequency (1 for absent classes), scaled to a sum of the number of classes."""
    raw = inverse_weights(classes, counts, column)
    totals = raw.agg(F.sum("weight").alias("s"), F.count("*").alias("k"))
    return raw.crossJoin(F.broadcast(totals)).select(column, (F.col("weight") / F.col("s") * F.col("k")).alias("weight"))


def group_holdout(rows: DataFrame, group: str, share: float = 0.15, seed: int = 1337) -> DataFrame:
    """group, split: ceil(share * groups) whole groups go to test, those of the least MD5 of seed and name."""
    groups = rows.select(group).distinct().withColumn("__h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(group).cast("string"))))
    placed = numbered(groups, [F.col("__h"), F.col(group)], "__at")
    tests = -int(-share * groups.count() // 1)
    return placed.select(group, F.when(F.col("__at") < tests, "test").otherwise("train").alias("split"))


def dealt(load: list[int], size: int, groups: int) -> list[int]:
    """How many of so many groups of one size each fold gets if each goes to the lightest fold, the first of those equally light."""
    upto = lambda level: [max(0, -(-(level - x) // size)) for x in load]  # noqa: E731  (groups until no fold is lighter than the level)
    low, high = min(load), max(load) + size * groups
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(upto(middle)) <= groups else (low, middle - 1)
    counts, rest = upto(low), groups - sum(upto(low))
    for j, x in enumerate(load):
        if rest and x + counts[j] * size == low:
            counts[j], rest = counts[j] + 1, rest - 1
    return counts


def group_kfold(rows: DataFrame, group: str, k: int = 5) -> DataFrame:
    """group, fold: groups by size descending, each to the lightest fold.

    Groups of one size are interchangeable, so the driver only computes how many of each size every fold gets: it handles distinct sizes (at most the square root of twice the rows), never groups. The groups of a
    size go to folds in the order of their names, each fold's in one run.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("n"))
    load, plan = [0] * k, []
    for r in sizes.groupBy("n").agg(F.count("*").alias("m")).orderBy(F.desc("n")).collect():
        at = 0
        for fold, count in enumerate(dealt(load, r.n, r.m)):
            plan.append((r.n, at, at + count, fold))
            load[fold] += r.n * count
            at += count
    runs = rows.sparkSession.createDataFrame(plan, "n long, low long, high long, fold int")
    placed = numbered(sizes, [F.desc("n"), F.col(group)], "__at")
    first = runs.groupBy("n").agg(F.max("high").alias("m"))
    before = first.select("n", (F.sum("m").over(Window.orderBy(F.desc("n"))) - F.col("m")).alias("__before"))  # a row per size
    ranked = placed.join(before, "n").withColumn("__i", F.col("__at") - F.col("__before"))
    return ranked.join(runs, "n").where((F.col("__i") >= F.col("low")) & (F.col("__i") < F.col("high"))).select(group, "fold")


def shift_of(seed: int) -> float:
    return int(hashlib.md5(str(seed).encode()).hexdigest()[:8], 16) / 2**32


def weighted_draws(rows: DataFrame, weight: str, key: str, draws: int, seed: int = 0) -> DataFrame:
    """key, times: how often each row is drawn in ``draws`` draws with replacement, in proportion to its weight.

    Systematic sampling: a row that covers [a, b) of the cumulated weight gets the grid points in it. Cumulated per partition, with the
    offsets of partitions before it.
    """
    parts = rows.select(key, F.col(weight).cast("double").alias("w")).repartitionByRange(key).withColumn("__p", F.spark_partition_id())
    sums = parts.groupBy("__p").agg(F.sum("w").alias("s"))
    offsets = sums.select("__p", (F.sum("s").over(Window.orderBy("__p")) - F.col("s")).alias("o"), F.sum("s").over(Window.partitionBy(F.lit(0))).alias("total"))  # a row per partition
    run = F.sum("w").over(Window.partitionBy("__p").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("__run", run).join(F.broadcast(offsets), "__p")
    at = lambda c: F.ceil(c / F.col("total") * draws - shift_of(seed))
    high = F.col("o") + F.col("__run")
    return placed.select(key, (at(high) - at(high - F.col("w"))).cast("long").alias("times"))


def classification_report(pairs: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support of pairs (y, pred); 0 where a denominator is 0."""
    counts = pairs.groupBy("y", "pred").agg(F.count("*").alias("n"))
    sides = counts.select(F.explode(F.array(F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    by = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    out = by.withColumns({"precision": ratio("hit", "predicted"), "recall": ratio("hit", "support")})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return out.select("label", "precision", "recall", f1.alias("f1"), "support")


def averages(report: DataFrame) -> DataFrame:
    """One row: accuracy, macro_f1, weighted_f1."""
    n = F.sum("support")
    return report.agg((F.sum(F.col("recall") * F.col("support")) / n).alias("accuracy"), F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"))


def nll(logits: Column, y: Column, temperature: Column) -> Column:
    scaled = F.transform(logits, lambda x: x / temperature)
    return S.log_sum_exp(scaled) - F.get(scaled, y)


def best_temperature(rows: DataFrame, low: float = 0.5, high: float = 3.0, step: float = 0.1) -> DataFrame:
    """One row: temperature, mean_nll: the grid point of least mean loss of rows (y, logits), ties to the lowest.

    All grid points are evaluated in one pass over the rows.
    """
    grid = [round(low + i * step, 10) for i in range(round((high - low) / step) + 1)]
    # the logits less their greatest, made once; a grid point then needs one pass over them
    rows = rows.select(F.transform("logits", lambda x: x - F.array_max("logits")).alias("c"), "y").select("c", F.get("c", F.col("y")).alias("own"))
    loss = lambda t: F.log(F.aggregate("c", F.lit(0.0), lambda s, x: s + F.exp(x / t))) - F.col("own") / t
    means = rows.agg(*[F.avg(loss(t)).alias(f"t{i}") for i, t in enumerate(grid)])
    best = F.array_min(F.array(*[F.struct(F.round(f"t{i}", 9).alias("mean_nll"), F.lit(t).alias("temperature")) for i, t in enumerate(grid)]))
    return means.select(best.alias("b")).select("b.temperature", "b.mean_nll")
