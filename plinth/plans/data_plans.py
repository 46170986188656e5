"""Report, bucket, split, weight and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plinth.operators import datasets as D, reports as R
from plinth.plans.registry import query, table


@query("""SELECT o_orderkey, (o_totalprice / 500000.0)::DOUBLE AS confidence, CASE WHEN o_totalprice / 500000.0 > 0.5 AND o_orderpriority <> '5-LOW' THEN 'high' ELSE 'low' END AS bucket FROM
(SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders)""")
def bucket_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise((F.col("o_totalprice") / 500000.0).cast("string"))
    rows = R.bucket_rows(o.select(F.col("o_orderkey").alias("image_file"), F.col("o_orderpriority").alias("label"), raw.alias("confidence")))
    return rows.select(F.col("image_file").alias("o_orderkey"), "confidence", "bucket")


def records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("report_id"), F.col("l_partkey").alias("page"))


@query("SELECT l_suppkey AS report_id, count(DISTINCT l_partkey) AS pages_used, count(*) AS images FROM lineitem GROUP BY l_suppkey")
def per_report_stats(spark, sf_dir):
    return R.report_stats(records(spark, sf_dir))


@query("SELECT count(*) AS reports, sum(p)::BIGINT AS pages_used, sum(n)::BIGINT AS images FROM (SELECT l_suppkey, count(DISTINCT l_partkey) AS p, count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def run_totals(spark, sf_dir):
    return R.totals(R.report_stats(records(spark, sf_dir)))


@query("""WITH r AS (SELECT o_custkey AS key, year(o_orderdate) AS y, count(DISTINCT o_orderpriority) AS p, count(*) AS n FROM orders GROUP BY ALL),
p AS (SELECT * FROM r WHERE y = 1996), c AS (SELECT * FROM r WHERE y = 1997)
SELECT coalesce(p.key, c.key) AS key, CASE WHEN p.key IS NULL THEN 'NEW' WHEN c.key IS NULL THEN 'REMOVED' WHEN p.p = c.p AND p.n = c.n THEN 'SAME' ELSE 'CHANGED' END AS status,
coalesce(p.p, 0) AS pages_before, coalesce(p.n, 0) AS images_before, coalesce(c.p, 0) AS pages_now, coalesce(c.n, 0) AS images_now FROM p FULL JOIN c ON p.key = c.key""")
def snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    of = lambda y: o.where(F.year("o_orderdate") == y).groupBy(F.col("o_custkey").alias("key")).agg(F.countDistinct("o_orderpriority").alias("pages_used"), F.count("*").alias("images"))
    return R.diff(of(1996), of(1997)).fillna(0)  # of no run: 0


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_files_anti(spark, sf_dir):
    return R.missing(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT l_orderkey, l_linenumber, (l_partkey % 100)::DOUBLE AS x0, (l_partkey % 100 + l_quantity) AS x1, (l_suppkey % 50)::DOUBLE AS y0, (l_suppkey % 50 + l_quantity) AS y1, l_quantity AS dx, l_quantity AS dy,
CASE WHEN l_linenumber % 2 = 0 THEN l_tax * 100 END AS rtx0, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS rtx1 FROM lineitem""")
def flatten_boxes(spark, sf_dir):
    from plinth.functions import geometry as G

    li = table(spark, sf_dir, "lineitem")
    x, y, q = (F.col("l_partkey") % 100).cast("double"), (F.col("l_suppkey") % 50).cast("double"), F.col("l_quantity")
    rows = li.select("l_orderkey", "l_linenumber", G.rect(x, y, x + q, y + q).alias("bbox"), F.when(F.col("l_linenumber") % 2 == 0, G.rect(F.col("l_tax") * 100, y, q, y + q)).alias("right_text_bbox"))
    return R.flatten_boxes(rows).select("l_orderkey", "l_linenumber", "x0", "x1", "y0", "y1", "dx", "dy", "rtx0", "rtx1")


_INDEX_SQL = "ix AS (SELECT p_brand AS observation_id, max(p_partkey)::INTEGER AS class_index FROM part WHERE p_size > 10 GROUP BY p_brand)"


def index(spark, sf_dir) -> DataFrame:
    return D.class_index(table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_brand").alias("id"), F.col("p_partkey").alias("ord")))


def manifest(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("observation_id"), "p_type", "p_size")


@query(f"WITH {_INDEX_SQL} SELECT * FROM ix")
def class_index(spark, sf_dir):
    return index(spark, sf_dir)


@query(f"WITH {_INDEX_SQL} SELECT p_partkey, p_brand AS observation_id, class_index FROM part JOIN ix ON p_brand = observation_id")
def taxonomy_semijoin(spark, sf_dir):
    return D.labelled(manifest(spark, sf_dir), index(spark, sf_dir)).select("p_partkey", "observation_id", "class_index")


@query("SELECT p_size AS class_index, (dense_rank() OVER (ORDER BY p_size) - 1)::INTEGER AS remapped FROM (SELECT DISTINCT p_size FROM part)")
def active_remap(spark, sf_dir):
    train, val = (manifest(spark, sf_dir).where(f"p_partkey % 10 {op} 7").select(F.col("p_size").alias("class_index")) for op in ("<", ">="))
    return D.dense_remap(train.union(val))


_CLASSES_SQL = "c AS (SELECT DISTINCT p_size AS class_index FROM part), n AS (SELECT p_size AS class_index, count(*) AS n FROM part WHERE p_size % 5 <> 0 GROUP BY p_size)"


def _classes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part").select(F.col("p_size").alias("class_index"))
    return p, p.where("class_index % 5 <> 0")


@query(f"WITH {_CLASSES_SQL} SELECT class_index, 1.0::DOUBLE / greatest(coalesce(n, 0), 1) AS weight FROM c LEFT JOIN n USING (class_index)")
def class_weights_a(spark, sf_dir):
    return D.inverse_weights(*_classes(spark, sf_dir))


@query(f"WITH {_CLASSES_SQL}, w AS (SELECT class_index, 1.0::DOUBLE / greatest(coalesce(n, 0), 1) AS w FROM c LEFT JOIN n USING (class_index)) SELECT class_index, round(w / sum(w) OVER () * count(*) OVER (), 6) AS weight FROM w")
def class_weights_b(spark, sf_dir):
    return D.normalised_weights(*_classes(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("""WITH g AS (SELECT DISTINCT source FROM documents), r AS (SELECT source, row_number() OVER (ORDER BY md5('1337|' || source), source) AS r, count(*) OVER () AS n FROM g)
SELECT source, CASE WHEN r <= ceil(0.15 * n) THEN 'test' ELSE 'train' END AS split FROM r""")
def group_holdout(spark, sf_dir):
    return D.group_holdout(table(spark, sf_dir, "documents"), "source")


@query(None)
def group_kfold(spark, sf_dir):
    return D.group_kfold(table(spark, sf_dir, "documents"), "source")


@query(f"""WITH w AS (SELECT doc_id, 1.0::DOUBLE + 4 * toxic AS w FROM labels), c AS (SELECT doc_id, w, sum(w) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS high, sum(w) OVER () AS total FROM w)
SELECT doc_id, (ceil(high / total * 1000 - {D.shift_of(0)!r}) - ceil((high - w) / total * 1000 - {D.shift_of(0)!r}))::BIGINT AS times FROM c""")
def weighted_sample(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return D.weighted_draws(labels.withColumn("w", 1.0 + 4 * F.col("toxic")), "w", "doc_id", 1000)


_PAIRS_SQL = "p AS (SELECT label AS y, ((label + CASE WHEN vec_id % 4 = 0 THEN 1 ELSE 0 END) % 10)::INTEGER AS pred FROM embeddings)"
_REPORT_SQL = f"""{_PAIRS_SQL},
l AS (SELECT y AS label FROM p UNION SELECT pred FROM p),
s AS (SELECT label, (SELECT count(*) FROM p WHERE y = label) AS support, (SELECT count(*) FROM p WHERE pred = label) AS predicted, (SELECT count(*) FROM p WHERE y = label AND pred = label) AS hit FROM l),
r AS (SELECT label, support, coalesce(hit / nullif(predicted, 0)::DOUBLE, 0) AS precision, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall FROM s),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM r)"""


def pairs(spark, sf_dir) -> DataFrame:
    wrong = F.when(F.col("vec_id") % 4 == 0, 1).otherwise(0)
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("y"), ((F.col("label") + wrong) % 10).cast("int").alias("pred"))


@query(f"WITH {_REPORT_SQL} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f")
def classification_report(spark, sf_dir):
    r = D.classification_report(pairs(spark, sf_dir))
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(f"WITH {_REPORT_SQL} SELECT round(sum(recall * support) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f")
def report_averages(spark, sf_dir):
    a = D.averages(D.classification_report(pairs(spark, sf_dir)))
    return a.select(*[F.round(c, 6).alias(c) for c in a.columns])


@query("""WITH g AS (SELECT unnest(range(26)) AS i), t AS (SELECT round(0.5 + i * 0.1, 10) AS t FROM g),
e AS (SELECT (label % 8)::INTEGER AS y, list_transform(embedding, lambda x: 10 * x::DOUBLE) AS l FROM embeddings),
s AS (SELECT t, y, list_transform(l, lambda x: x / t) AS z FROM e, t),
n AS (SELECT t, list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[y + 1] AS nll FROM s),
m AS (SELECT t, round(avg(nll), 9) AS mean_nll FROM n GROUP BY t)
SELECT t AS temperature, round(mean_nll, 6) AS mean_nll FROM m ORDER BY m.mean_nll, t LIMIT 1""")
def temperature_search(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select((F.col("label") % 8).cast("int").alias("y"), F.transform("embedding", lambda x: x.cast("double") * 10).alias("logits"))
    return D.best_temperature(e).select("temperature", F.round("mean_nll", 6).alias("mean_nll"))


@query("""SELECT o_custkey, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(sum(o_totalprice * o_shippriority) / sum(o_totalprice), 6) AS mean_loss
FROM (SELECT *, length(o_orderpriority) AS o_shippriority FROM orders) GROUP BY o_custkey""")
def evaluate_batches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("loss", F.length("o_orderpriority"))
    return o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("accuracy"), F.round(F.sum(F.col("o_totalprice") * F.col("loss")) / F.sum("o_totalprice"), 6).alias("mean_loss"))


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: 10 * x::DOUBLE) AS l FROM embeddings)
SELECT vec_id, (list_position(l, list_max(l)) - 1)::INTEGER AS best, round(exp(l[3] - list_max(l)) / list_sum(list_transform(l, lambda x: exp(x - list_max(l)))), 6) AS entailment,
round(list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l))))), 6) AS log_sum FROM e""")
def logit_functions(spark, sf_dir):
    from plinth.functions import similarity as S

    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 10).alias("l"))
    return e.select("vec_id", S.argmax(F.col("l")).alias("best"), F.round(S.softmax_at(F.col("l"), 2), 6).alias("entailment"), F.round(S.log_sum_exp(F.col("l")), 6).alias("log_sum"))
