"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents fall into cells (source, language, topic) with a token weight. Each cell has an inclusion probability p, at most 1. Raking scales the
cells by turns until the expected tokens of each source, language and topic are those wanted, and a document is taken if the hash of its
doc_id falls below the probability of its cell: repeatable, and independent of how rows are partitioned. No document is taken twice.

Wanted shares are the given ones or, by default, the tokens' own shares raised to ``power`` (below 1: small groups gain), normalised. The expected sample
holds ``fraction`` of all tokens. Where a value has fewer tokens than its share of that, all of them are wanted, and the rest of its share goes to the
other values of its dimension in proportion (``wanted``). A step of raking scales the cells of a value by one factor, found with the bound: cells that reach probability 1
give all they have, and the others make up what is missing.

The wanted tokens of three dimensions can exclude each other (a source whose tokens are nearly all of one topic). Then topics, which are raked last, come first and
languages before sources. ``shares`` reports the share asked for, the wanted and the achieved one of every value.

The topic of a document is that of the first matching rule of ``TOPICS``, a fixed list of substring rules.

Scale: one pass over the texts makes (cell, tokens) rows, aggregated before the shuffle; all raking is on the cell table (distinct sources x
languages x topics), never on documents, by windows over the cells of one value. The cell table joins back by an ordinary join, broadcast by Spark only if small.

Defined cases: null source or language: the value ``unknown``; null or empty text: no tokens, topic ``general`` and the
probability of its cell; a very long text counts whole; a cell without tokens: probability 1 (it costs nothing); a null doc_id hashes as an empty string; repeated rows share their fate;
targets for absent values are ignored and the others renormalised, a value without a target gets none, and a dimension of whose given targets no value occurs isn't raked; empty input: no rows; other
columns, whatever they are called, don't matter to ``mixed`` and stay as they are in ``sample``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plinth.llm.common import materialize

ROUNDS = 8
STEP = 2  # rounds in one statement
POWER = 0.5
FRACTION = 0.6
ONE_TASK_CELLS = 100_000  # a cell table up to this size is raked without shuffles, a larger one by value; the results are the same
UNKNOWN = "unknown"
#: (topic, substring of the lower-case text); the first that matches wins. Fixed values.
TOPICS = (("legal", "license"), ("tabular", " | "), ("contact", "@"), ("credentials", "token ="))
DIMENSIONS = ("__plinth_source", "__plinth_lang", "__plinth_topic")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    out = None
    for name, part in TOPICS:
        hit = F.coalesce(F.contains(F.lower(text), F.lit(part)), F.lit(False))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("general")


def _keys() -> dict[str, Column]:
    return {"__plinth_source": F.coalesce(F.col("source"), F.lit(UNKNOWN)), "__plinth_lang": F.coalesce(F.col("lang"), F.lit(UNKNOWN)), "__plinth_topic": topic(F.col("text"))}


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the MD5 of doc_id."""
    hexed = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8)
    return F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0)


def margins(cells: DataFrame) -> DataFrame:
    """dim, value, supply (tokens) of each value of the three dimensions."""
    parts = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in DIMENSIONS])).alias("m")
    return cells.select(parts, "tokens").groupBy("m.dim", "m.value").agg(F.sum("tokens").cast("double").alias("supply"))


def wanted(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, fraction: float = FRACTION) -> DataFrame:
    """dim, value, supply, share (asked for), want (tokens): the share of fraction of the tokens, bounded by the supply."""
    share = F.pow("supply", F.lit(power))
    for d in DIMENSIONS:
        if given := (targets or {}).get(d.rpartition("_")[2]):
            named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in given.items() for x in kv]), F.col("value")).cast("double"), F.lit(0.0))
            share = F.when(F.col("dim") == d, named).otherwise(share)
    every = Window.partitionBy("dim")
    out = margins(cells).withColumn("share", share).withColumn("share", F.col("share") / F.nullif(F.sum("share").over(every), F.lit(0.0)))
    # Those that run short first are counted with all they have. The factor of the others is the greatest over all places of the cut.
    last = every.orderBy(F.when(F.col("share") > 0, F.col("supply") / F.col("share")).desc_nulls_first(), "value").rowsBetween(Window.unboundedPreceding, 0)
    short = F.sum("supply").over(every) - F.sum("supply").over(last)
    out = out.withColumn("__cut", (fraction * F.sum("supply").over(every) - short) / F.nullif(F.sum("share").over(last), F.lit(0.0)))
    return out.select("dim", "value", "supply", "share", F.when(F.col("share").isNotNull(), F.least(F.col("supply"), F.max("__cut").over(every) * F.col("share"))).alias("want"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, fraction: float = FRACTION, rounds: int = ROUNDS) -> DataFrame:
    """DIMENSIONS, tokens, probability, and the wanted tokens ``__t<dimension>`` of its values, of each of the cells (DIMENSIONS, tokens) that have tokens."""
    out = cells.where("tokens > 0").withColumn("tokens", F.col("tokens").cast("double"))
    goal = materialize(wanted(out, targets, power, fraction).select("dim", "value", "want"), "wanted")
    for d in DIMENSIONS:
        out = out.join(goal.where(F.col("dim") == d).select(F.col("value").alias(d), F.col("want").alias(f"__t{d}")), d)
    out = materialize(out.withColumn("p", F.lit(fraction)), "cells")
    few = out.count() <= ONE_TASK_CELLS
    for done in range(0, rounds, STEP):
        query = "{cells}"
        for _ in range(min(STEP, rounds - done)):
            for d in DIMENSIONS:
                query = _scaled(d, query)
        # one statement for some rounds: it is analysed once; a cell table of few rows isn't worth dealing out
        out = materialize(out.sparkSession.sql(f"SELECT * FROM {query}", cells=out.coalesce(1) if few else out), "raked")
    return out.withColumn("probability", F.least(F.col("p"), F.lit(1.0))).drop("p")


_WANT = {d: f"__t{d}" for d in DIMENSIONS}
_KEPT = ", ".join([*DIMENSIONS, "tokens", *_WANT.values()])


def _scaled(d: str, cells: str) -> str:
    """SQL of a step: the cells of each value of d scaled by the factor with which they give the wanted tokens, no cell more than all it has.

    p may pass 1 and counts as 1 then. Of the cells in the order of p those behind some cut are full; the factor is the greatest over all places of the cut.
    """
    last = f"OVER (PARTITION BY {d} ORDER BY p, {', '.join(DIMENSIONS)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cut = f"({_WANT[d]} - (sum(tokens) OVER (PARTITION BY {d}) - sum(tokens) {last})) / nullif(sum(tokens * p) {last}, 0D)"
    cuts = f"SELECT *, {cut} AS cut FROM {cells}"
    return f"(SELECT {_KEPT}, p * coalesce(f, 1D) AS p FROM (SELECT *, max(cut) OVER (PARTITION BY {d}) AS f FROM ({cuts})))"


def cells_of(docs: DataFrame) -> DataFrame:
    """DIMENSIONS, tokens: the cells of docs."""
    rows = docs.select(*[c.alias(k) for k, c in _keys().items()], tokens(F.col("text")).alias("tokens"))
    return materialize(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")


def probabilities(docs: DataFrame, fraction: float = FRACTION, **options) -> DataFrame:
    """DIMENSIONS, probability per cell of docs."""
    return materialize(rake(cells_of(docs), fraction=fraction, **options).select(*DIMENSIONS, "probability"), "probabilities")


def shares(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, power: float = POWER, fraction: float = FRACTION, **options) -> DataFrame:
    """dimension, value, share (asked for), wanted, achieved: shares of the expected sample; achieved_of_all: of all tokens."""
    cells = cells_of(docs)
    raked = materialize(rake(cells, targets, power, fraction, **options), "raked")
    asked = wanted(cells.where("tokens > 0"), targets, power, fraction)
    part = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in DIMENSIONS])).alias("m")
    got = raked.select(part, "tokens", "probability").groupBy("m.dim", "m.value").agg(F.sum(F.col("tokens") * F.col("probability")).alias("got"))
    every = Window.partitionBy("dim")
    return asked.join(got, ["dim", "value"]).select(F.substring_index("dim", "_", -1).alias("dimension"), "value", "share", (F.col("want") / F.sum("want").over(every)).alias("wanted"), (F.col("got") / F.sum("got").over(every)).alias("achieved"), (F.col("got") / F.sum("supply").over(every)).alias("achieved_of_all"))


def mixed(docs: DataFrame, fraction: float = FRACTION, **options) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, selected of every row."""
    of = probabilities(docs, fraction, **options)
    rows = docs.select("doc_id", *[c.alias(k) for k, c in _keys().items()], tokens(F.col("text")).alias("tokens"))
    p = F.coalesce("probability", F.lit(1.0))
    joined = rows.join(of, list(DIMENSIONS), "left").withColumn("probability", p)
    return joined.select("doc_id", F.col("__plinth_source").alias("source"), F.col("__plinth_lang").alias("lang"), F.col("__plinth_topic").alias("topic"), "tokens", "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("selected"))


def sample(docs: DataFrame, fraction: float = FRACTION, **options) -> DataFrame:
    """The selected rows of docs, columns as given."""
    of = probabilities(docs, fraction, **options)
    keyed = docs.withColumns(_keys()).join(of.withColumnRenamed("probability", "__plinth_p"), list(DIMENSIONS), "left")
    return keyed.where(uniform(F.col("doc_id")) < F.coalesce("__plinth_p", F.lit(1.0))).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_sql(documents: str = "documents", fraction: float = FRACTION, power: float = POWER, rounds: int = ROUNDS, prefix: str = "") -> tuple[str, str]:
    """DuckDB: the CTEs (without WITH) of the same computation, and the name of the result, one row per document."""
    p = prefix
    topic_sql = "CASE " + " ".join(f"WHEN contains(lower(coalesce(text, '')), '{part}') THEN '{name}'" for name, part in TOPICS) + " ELSE 'general' END"
    parts = [
        f"{p}rows AS (SELECT *, coalesce(source, '{UNKNOWN}') AS k_source, coalesce(lang, '{UNKNOWN}') AS k_lang, {topic_sql} AS k_topic, coalesce(len(regexp_extract_all(text, '\\S+')), 0)::BIGINT AS k_tokens FROM {documents})",
        f"{p}cells AS (SELECT k_source, k_lang, k_topic, sum(k_tokens)::DOUBLE AS tokens FROM {p}rows GROUP BY ALL HAVING sum(k_tokens) > 0)",
    ]
    dims = ("source", "lang", "topic")
    for d in dims:
        parts.append(f"{p}m_{d} AS (SELECT k_{d}, sum(tokens) AS supply, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () AS share FROM {p}cells GROUP BY k_{d})")
        last = f"OVER (ORDER BY supply / share DESC, k_{d} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        parts.append(f"{p}c_{d} AS (SELECT *, ({fraction} * sum(supply) OVER () - (sum(supply) OVER () - sum(supply) {last})) / sum(share) {last} AS cut FROM {p}m_{d})")
        parts.append(f"{p}t_{d} AS (SELECT k_{d}, least(supply, max(cut) OVER () * share) AS t_{d} FROM {p}c_{d})")
    parts.append(f"{p}w0 AS MATERIALIZED (SELECT c.*, t_source, t_lang, t_topic, {fraction}::DOUBLE AS w FROM {p}cells c JOIN {p}t_source USING (k_source) JOIN {p}t_lang USING (k_lang) JOIN {p}t_topic USING (k_topic))")
    n = 0
    for _ in range(rounds):
        for d in dims:
            last = f"OVER (PARTITION BY k_{d} ORDER BY w, k_source, k_lang, k_topic ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            parts.append(f"{p}s{n + 1} AS (SELECT *, (t_{d} - (sum(tokens) OVER (PARTITION BY k_{d}) - sum(tokens) {last})) / nullif(sum(tokens * w) {last}, 0) AS cut FROM {p}w{n})")
            parts.append(f"{p}w{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (cut) REPLACE (w * coalesce(max(cut) OVER (PARTITION BY k_{d}), 1) AS w) FROM {p}s{n + 1})")
            n += 1
    parts.append(f"{p}prob AS (SELECT k_source, k_lang, k_topic, least(1.0, w) AS probability FROM {p}w{n})")
    parts.append(f"{p}mixed AS (SELECT r.*, coalesce(probability, 1.0) AS probability, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(probability, 1.0) AS selected FROM {p}rows r LEFT JOIN {p}prob USING (k_source, k_lang, k_topic))")
    return ",\n".join(parts), f"{p}mixed"
