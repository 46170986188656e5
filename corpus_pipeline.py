"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the docs of the next.
All but the last return the columns of documents.

Defined cases: a null or empty text is not toxic, has no personal data, is a copy of all other texts without words, counts no tokens, and is packed as one end token; very long texts are used whole in every stage; of
near-duplicates, and of repeated rows, the one of the smallest doc_id stays, once; rows without doc_id are never taken for copies; an empty table gives no rows; further columns stay up to packing, whatever they are
called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plinth.llm import common, mixing, packing, pii, simhash_groups, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. Documents of rejected severity go; the model is fitted on the labels that come with the tables."""
    return toxicity.without_toxic(docs, toxicity.train(docs, common.table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Of each group of near-duplicates the document of the smallest doc_id stays.

    As a stage on word shingles it takes five words and a similarity of 0.8: SimHash as wide as that needs, searched in the operator's
    vantage-point trees. Four of 64 bits would miss most pairs of that similarity.
    """
    return simhash_groups.representatives(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, with the session's key. n_chars is that of the new text."""
    done = pii.pseudonymise(docs, pii.session_key(spark), counts=False)
    kind = dict(docs.dtypes).get("n_chars")
    return done if kind is None else done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6. A calibrated sample of what is left."""
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. The pieces of all documents with their places in sequences."""
    return packing.pack(common.materialize(packing.pieces(docs), "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Tokens, hashes of shingles, a trained model and keyed permutations can't be expressed in SQL; tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
