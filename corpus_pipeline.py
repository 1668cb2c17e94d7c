"""A training corpus from raw documents in four stages, each an operator of ``promptmill.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the next stage gets it after it was
written as Parquet and read again.  All but the last keep the columns of ``documents``.

1. quality: documents that ordinal regression does not select go.
2. language: documents without letters, or unlike every learned language of their length, go.
3. near_duplicates: of each group that fingerprints link, the row with the smallest id stays.
4. packing: what is left is packed into sequences of 2048 tokens.

Defined cases: a document of null id has no rating, so only its text can reject it; groups are of
rows, so rows that repeat an id with different texts are different documents, and null ids come last
in a group; of equal ids in a group the row of the smallest text hash stays; other columns of ``docs``
go along; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm import langid, packing, quality, simhash
from promptmill.llm.registry import table
from promptmill.session import configure, materialize


def _passed_on(docs: DataFrame) -> tuple[DataFrame, list[str], list[Column]]:
    """``docs`` under names that no operator uses, with its text; these names; the columns again."""
    names = [f"_passed_{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")]))
    return renamed, names, [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    renamed, names, back = _passed_on(docs)
    return quality.rate(renamed, model, columns=tuple(names)).filter("selected").select(*back)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sums = langid.sums_by_language(docs)
    least = langid.least_cosines(docs, sums)
    renamed, names, back = _passed_on(docs)
    return langid.like_learned(renamed, sums, least, tuple(names)).filter("like").select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, names, back = _passed_on(docs)
    # Written once, so that a row keeps its number.
    rows = materialize(docs.toDF(*names).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    of = dict(zip(docs.columns, names))
    texts = rows.select(F.col("_row").alias("row"), F.col(of["doc_id"]).alias("doc_id"), F.col(of["text"]).alias("text"))
    stay = simhash.first_rows(texts).withColumnRenamed("row", "_row")
    return rows.join(stay, "_row", "left_semi").select(*back)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_pieces(packing.token_pieces(docs))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# Learned weights and prototypes decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
