"""A training-corpus pipeline over ``documents``: stages that each read what their predecessor wrote.

Columns of the documents pass through all stages but the last unchanged, except that secrets are masked in ``text`` (and
``n_chars`` follows where it exists).  The last stage adds ``size``, ``source_size``, ``target`` and ``taken`` and leaves
out the text of the rows it weighs.

The quality stage scores documents by id and leaves out rows without one.  Rows that share an id and differ in their text are
documents of their own for the near-duplicate stage; rows equal in all columns are one.  Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.llm import op2, op3, op6, op8, op9
from lapforge.llm.tables import bucket_of, parked, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents below this score are rejected.
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    train = bucket_of(F.col("doc_id"), 5) != 0
    scored, _ = op3.score(docs, table(spark, folder, "labels"), train)
    good = scored.where(F.col("score") >= QUALITY).select("doc_id").distinct()
    return docs.join(good, "doc_id", "left_semi").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near copies: the one with the smallest id, by words of five and a similarity of 0.8."""
    return op8.representatives(docs, k=5, share=80)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    found = op6.leaks(docs, table(spark, folder, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def masked(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace every secret by a mark; documents without any stay as they are."""
    _, ledger = op2.scan(docs, path="doc_id")
    hits = ledger.where(F.size("spans") > 0).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    joined = docs.withColumn("__blob", op2.blob_of(F.col("text"))).join(hits, "__blob", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(op2.redacted(F.col("text"), F.col("__spans")))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
        joined = joined.withColumn("n_chars", length)
    return joined.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Words taken of every document so that the sources reach their targets."""
    return op9.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", masked),
    ("mixing", mixed),
]

#: Models and similarity groups have no SQL form; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = parked(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
