"""The registered queries of this package: ``op<N>_<name>`` and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1, op10, op11, op12, op13, op2, op3, op4, op5, op6, op7, op8, op9, sql
from .tables import bucket_of, table


#: The key of the registered query; production passes its own, from a secret store.
KEY = "check-key"


def op1_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    counts = [f"n_{kind}" for kind in op1.KINDS]
    return op1.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), KEY).select("doc_id", "text", *counts)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = op2.scan(table(spark, folder, "documents"), path="doc_id")
    spans = F.col("spans")
    return found.select(
        F.col("path").alias("doc_id"),
        *[op2.count(spans, rule.kind).alias(f"n_{rule.kind}") for rule in op2.BASE],
        F.sha2(op2.digest(spans, base_only=True).cast("binary"), 256).alias("base_sha256"),
        op2.digest(spans, base_only=False).alias("spans"),
    )


def op10_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return op10.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    mixed = op9.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    train = bucket_of(F.col("doc_id"), 5) != 0
    scored, _ = op3.score(table(spark, folder, "documents"), table(spark, folder, "labels"), train)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_template_removal(spark: SparkSession, folder: str) -> DataFrame:
    return op4.main_text(table(spark, folder, "pages"))


def op5_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    return op5.score(table(spark, folder, "documents"), bucket_of(F.col("doc_id"), 7) == 2)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return op6.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    train = bucket_of(F.col("doc_id"), 5) != 0
    scored = op7.score(table(spark, folder, "documents"), table(spark, folder, "labels"), train)
    earlier = [F.col(name).alias(f"p_{name}") for name, _ in op7.CATEGORIES]
    return scored.select("doc_id", *earlier, F.col("toxic").alias("score"), (F.col("toxic") >= 0.5).cast("int").alias("predicted"))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return op8.near_duplicates(table(spark, folder, "documents"), k=4, share=85)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", op11.repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = op11.periodic_runs(docs).withColumn("best", op11.greatest(F.col("runs")))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        sha(op11.digest(F.col("runs"))).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op12_zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    packages = op12.write_packages(table(spark, folder, "pages"), op12.shared_path(spark, f"packages-{uuid.uuid4().hex}"))
    found = op12.read_records(packages, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op13.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_pseudonyms": op1_feistel_pseudonyms,
    "op2_secret_scan": op2_secret_scan,
    "op10_learned_partitions": op10_learned_partitions,
    "op9_mixture": op9_mixture,
    "op3_quality_rules": op3_quality_rules,
    "op4_template_removal": op4_template_removal,
    "op5_maxent_scores": op5_maxent_scores,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_zip_warc": op12_zip_warc,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op2_secret_scan": sql.secrets(),
    "op9_mixture": sql.mixing(),
    "op11_periodic_runs": sql.periodic_runs(),
    "op12_zip_warc": sql.archive(),
    "op13_hard_negatives": sql.hard_negatives(),
}
