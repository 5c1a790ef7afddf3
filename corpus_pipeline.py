"""Corpus pipeline: each stage is one operator of ``forgerank.llm`` applied to what its
predecessor kept. Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of ``documents``.

Rows of ``docs`` are documents: the stages that drop rows decide by a key of each row, which
is stored before they look at it, so rows with null or repeated ids are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgerank.llm import op1_bpe, op4_decontaminate, op5_ngram_join, op7_secrets, op10_classifier
from forgerank.llm.common import free_name, table
from forgerank.session import scratch_path, shared


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (operator 10), scored from their whole text."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    scored = op10_classifier.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(cols)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, stored with a key of each row, and the key's name."""
    key = free_name(docs, "row_key")
    return shared(docs.withColumn(key, F.monotonically_increasing_id()), "keyed_rows"), key


def _without_rows(docs: DataFrame, key: str, drop: DataFrame) -> DataFrame:
    """The rows whose key is not in ``drop``'s only column, without the key."""
    drop = drop.toDF("__drop").distinct()
    return docs.join(drop, docs[key] == F.col("__drop"), "left_anti").drop(key)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (operator 5): the one with the smallest id,
    of several with this id or with none the first."""
    docs, key = _keyed(docs)
    groups = op5_ngram_join.near_duplicates(docs.select(F.col(key).alias("doc_id"), "text"))
    groups = shared(groups.select(F.col("doc_id").alias("r"), F.col("component_id").alias("c")), "row_groups")
    many = groups.where("r <> c").select("c").distinct()
    rows = groups.join(many, "c", "left_semi").join(docs.select(F.col(key).alias("r"), "doc_id"), "r")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "r")
    first = rows.groupBy("c").agg(F.min(rank).alias("first")).select("c", F.col("first.r").alias("stays"))
    return _without_rows(docs, key, rows.join(first, "c").where("r <> stays").select("r"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no benchmark item overlaps with (operator 4)."""
    docs, key = _keyed(docs)
    found = op4_decontaminate.overlaps(docs.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without_rows(docs, key, found.select("doc_id"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in a text masked (operator 7)."""
    return op7_secrets.redact(docs, spark)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids (operator 1), with digests of the ids and of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = op1_bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded=True)
    return out.select("doc_id", "ids", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", bpe_encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage_{k}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs


# The classifier and the encoder cannot be said in SQL; tests/llm compare with brute force.
ORACLE_SQL = None
