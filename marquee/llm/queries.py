"""The operators as named queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (class_lm, conversation_repair, decontaminate, jaccard_join, licenses, merkle, near_vectors, packing, quality,
                         reply_trees, secrets, statements, token_counts, toxicity)
from marquee.llm.shared import read_table, remainder
from marquee.session import tune

FOLDS = 5


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per pair."""
    tune(spark)
    return decontaminate.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose three-word shingle sets are similar by 0.9."""
    tune(spark)
    return jaccard_join.jaccard_groups(read_table(spark, sf_dir, "documents"), words=3, similarity=0.9)


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents by a model of nine tenths of them."""
    tune(spark)
    return class_lm.score_texts(read_table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 10) == 0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    tune(spark)
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, as the file source/language/doc_id."""
    tune(spark)
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("source", "lang", "doc_id")]
    path = F.concat_ws("/", *parts)  # a document without an id is a nameless file of its directory
    files = read_table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licenses.scan_licenses(files, keep=("doc_id",))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    tune(spark)
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    tune(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four folds of the labels."""
    tune(spark)
    scored = toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=FOLDS)
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from four folds of the labels."""
    tune(spark)
    scored = quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=FOLDS)
    return scored.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of embeddings of the same label with a cosine of 0.98 or more."""
    tune(spark)
    return near_vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


# The text of both turns of the conversation that op11 adds.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and one of control strings, read back from their formatted texts."""
    tune(spark)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    return reply_trees.conversation_digests(rows.unionByName(control))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after some rows were damaged."""
    tune(spark)
    return conversation_repair.damaged_and_repaired(read_table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by source, checked against partly altered texts."""
    tune(spark)
    return merkle.tampered_manifest(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_jaccard_join, op3_class_lm, op4_token_counts, op5_license_scan, op6_secret_scan, op7_packing,
              op8_toxicity, op9_quality, op10_near_vectors, op11_chat_format, op12_conversation_repair, op13_merkle_manifest)
}

STATEMENTS: dict[str, str] = {
    "op11_chat_format": statements.chat_format(CONTROL_TEXT),
    "op12_conversation_repair": statements.conversation_repair(),
    "op13_merkle_manifest": statements.merkle_manifest(),
}
