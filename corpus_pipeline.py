"""A corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontaminate, jaccard_join, packing, quality, secrets
from marquee.llm.queries import tokenizer_path
from marquee.llm.shared import read_table, scratch, stored
from marquee.session import tune

# SQL cannot express the classifier, the entropy measure or the tokenizer.
ORACLE_SQL = None

# Name of the row key that a stage adds and drops again.
ROW = "row_key"


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of id and text, never null, and its name, which no column of ``docs`` has.

    Rows with the same key are copies of one another.
    """
    name = ROW
    while name in docs.columns:
        name += "_"
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-"))
    return docs.withColumn(name, F.concat(text, F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))), name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject."""
    rows, row = with_row_key(docs)
    # the labels go by document, the decision by row
    scored = quality.score_quality(rows, read_table(spark, sf_dir, "labels"), row_col=row)
    rejected = scored.filter("predicted = 0").select(row).distinct()
    return rows.join(rejected, row, "left_anti").select(docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, that with the smallest id, known ones first; of rows that repeat id and text, one."""
    rows, row = with_row_key(docs)
    groups = stored(jaccard_join.jaccard_groups(rows, words=5, similarity=0.8, id_col=row))
    text = F.substring_index(row, ":", -1)
    place = F.struct((text == "-").alias("unknown"), F.when(text != "-", text).cast(docs.schema["doc_id"].dataType).alias("id"), row)
    kept = stored(groups.groupBy("component_id").agg(F.min(place).alias("first"), F.count("*").alias("n")).select(F.col(f"first.{row}").alias(row), "n"))
    # copies of a kept row have its key; only those need a look at the other columns
    repeated = stored(groups.join(kept.filter("n > 1").select(row), row, "left_semi").groupBy(row).count().filter("count > 1").select(row))
    once = rows.join(kept.select(row).join(repeated, row, "left_anti"), row, "left_semi")
    return once.unionByName(rows.join(repeated, row, "left_semi").dropDuplicates([row])).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    rows, row = with_row_key(docs)
    leaks = decontaminate.find_items(rows, read_table(spark, sf_dir, "benchmark"), id_col=row).select(row).distinct()
    return rows.join(leaks, row, "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.mask_secrets(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of packed windows."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_group),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    tune(spark)
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch(spark)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
