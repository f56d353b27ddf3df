"""Helpers of the operators: stored tables, words, hashes, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import shared_dir

# Entries that a word cache of one task may hold.
CACHE_WORDS = 300_000
# Entries of a cache that a Python worker keeps from task to task, and characters of a word in it: at most 10 MB.
KEPT_WORDS, KEPT_CHARS = 50_000, 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder on the shared storage, deleted when the driver's JVM ends."""
    folder = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage and survives lost executors; the reread table also has a
    known size, by which Spark decides on a broadcast. Written by Zstandard,
    which gives its native memory back when a file is closed; the default codec
    keeps direct buffers until the next full collection, and many small tasks
    pile them up.
    """
    folder = f"{scratch(df.sparkSession)}/t"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished steps.

    Spark does so when the driver collects the plans that made them, which a
    small driver may not do for half an hour. What is still needed is stored.
    """
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case; none for null."""
    return text.encode().lower().split() if text else []


class Cached(dict):
    """A value per key, computed at first use and kept while there is room."""

    def __init__(self, of: Callable, most: int = CACHE_WORDS):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, key):
        value = self.of(key)
        if len(self) < self.most:
            self[key] = value
        return value


class Kept(Cached):
    """A cache that outlives its task, and is small for that."""

    def __init__(self, of: Callable):
        super().__init__(of, KEPT_WORDS)

    def __missing__(self, key):
        return super().__missing__(key) if len(key) <= KEPT_CHARS else self.of(key)


# Hashes of words.
HASHES = Kept(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles of a text.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))
    take = min(size, len(found))
    joined = np.full(len(found) - take + 1, take, np.uint64)
    for k in range(take):
        joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(found) - take + 1 + k])
    return np.unique(joined)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component) of all nodes but the smallest of each, its component.

    Alternating large-star and small-star steps: every node links itself to the
    smallest neighbour until each is linked to the smallest of its component. A
    step needs one minimum per node, combined before the shuffle, and an
    equality join that Spark can split for a hot node. The steps end when no
    node has two links downwards or one in each direction. Null ends and loops
    link nothing.
    """
    e = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    )
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every node keeps the link to its smallest neighbour: u > v holds throughout
        large = large.unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(e: DataFrame) -> bool:
    """Whether the distinct links (u, v), u > v, lead every u to one v that leads nowhere."""
    ends = e.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")),
    )).alias("end")).select("end.*")
    degrees = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return degrees.agg(F.count_if(F.col("down") + F.col("up") > 1)).first()[0] == 0


def arrays(batch, name: str) -> Iterable:
    """The Python values of one column of an Arrow batch."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def filled(batches: Iterable) -> Iterable:
    return (batch for batch in batches if batch.num_rows)


def sample_ids(labels: DataFrame, label: str, per_class: int, folds: int, id_col: str = "doc_id") -> DataFrame:
    """(id, label, share): at most ``per_class`` labelled ids of each class for learning.

    Only ids outside fold 0 of ``folds`` with one known label 0 or 1 count;
    repeated labels count once, contradicting ones not at all. Those with the
    smallest hash of the id are taken, by a top-k per class. ``share`` is the
    part of the class that was taken.
    """
    one = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (remainder(F.col(id_col), folds) != 0))
    one = one.groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other")
    sizes = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    taken = [
        one.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class)
        .select("id", F.lit(k).alias("label"), F.lit(min(1.0, per_class / sizes.get(k, per_class))).alias("share"))
        for k in (0, 1)
    ]
    return taken[0].unionByName(taken[1])
