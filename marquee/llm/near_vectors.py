"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by random signs and fast Hadamard transforms; the largest
coordinate with its sign is a hash, and several of them form a bucket of a
table. Each vector also enters the buckets of its next best coordinates
(multiprobe). Vectors that share a bucket are compared by exact cosine, in blocks
of a bounded number of rows whatever the size of the bucket; a pair is counted
in the first bucket that it shares only. Equal vectors are compared as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import arrays, components, filled, mixed, stored

TABLES, ROTATIONS, BLOCK = 8, 3, 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        y = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x


def buckets(x: np.ndarray, tables: int = TABLES, rotations: int = ROTATIONS, seed: int = 7) -> np.ndarray:
    """(rows, tables * (rotations + 1)) bucket numbers: the best of each rotation, then one of them second best."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    rng = np.random.default_rng(seed)
    found = []
    rows = np.arange(len(x))
    for table in range(tables):
        best, second = [], []
        for _ in range(rotations):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            large = np.abs(y)
            for held in (best, second):
                at = large.argmax(axis=1)
                held.append((at * 2 + (y[rows, at] < 0)).astype(np.uint64))
                large[rows, at] = -1
        for probe in range(rotations + 1):
            code = np.full(len(x), table + 1, np.uint64)
            for k in range(rotations):
                code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + (second if probe == k + 1 else best)[k] + np.uint64(1))
            found.append(code)
    return np.stack(found, axis=1)


def _first_shared(keys: np.ndarray, a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    """Whether ``key`` is the smallest bucket number that rows a and b share, for many pairs."""
    if len(a) < 64:
        return np.array([np.intersect1d(keys[i], keys[j])[0] == key for i, j in zip(a, b)], bool)
    row = np.repeat(np.arange(len(keys)), keys.shape[1])
    number, at, times = np.unique(keys.ravel(), return_inverse=True, return_counts=True)
    place = np.cumsum((number < key) & (times > 1)) - 1
    held = ((number < key) & (times > 1))[at]
    holds = np.zeros((len(keys), place[-1] + 1), np.float32)
    holds[row[held], place[at[held]]] = 1
    return ~((holds @ holds.T) > 0)[a, b]


def _block(ids: np.ndarray, times: np.ndarray, vectors: np.ndarray, keys: np.ndarray, side: np.ndarray | None, key: int, least: float):
    """Rows linked in one block, the other vectors that each links, and the smallest row that it reaches there.

    With rows of two blocks of a bucket (``side``) only pairs across them count.
    """
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])  # exact, against overflow
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    linked = np.triu((vectors @ vectors.T) / (norm[:, None] * norm[None, :]) >= least, 1)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    a, b = np.nonzero(linked)
    if len(a):
        first = _first_shared(keys, a, b, key)
        a, b = a[first], b[first]
    if not len(a):
        return None
    n = np.bincount(a, times[b], len(ids)) + np.bincount(b, times[a], len(ids))
    label = np.arange(len(ids))
    while True:
        lower = label.copy()
        np.minimum.at(lower, a, label[b])
        np.minimum.at(lower, b, label[a])
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    touched = np.flatnonzero(n)
    return ids[touched], n[touched].astype(np.int64), ids[label[touched]]


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``id_col``, n_links, component_id and kept per row.

    Rows link when their labels are equal and not null and their cosine, in
    double precision, is at least ``least``. A vector that is null, empty, zero
    or holds a null or non-finite number links with nothing: no links, its own
    component, kept. Vectors of other lengths are not compared. Repeated rows link like other equal vectors; a row
    without an id neither links nor names a component and gets null. Other
    columns are ignored, an empty table gives no rows.
    """
    key = vectors.schema[id_col].dataType.simpleString()
    spark = vectors.sparkSession

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            found = []
            for x in arrays(batch, "x"):
                x = np.array(x if x and None not in x else [], np.float64) + 0.0
                usable = len(x) and np.isfinite(x).all() and x.any()
                found.append(xxhash.xxh3_128_digest(x.tobytes()) if usable else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary()), batch.column(2)], names=["id", "label", "digest", "x"])

    kind = vectors.schema[label_col].dataType.simpleString()
    x_type = vectors.schema[vector_col].dataType.simpleString()
    rows = stored(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x"))
                  .mapInArrow(digest, f"id {key}, label {kind}, digest binary, x {x_type}"))
    usable = rows.filter("id is not null and label is not null and digest is not null")
    # equal vectors become one, with the number of their rows
    one = stored(usable.groupBy("label", "digest").agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.min_by("x", "id").alias("x")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            label = np.array([xxhash.xxh3_64_intdigest(repr(x).encode()) for x in arrays(batch, "label")], np.uint64)
            lengths = np.array([len(x) for x in arrays(batch, "x")])
            codes = np.zeros((batch.num_rows, TABLES * (ROTATIONS + 1)), np.uint64)
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                x = np.array([batch.column(2)[int(i)].as_py() for i in at], np.float64)
                codes[at] = mixed(buckets(x / np.abs(x).max(axis=1, keepdims=True)) ^ label[at, None] ^ np.uint64(size))
            codes = np.sort(codes.view(np.int64), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(codes), pa.list_(pa.int64()))], names=["rep", "keys"])

    keyed = stored(one.select("rep", "label", "x").mapInArrow(hashed, f"rep {key}, keys array<bigint>"))
    entries = keyed.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    # buckets with two or more, split into blocks of about BLOCK rows by a hash of the id
    shared = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    split = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = entries.join(shared, "key").withColumn("blocks", split).withColumn("own", own)
    members = (placed.select("rep", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
               .select("rep", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"))
    full = members.join(one.select("rep", "times", "x").join(keyed, "rep"), "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None
        out: list[tuple] = []

        def finish():
            if len(held) > 1:
                c = list(zip(*held))
                found = _block(np.array(c[0]), np.array(c[1], np.float64), np.array(c[2], np.float64), np.array(c[3]),
                               np.array(c[4]) if group[1] != group[2] else None, group[0], least)
                if found:
                    out.append(found)

        for batch in filled(batches):
            for rep, k, i, j, own, times, x, keys in zip(*(arrays(batch, n) for n in ("rep", "key", "i", "j", "own", "times", "x", "keys"))):
                if (k, i, j) != group:
                    finish()
                    held, group = [], (k, i, j)
                held.append((rep, times, x, keys, own == j))
            if out:
                yield linked(out)
                out = []
        finish()
        if out:
            yield linked(out)

    def linked(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "n", "least"])

    links = stored(full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
                   .mapInArrow(compare, f"rep {key}, n bigint, least {key}"))
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(links.select(F.col("rep").alias("a"), F.col("least").alias("b"))).select(F.col("node").alias("rep"), "component")
    known = stored(one.select("label", "digest", "rep", "times").join(counts, "rep", "left").join(groups, "rep", "left").select(
        "label", "digest", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    linked_rows = usable.select("id", "label", "digest").join(known, ["label", "digest"]).select("id", "n_links", "component_id")
    other = rows.filter("id is null or label is null or digest is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked_rows.unionByName(other).select(
        F.col("id").alias(id_col), F.col("n_links").cast("bigint").alias("n_links"), F.col("component_id").cast("bigint").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
