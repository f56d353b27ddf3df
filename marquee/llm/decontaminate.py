"""Benchmark decontamination: MinHash containment search, partitioned by size.

Test items are grouped by their number of shingles. A group's sketch size is
chosen so that a document that contains the wanted share of an item's shingles
holds a known number of the item's smallest hashes: up to ``missing`` shingles
of an item may be absent, so of k sketched ones at least k - missing are present.
Documents are matched shingle by shingle with these sketches, whatever their
length, and every candidate is verified by its exact shingles. Only DataFrame
operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import stored


def text_words(text: Column) -> Column:
    """Runs of letters and digits in lower case; null for null."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def windows(words: Column, size: int) -> Column:
    """Structs of ``size`` neighbouring words; empty with fewer words."""
    n = F.greatest(F.size(words) - size + 1, F.lit(0))
    return F.when(F.size(words) >= size, F.arrays_zip(*(F.slice(words, k + 1, n).alias(f"w{k}") for k in range(size))))


def spelled(words: Column, size: int) -> Column:
    """The distinct shingles as strings."""
    return F.array_distinct(F.transform(windows(words, size), lambda x: F.concat_ws(" ", *(x[f"w{k}"] for k in range(size)))))


def item_sketches(items: DataFrame, least: int, size: int) -> DataFrame:
    """(item, hash, needed): the smallest hashes of each item and how many a match must hold.

    ``items`` has (item, n, shingles). Bands of sizes are half as wide again as the last.
    """
    band_top = F.greatest("n", F.ceil(F.pow(F.lit(1.5), F.ceil(F.log("n") / F.log(F.lit(1.5)) - 1e-9))).cast("int"))
    missing = F.floor(F.col("n") * (100 - least) / 100).cast("int")
    sketch = F.least(F.col("n"), 2 * F.floor(band_top * (100 - least) / 100).cast("int") + 2)
    hashes = F.array_sort(F.transform("shingles", lambda x: F.xxhash64(*(F.split(x, " ")[k] for k in range(size)))))
    return (items.select("item", hashes.alias("h"), sketch.alias("k"), missing.alias("missing"))
            .select("item", F.explode(F.slice("h", 1, F.col("k"))).alias("hash"), (F.col("k") - F.col("missing")).alias("needed")))


def _short_matches(docs: DataFrame, items: DataFrame, size: int, least: int, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame | None:
    """(doc, item, n_item, n_shared) for the items of fewer than ``size`` words; None if there are none.

    Such an item is one shingle of its own length, matched with the document's
    windows of that length.
    """
    held = text_words(F.col(item_text))
    short = stored(
        items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.size(held).alias("m"), F.array_join(held, " ").alias("s"))
        .filter(f"m between 1 and {size - 1}").distinct())
    lengths = sorted(r["m"] for r in short.select("m").distinct().collect())  # fewer than ``size``
    if not lengths:
        return None
    words = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), text_words(F.col(text_col)).alias("words"))
    seen = words.select("doc", F.explode(F.array_distinct(F.concat(*(F.coalesce(spelled(F.col("words"), m), F.array()) for m in lengths)))).alias("s"))
    found = seen.distinct().join(short, "s").groupBy("doc", "item").agg(F.count("*").cast("int").alias("n_shared"))
    n = short.groupBy("item").agg(F.count("*").cast("int").alias("n_item"))
    return found.join(n, "item").filter(F.col("n_shared") * 100 >= F.col("n_item") * least).select("doc", "item", "n_item", "n_shared")


def find_items(docs: DataFrame, items: DataFrame, size: int = 5, containment: float = 0.8, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (``id_col``, ``item_col``, n_item, n_shared) where a document holds the share ``containment`` of an item's shingles.

    Words are runs of letters and digits in lower case. An item with fewer than
    ``size`` words is one shingle of its own length. Null and empty texts are
    found nowhere. Rows without an id are not reported. Repeated documents or items give
    one row per pair of ids, with the largest n_shared; items that repeat an id with another text
    count with their union of shingles, short ones apart from the others. Other
    columns are ignored; an empty table on either side gives no rows.
    """
    least = round(containment * 100)
    known = stored(
        items.filter(F.col(item_col).isNotNull())
        .select(F.col(item_col).alias("item"), F.explode(spelled(text_words(F.col(item_text)), size)).alias("s"))
        .groupBy("item").agg(F.collect_set("s").alias("shingles")).withColumn("n", F.size("shingles")))
    # stored, so Spark knows the size and broadcasts the sketches only if they are small
    sketches = stored(item_sketches(known, least, size))
    words = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), text_words(F.col(text_col)).alias("words"))
    seen = words.select("doc", F.explode(windows(F.col("words"), size)).alias("x")).select("doc", F.xxhash64("x.*").alias("hash"))
    candidates = stored(
        seen.join(sketches, "hash").groupBy("doc", "item", "hash").agg(F.min("needed").alias("needed"))
        .groupBy("doc", "item").agg(F.count("*").alias("hits"), F.min("needed").alias("needed")).filter("hits >= needed").select("doc", "item"))
    chosen = stored(candidates.select("doc").distinct())
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(chosen, "doc")
    exact = texts.select("doc", spelled(text_words(F.col("text")), size).alias("held"))
    shared = F.size(F.array_intersect("shingles", "held"))
    matches = (exact.join(candidates, "doc").join(known, "item").select("doc", "item", F.col("n").alias("n_item"), shared.alias("n_shared"))
               .filter(F.col("n_shared") * 100 >= F.col("n_item") * least))
    short = _short_matches(docs, items, size, least, id_col, text_col, item_col, item_text)
    if short is not None:
        matches = matches.unionByName(short)
    return (matches.groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_col)).agg(F.max("n_item").alias("n_item"), F.max("n_shared").alias("n_shared")))
