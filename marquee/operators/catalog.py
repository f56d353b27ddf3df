"""Loading catalogue rows: de-duplication, ids, vocabularies and the load log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.parsing import parse_list, strip
from marquee.session import shared_dir


def new_items(rows: DataFrame, existing: DataFrame, order: str = "_order") -> DataFrame:
    """Rows whose (title, year) is not in ``existing``; the first of each in file order.

    Titles compare trimmed and in lower case; missing years match each other.
    """
    first = (
        rows.withColumn("_title", F.lower(strip(F.col("title"))))
        .groupBy("_title", "release_year")
        .agg(F.min(F.struct(order, *[c for c in rows.columns if c not in (order, "release_year")])).alias("_first"))
        .select("_title", "release_year", "_first.*")
    )
    known = existing.select(
        F.lower(strip(F.col("title"))).alias("_known_title"),
        F.col("release_year").alias("_known_year"),
    )
    same = (F.col("_title") == F.col("_known_title")) & F.col("release_year").eqNullSafe(F.col("_known_year"))
    return first.join(known, same, "left_anti").select(*rows.columns)


def load_counts(rows: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: rows inserted and rows skipped as duplicates."""
    offered = rows.agg(F.count("*").alias("offered"))
    return inserted.agg(F.count("*").alias("inserted")).select(
        "inserted", (offered.scalar() - F.col("inserted")).alias("skipped")
    )


def assign_ids(df: DataFrame, id_column: str, prefix: str, start: int, order: Sequence[str]) -> DataFrame:
    """Number the rows ``prefix`` + (``start`` + 1), (``start`` + 2), ... in ``order``.

    Rows are range-partitioned and checkpointed, so that the partition sizes and
    the positions are read from one stored copy even if an executor is lost. The
    offsets hold one row per partition, which is what bounds the broadcast.
    """
    shared_dir(df.sparkSession)
    stored = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    placed = stored.withColumns({
        "_part": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)),
    })
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    number = F.lit(start + 1) + F.col("_offset") + F.col("_place")
    return placed.join(F.broadcast(offsets), "_part").select(
        F.concat(F.lit(prefix), number.cast("string")).alias(id_column), *df.columns
    )


def last_number(existing: DataFrame, id_column: str, prefix: str) -> int:
    """The highest number used with ``prefix``, 0 when there is none."""
    digits = F.regexp_extract(F.col(id_column), f"^{prefix}([0-9]+)$", 1).try_cast("bigint")
    return existing.agg(F.coalesce(F.max(digits), F.lit(0))).first()[0]


def counter_start(counter: DataFrame, existing: DataFrame, id_column: str, prefix: str) -> int:
    """Where numbering continues: the stored counter, else the highest id in use.

    A counter never goes back, so the id of a deleted row is not used again.
    """
    stored = counter.filter(F.col("prefix") == prefix).agg(F.max("next_n")).first()[0]
    return stored if stored is not None else last_number(existing, id_column, prefix)


def advance_counter(counter: DataFrame, prefix: str, last: int) -> DataFrame:
    """The counter table after ``last`` was handed out."""
    row = counter.sparkSession.createDataFrame([(prefix, last)], "prefix string, next_n bigint")
    return counter.unionByName(row).groupBy("prefix").agg(F.max("next_n").alias("next_n"))


def sync_vocab(vocabulary: DataFrame, column: str, *used: DataFrame) -> DataFrame:
    """Values to add: those found in the one-column frames ``used`` but not yet listed."""
    seen = used[0].toDF(column)
    for frame in used[1:]:
        seen = seen.union(frame.toDF(column))
    listed = vocabulary.select(column)
    return seen.filter(F.col(column).isNotNull()).distinct().join(listed, column, "left_anti")


def load_history(log: DataFrame) -> DataFrame:
    """Loads and last load time per source."""
    return log.groupBy("seed_name").agg(
        F.count("*").alias("count"), F.max("loaded_at").alias("last_loaded_at")
    )


def load_key(name: str, mode: str = "full") -> str:
    """Partial loads of a source are logged apart from full ones."""
    return name if mode == "full" else f"{name}:{mode}"


def already_loaded(log: DataFrame, key: str) -> bool:
    return not log.filter(F.col("seed_name") == key).isEmpty()


def refused(log: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (seed_name, mode) with whether the guard refuses each: the source was loaded before in that mode."""
    key = F.when(F.col("mode") == "full", F.col("seed_name")).otherwise(F.concat_ws(":", "seed_name", "mode"))
    known = log.select(F.col("seed_name").alias("_key"), F.lit(True).alias("_known")).distinct()
    found = requests.withColumn("_key", key).join(known, "_key", "left")
    return found.withColumn("refused", F.coalesce("_known", F.lit(False))).drop("_key", "_known")


class AlreadyLoaded(ValueError):
    """The source was loaded before and the load was not forced."""


def record_load(log: DataFrame, key: str, item_count: int, user_count: int, at, force: bool = False) -> DataFrame:
    """The log with one more load; refuses a repeat unless forced."""
    if not force and already_loaded(log, key):
        raise AlreadyLoaded(f"{key} was loaded before")
    row = log.sparkSession.createDataFrame([(key, item_count, user_count, at)], log.schema)
    return log.unionByName(row)


def title_pack_counts(titles: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Items, distinct genres and users a title pack would bring, without loading it."""
    genres = titles.select(F.explode(parse_list(F.col("genres"))).alias("genre"))
    return _counts(titles, "id", genres, users, None)


def movie_pack_counts(movies: DataFrame | None, users: DataFrame | None = None) -> DataFrame:
    """The same for a native pack, which may lack either file."""
    genres = None
    if movies is not None:
        both = F.array("genre_primary", "genre_secondary")
        genres = movies.select(F.explode(both).alias("genre"))
    return _counts(movies, "title", genres, users, "user_id")


def _filled(name: str):
    return F.coalesce(strip(F.col(name)), F.lit("")) != ""


def _counts(items, item_key, genres, users, user_key) -> DataFrame:
    none = F.lit(0).cast("bigint")
    spark = next(frame for frame in (items, users) if frame is not None).sparkSession
    item_count = genre_count = user_count = none
    if items is not None:
        item_count = items.agg(F.count_if(_filled(item_key))).scalar()
        names = genres.filter(_filled("genre")).select(F.lower(strip(F.col("genre"))).alias("genre"))
        genre_count = names.agg(F.count_distinct("genre")).scalar()
    if users is not None:
        user_count = users.agg(F.count_if(_filled(user_key)) if user_key else F.count("*")).scalar()
    return spark.range(1).select(
        item_count.alias("item_count"), genre_count.alias("genre_count"), user_count.alias("user_count")
    )
