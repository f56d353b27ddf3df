"""Catalogue administration and activity queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.lookups import (
    ACCOUNT_STATUSES,
    CATALOG_STATUSES,
    GENDERS,
    ITEM_TYPES,
    SUBSCRIPTION_PLANS,
)
from marquee.operators.blocks import numeric_id

ITEM_SORTS = [
    "item_id", "title", "type", "release_year", "country", "content_rating",
    "imdb_score", "catalog_status", "genre_primary",
]
USER_SORTS = [
    "user_id", "age", "gender", "occupation", "country", "subscription_plan", "account_status",
]


def _tally(df: DataFrame, section: str, label: Column) -> DataFrame:
    """``(section, label, n)`` rows, one per label."""
    counted = df.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    return counted.select(F.lit(section).alias("section"), "label", "n")


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def _summary(df: DataFrame, name: str, active: Column, by: str, label: Column) -> DataFrame:
    """``(section, label, n)``: all rows, the active ones, and those of each label, by one scan.

    The labels are a vocabulary (types, genders), so their counts fit in one row.
    """
    counted = df.groupBy(label.alias("label")).agg(F.count("*").alias("n"), F.count_if(active).alias("active"))
    whole = counted.agg(
        F.collect_list(F.struct("label", "n")).alias("labels"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", "active")])

    def row(section: str, label: Column, n: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), label.cast("string").alias("label"), n.alias("n"))

    rows = F.concat(
        F.array(row(name, F.lit(None), F.col("n")), row(f"active {name}", F.lit(None), F.col("active"))),
        F.transform("labels", lambda x: row(f"{name} by {by}", x["label"], x["n"])))
    return whole.select(F.explode(rows).alias("r")).select("r.*")


def catalog_summary(items: DataFrame, users: DataFrame) -> DataFrame:
    """Totals, active totals, items by type and users by gender."""
    gender = F.coalesce(F.nullif("gender", F.lit("")), F.lit("unspecified"))
    return stack([
        _summary(items, "items", F.col("catalog_status") == "active", "type", F.col("type")),
        _summary(users, "users", F.col("account_status") == "active", "gender", gender),
    ])


def _contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive; ``%`` and ``_`` in ``text`` act as wildcards."""
    return df.filter(F.col(column).ilike(f"%{text}%")) if text else df


def _equals(df: DataFrame, column: str, value: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside ``allowed`` are ignored."""
    return df.filter(F.col(column) == value) if value in allowed else df


def _sorted(df: DataFrame, key: str, sort: str, direction: str, sorts: Sequence[str], default: str) -> DataFrame:
    """Sort by a listed column. Ids sort by number, NULLs count as largest."""
    column = sort if sort in sorts else default
    value = numeric_id(key) if column == key else F.col(column)
    if direction == "desc":
        return df.orderBy(value.desc_nulls_first(), numeric_id(key))
    return df.orderBy(value.asc_nulls_last(), numeric_id(key))


def item_search(
    items: DataFrame,
    id_text: str = "",
    item_type: str = "",
    status: str = "",
    genre: str = "",
    sort: str = "title",
    direction: str = "asc",
) -> DataFrame:
    found = _contains(items, "item_id", id_text.strip())
    found = _equals(found, "type", item_type, ITEM_TYPES)
    found = _equals(found, "catalog_status", status, CATALOG_STATUSES)
    if genre:
        found = found.filter((F.col("genre_primary") == genre) | (F.col("genre_secondary") == genre))
    return _sorted(found, "item_id", sort, direction, ITEM_SORTS, "title")


def user_search(
    users: DataFrame,
    id_text: str = "",
    gender: str = "",
    plan: str = "",
    status: str = "",
    sort: str = "user_id",
    direction: str = "asc",
) -> DataFrame:
    found = _contains(users, "user_id", id_text.strip())
    found = _equals(found, "gender", gender, GENDERS)
    found = _equals(found, "subscription_plan", plan, SUBSCRIPTION_PLANS)
    found = _equals(found, "account_status", status, ACCOUNT_STATUSES)
    return _sorted(found, "user_id", sort, direction, USER_SORTS, "user_id")


def _genres_of(items: DataFrame) -> DataFrame:
    """One row per item and distinct genre; an item counts once per genre."""
    both = F.array_distinct(F.array_compact(F.array("genre_primary", "genre_secondary")))
    return items.select(F.explode(both).alias("genre"))


def items_per_genre(items: DataFrame) -> DataFrame:
    return _genres_of(items).groupBy("genre").agg(F.count("*").alias("n"))


def option_counts(items: DataFrame, users: DataFrame) -> DataFrame:
    """Rows per filter choice, over the whole tables."""
    return stack([
        *[_tally(items, name, F.col(name)) for name in ("type", "catalog_status")],
        *[_tally(users, name, F.col(name)) for name in ("gender", "subscription_plan", "account_status")],
    ])


def genre_usage(genres: DataFrame, items: DataFrame) -> DataFrame:
    """Items per listed genre, zero included.

    Each item is opened into its genres and counted first, which turns the
    either-column match into an equality join of two small tables.
    """
    usage = items_per_genre(items).withColumnRenamed("genre", "name")
    used = genres.select("name").join(usage, "name", "left")
    return used.select("name", F.coalesce("n", F.lit(0)).alias("item_count"))


def code_usage(codes: DataFrame, *used: DataFrame) -> DataFrame:
    """Rows of the one-column frames ``used`` per listed code, zero included."""
    counted = stack([frame.toDF("code") for frame in used]).groupBy("code").agg(F.count("*").alias("n"))
    return codes.select("code").join(counted, "code", "left").select(
        "code", F.coalesce("n", F.lit(0)).alias("usage_count")
    )


def rows_per_source(df: DataFrame) -> DataFrame:
    loaded = df.filter(F.col("seed_source").isNotNull())
    return loaded.groupBy("seed_source").agg(F.count("*").alias("n"))


def device_breakdown(watches: DataFrame) -> DataFrame:
    counted = watches.groupBy("device_type").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "device_type")


def recent_watches(watches: DataFrame, k: int = 50) -> DataFrame:
    newest = [F.desc("session_ended_at"), "user_id", "item_id", "watched_seconds", "device_type"]
    return watches.orderBy(*newest).limit(k)


def activity_counts(open_now: DataFrame, watches: DataFrame) -> DataFrame:
    finished = watches.agg(F.count("*")).scalar()
    return open_now.agg(F.count("*").alias("active_sessions")).withColumn("finished_items", finished)
