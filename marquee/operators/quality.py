"""Row rules for events and catalogue rows, and the active pools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.lookups import (
    ACCOUNT_STATUSES,
    CATALOG_STATUSES,
    ITEM_TYPES,
    SUBSCRIPTION_PLANS,
)
from marquee.functions.parsing import strip, text_or_null, to_float, to_whole

Rule = tuple[str, Column]


def _unless(ok: Column) -> Column:
    """True when ``ok`` is false or unknown."""
    return ~F.coalesce(ok, F.lit(False))


def watch_rules(as_of: Column) -> list[Rule]:
    return [
        ("watched_seconds must be > 0", _unless(F.col("watched_seconds") > 0)),
        ("device_type is required", _unless(F.col("device_type") != "")),
        ("session_ended_at is in the future", _unless(F.col("session_ended_at") <= as_of)),
    ]


def rating_rules(as_of: Column) -> list[Rule]:
    return [
        ("rating out of range", _unless(F.col("rating").between(1, 5))),
        ("rated_at is in the future", _unless(F.col("rated_at") <= as_of)),
    ]


def first_error(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``error``: the first broken rule, NULL for a good row."""
    return df.withColumn("error", F.coalesce(*[F.when(broken, message) for message, broken in rules]))


def all_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``errors``: every broken rule in order, empty for a good row."""
    messages = F.array(*[F.when(broken, message) for message, broken in rules])
    return df.withColumn("errors", F.filter(messages, lambda message: message.isNotNull()))


def split_events(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``; bad rows keep their ``error``."""
    checked = first_error(df, rules)
    good = checked.filter(F.col("error").isNull()).drop("error")
    return good, checked.filter(F.col("error").isNotNull())


def _mark_listed(df: DataFrame, cell: str, value: Column, vocabulary: DataFrame) -> DataFrame:
    """Adds ``_bad_<cell>``: the cell is filled but not in the vocabulary."""
    listed = vocabulary.toDF("_listed").distinct()
    marked = df.withColumn("_value", value).join(listed, F.col("_value") == F.col("_listed"), "left")
    bad = F.col("_value").isNotNull() & F.col("_listed").isNull()
    return marked.withColumn(f"_bad_{cell}", bad).drop("_value", "_listed")


def _must_be_whole(cell: str) -> Rule:
    filled = text_or_null(F.col(cell)).isNotNull()
    return f"{cell} must be a whole number", filled & to_whole(F.col(cell)).isNull()


def _must_be_number(cell: str) -> Rule:
    filled = text_or_null(F.col(cell)).isNotNull()
    return f"{cell} must be a number", filled & to_float(F.col(cell)).isNull()


def _one_of(cell: str, allowed: Sequence[str], absent: str = "") -> Column:
    """True when the cell is none of ``allowed``; a NULL cell counts as ``absent``, a blank one as blank."""
    return _unless(strip(F.coalesce(F.col(cell), F.lit(absent))).isin(list(allowed)))


def validate_items(df: DataFrame, genres: DataFrame, countries: DataFrame, languages: DataFrame) -> DataFrame:
    """Every broken rule of each item row given as text cells."""
    columns = df.columns
    checks = [
        ("country", F.upper(text_or_null(F.col("country"))), countries),
        ("original_language", F.lower(text_or_null(F.col("original_language"))), languages),
        ("genre_primary", text_or_null(F.col("genre_primary")), genres),
        ("genre_secondary", text_or_null(F.col("genre_secondary")), genres),
    ]
    for cell, value, vocabulary in checks:
        df = _mark_listed(df, cell, value, vocabulary)
    whole = ["release_year", "runtime_minutes", "season_count", "episode_count"]
    rules = [
        ("type must be movie or series", _one_of("type", ITEM_TYPES)),
        ("title is required", text_or_null(F.col("title")).isNull()),
        *[_must_be_whole(cell) for cell in whole],
        ("country is not listed", F.col("_bad_country")),
        ("original_language is not listed", F.col("_bad_original_language")),
        _must_be_number("imdb_score"),
        ("genre_primary is not listed", F.col("_bad_genre_primary")),
        ("genre_secondary is not listed", F.col("_bad_genre_secondary")),
        ("catalog_status is invalid", _one_of("catalog_status", CATALOG_STATUSES, "active")),
    ]
    return all_errors(df, rules).select(*columns, "errors")


def validate_users(df: DataFrame, countries: DataFrame, languages: DataFrame) -> DataFrame:
    """Every broken rule of each user row given as text cells."""
    columns = df.columns
    df = _mark_listed(df, "country", F.upper(text_or_null(F.col("country"))), countries)
    df = _mark_listed(df, "preferred_language", F.lower(text_or_null(F.col("preferred_language"))), languages)
    rules = [
        _must_be_whole("age"),
        ("country is not listed", F.col("_bad_country")),
        ("preferred_language is not listed", F.col("_bad_preferred_language")),
        ("subscription_plan is invalid", _one_of("subscription_plan", SUBSCRIPTION_PLANS, "basic")),
        _must_be_number("monthly_spend_hours"),
        ("account_status is invalid", _one_of("account_status", ACCOUNT_STATUSES, "active")),
    ]
    return all_errors(df, rules).select(*columns, "errors")


def table_rules(key: str) -> list[Rule]:
    """The constraints of the stored item or user table, told apart by key."""
    if key == "item_id":
        return [
            ("item_id is malformed", _unless(F.col("item_id").rlike("^i[0-9]+$"))),
            ("type is invalid", _unless(F.col("type").isin(ITEM_TYPES))),
            ("catalog_status is invalid", _unless(F.col("catalog_status").isin(CATALOG_STATUSES))),
        ]
    return [
        ("user_id is malformed", _unless(F.col("user_id").rlike("^u[0-9]+$"))),
        ("subscription_plan is invalid", _unless(F.col("subscription_plan").isin(SUBSCRIPTION_PLANS))),
        ("account_status is invalid", _unless(F.col("account_status").isin(ACCOUNT_STATUSES))),
    ]


def active_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("catalog_status") == "active").select("item_id", "type", "runtime_minutes")


def active_users(users: DataFrame) -> DataFrame:
    return users.filter(F.col("account_status") == "active").select("user_id")
