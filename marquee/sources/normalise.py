"""Catalogue file rows to item and user rows, without ids.

Each normaliser keeps the reader's ``_order`` column, which the de-duplication
and the id assignment need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.lookups import (
    COUNTRY_CODES,
    COUNTRY_LANGUAGE,
    GENDER_LETTERS,
    GENDER_NAMES,
    LANGUAGE_CODES,
    OCCUPATIONS,
    SUBSCRIPTION_PLANS,
    look_up,
)
from marquee.functions.parsing import (
    iso_date,
    long_date,
    parse_list,
    strip,
    text_or_null,
    to_bool,
    to_decimal,
    to_int,
)
from marquee.sources.files import ORDER

# Filled in when a row is stored, not when it is read.
_STORED_LATER = {"item_id", "user_id", "created_at", "updated_at"}


def _conform(rows: DataFrame, schema, values: dict[str, Column]) -> DataFrame:
    """``values`` in the order and types of ``schema``; the rest is NULL."""
    columns = [
        values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in schema.fields
        if field.name not in _STORED_LATER
    ]
    return rows.select(*columns, ORDER)


def _blank(cell: str) -> Column:
    return F.coalesce(strip(F.col(cell)), F.lit("")) == ""


def normalise_titles(rows: DataFrame, source: str) -> DataFrame:
    """Title rows to items; rows without an id are dropped."""
    is_series = F.coalesce(F.upper(strip(F.col("type"))) == "SHOW", F.lit(False))
    genres = parse_list(F.col("genres"))
    country = F.get(parse_list(F.col("production_countries")), F.lit(0))
    return _conform(rows.filter(~_blank("id")), schemas.ITEMS, {
        "type": F.when(is_series, "series").otherwise("movie"),
        "title": F.coalesce(strip(F.col("title")), F.lit("")),
        "description": F.nullif("description", F.lit("")),
        "release_year": to_int(F.col("release_year")),
        "runtime_minutes": F.when(~is_series, to_int(F.col("runtime"))),
        "season_count": F.when(is_series, to_int(F.col("seasons"))),
        "content_rating": F.nullif("age_certification", F.lit("")),
        "country": country,
        "original_language": look_up(COUNTRY_LANGUAGE, country),
        "imdb_score": to_decimal(F.col("imdb_score"), "decimal(3,1)"),
        "is_netflix_original": F.lit(False),
        "content_warning": F.lit(False),
        "genre_primary": F.get(genres, F.lit(0)),
        "genre_secondary": F.get(genres, F.lit(1)),
        "catalog_status": F.lit("active"),
        "seed_source": F.lit(source),
    })


def title_lookup(rows: DataFrame) -> DataFrame:
    """One row per title and year, the later row winning."""
    latest = F.max(F.struct(
        ORDER,
        long_date(F.col("date_added")).alias("lookup_date"),
        text_or_null(F.col("rating")).alias("lookup_rating"),
    )).alias("latest")
    return rows.groupBy(
        F.lower(strip(F.col("title"))).alias("lookup_title"),
        F.coalesce(strip(F.col("release_year")), F.lit("")).alias("lookup_year"),
    ).agg(latest).select("lookup_title", "lookup_year", "latest.lookup_date", "latest.lookup_rating")


def enrich_titles(items: DataFrame, lookup: DataFrame) -> DataFrame:
    """Date added and rating from the lookup; the rating falls back to the own one.

    Run it on de-duplicated items: each title and year is then one row, so that
    no key of the join is hot.
    """
    year = F.when(F.col("release_year") != 0, F.col("release_year").cast("string")).otherwise("")
    matched = items.join(
        lookup,
        (F.lower("title") == F.col("lookup_title")) & (year == F.col("lookup_year")),
        "left",
    )
    return matched.withColumns({
        "date_added": F.col("lookup_date"),
        "content_rating": F.coalesce("lookup_rating", "content_rating"),
    }).select(*items.columns)


def normalise_movies(rows: DataFrame, source: str) -> DataFrame:
    """Native pack rows to items; rows without a title are dropped.

    A filled season or episode count makes a series, whatever the content type.
    """
    is_series = ~_blank("number_of_seasons") | ~_blank("number_of_episodes")
    return _conform(rows.filter(~_blank("title")), schemas.ITEMS, {
        "type": F.when(is_series, "series").otherwise("movie"),
        "title": strip(F.col("title")),
        "release_year": to_int(F.col("release_year")),
        "date_added": iso_date(F.col("added_to_platform")),
        "runtime_minutes": F.when(~is_series, to_int(F.col("duration_minutes"))),
        "season_count": F.when(is_series, to_int(F.col("number_of_seasons"))),
        "episode_count": F.when(is_series, to_int(F.col("number_of_episodes"))),
        "content_rating": text_or_null(F.col("rating")),
        "country": look_up(COUNTRY_CODES, F.lower(strip(F.col("country_of_origin")))),
        "original_language": look_up(LANGUAGE_CODES, F.lower(strip(F.col("language")))),
        "imdb_score": to_decimal(F.col("imdb_rating"), "decimal(3,1)"),
        "is_netflix_original": to_bool(F.col("is_netflix_original")),
        "content_warning": to_bool(F.col("content_warning")),
        "genre_primary": text_or_null(F.col("genre_primary")),
        "genre_secondary": text_or_null(F.col("genre_secondary")),
        "catalog_status": F.lit("active"),
        "seed_source": F.lit(source),
    })


def _choose(index: Column, values: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(value) for value in values]), index.cast("int"))


def normalise_ml_users(rows: DataFrame, source: str) -> DataFrame:
    """MovieLens-shaped users; plan and sign-up date follow from ``user_ref``."""
    ref = F.col("user_ref")
    number = F.coalesce(F.when(ref.rlike(r"^\d+$"), ref).try_cast("bigint"), F.lit(0))
    return _conform(rows, schemas.USERS, {
        "age": to_int(F.col("age")),
        "gender": F.coalesce(look_up(GENDER_LETTERS, F.col("gender")), F.lit("unknown")),
        "occupation": F.coalesce(look_up(OCCUPATIONS, F.col("occupation")), F.lit("other")),
        "country": F.lit("US"),
        "preferred_language": F.lit("en"),
        "signup_date": F.date_add(F.lit("2023-01-01").cast("date"), (number % 700).cast("int")),
        "subscription_plan": _choose(number % 3, ["basic", "standard", "premium"]),
        "account_status": F.lit("active"),
        "seed_source": F.lit(source),
    })


def normalise_users(rows: DataFrame, source: str) -> DataFrame:
    """Native pack users."""
    age = to_int(F.col("age"))
    country = look_up(COUNTRY_CODES, F.lower(strip(F.col("country"))))
    plan = F.replace(F.lower(strip(F.col("subscription_plan"))), F.lit("+"), F.lit("_plus"))
    plain = ["email", "first_name", "last_name", "state_province", "city", "primary_device"]
    return _conform(rows, schemas.USERS, {
        "age": F.when(age.between(0, 100), age),
        "gender": look_up(GENDER_NAMES, F.lower(strip(F.col("gender")))),
        "country": country,
        "preferred_language": look_up(COUNTRY_LANGUAGE, country),
        "signup_date": iso_date(F.col("subscription_start_date")),
        "subscription_plan": F.when(plan.isin(SUBSCRIPTION_PLANS), plan).otherwise("basic"),
        "account_status": F.when(to_bool(F.col("is_active")), "active").otherwise("cancelled"),
        **{name: text_or_null(F.col(name)) for name in plain},
        "monthly_spend_hours": to_decimal(F.col("monthly_spend_hours"), "decimal(6,2)"),
        "seed_source": F.lit(source),
    })
