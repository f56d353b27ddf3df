"""Dashboard panels over the item, user and report tables.

An empty parameter means all. Rankings that the dashboard leaves open on equal
values are settled by name or id here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.blocks import alive, numeric_id
from marquee.plans import reports

DETAIL_ROWS = 200
TOP_ROWS = 10


def _only(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value) if value else df


def _rounded_mean(column: Column, digits: int) -> Column:
    """Half-up rounding of a mean, on decimals."""
    return F.round(F.avg(column).cast("decimal(30,15)"), digits).cast(f"decimal(18,{digits})")


# Totals and means

def total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def overall_rating(user_rating_avg: DataFrame, users: DataFrame) -> DataFrame:
    """Mean of the per-user means."""
    rated = alive(user_rating_avg, users, "user_id")
    return rated.agg(_rounded_mean(F.col("avg_rating"), 2).alias("overall_avg_rating"))


def users_with_rating(user_rating_avg: DataFrame, users: DataFrame) -> DataFrame:
    return total(alive(user_rating_avg, users, "user_id"), "users_with_rating")


def item_count(items: DataFrame, item_type: str = "") -> DataFrame:
    return total(_only(items, "type", item_type), "item_count")


def user_count(users: DataFrame, plan: str = "") -> DataFrame:
    return total(_only(users, "subscription_plan", plan), "user_count")


def mean_completion(item_completion_rate: DataFrame, items: DataFrame, item_type: str = "") -> DataFrame:
    """Mean completion in percent; items without a rate are left out."""
    rates = alive(item_completion_rate, _only(items, "type", item_type), "item_id")
    return rates.agg(_rounded_mean(F.col("completion_rate") * 100, 1).alias("avg_completion_pct"))


def mean_item_rating(item_rating_avg: DataFrame, items: DataFrame, item_type: str = "") -> DataFrame:
    rated = alive(item_rating_avg, _only(items, "type", item_type), "item_id")
    return rated.agg(_rounded_mean(F.col("avg_rating"), 2).alias("avg_rating"))


def mean_user_rating(user_rating_avg: DataFrame, users: DataFrame, plan: str = "") -> DataFrame:
    rated = alive(user_rating_avg, _only(users, "subscription_plan", plan), "user_id")
    return rated.agg(_rounded_mean(F.col("avg_rating"), 2).alias("avg_rating"))


# Breakdowns

def _breakdown(df: DataFrame, column: str, name: str) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias(name))
    return counted.orderBy(F.desc(name), F.asc_nulls_last(column))


def items_by_type(items: DataFrame) -> DataFrame:
    return _breakdown(items, "type", "item_count")


def users_by_plan(users: DataFrame) -> DataFrame:
    return _breakdown(users, "subscription_plan", "user_count")


def users_by_country(users: DataFrame, plan: str = "", k: int = TOP_ROWS) -> DataFrame:
    located = _only(users, "subscription_plan", plan).filter(F.col("country").isNotNull())
    return _breakdown(located, "country", "user_count").limit(k)


def users_by_mood(user_mood: DataFrame, users: DataFrame, plan: str = "") -> DataFrame:
    moods = alive(user_mood, _only(users, "subscription_plan", plan), "user_id")
    return _breakdown(moods, "mood", "user_count")


def users_by_top_genre(user_top_genre: DataFrame, users: DataFrame, plan: str = "", k: int = TOP_ROWS) -> DataFrame:
    tops = alive(user_top_genre, _only(users, "subscription_plan", plan), "user_id")
    return _breakdown(tops, "top_genre", "user_count").limit(k)


# Lists

def _attach(page: DataFrame, key: str, *tables: tuple[DataFrame, list[str]]) -> DataFrame:
    """Left-join report columns to a page of rows.

    The page is cut to its row limit before this, so its keys are a bounded
    broadcast that reduces each published report before the join. Reports that
    are built from facts for one panel get the facts of the page, by ``_of_page``.
    """
    keys = F.broadcast(page.select(key))
    for report, columns in tables:
        wanted = report.select(key, *columns).join(keys, key, "left_semi")
        page = page.join(wanted, key, "left")
    return page.orderBy(numeric_id(key))


def _page(df: DataFrame, key: str, value: str, column: str, wanted: str, k: int) -> DataFrame:
    """The first ``k`` rows by id."""
    return _only(_only(df, key, value), column, wanted).orderBy(numeric_id(key)).limit(k)


def _of_page(facts: DataFrame, page: DataFrame, key: str, value: str) -> DataFrame:
    """The facts of a page's keys; a single key becomes a filter that reaches the scan."""
    return _only(facts, key, value) if value else facts.join(F.broadcast(page.select(key)), key, "left_semi")


ITEM_DETAIL = [
    "item_id", "type", "title", "release_year", "genre_primary", "genre_secondary",
    "content_rating", "imdb_score", "is_netflix_original", "catalog_status",
]


def item_detail(
    items: DataFrame,
    item_rating_avg: DataFrame,
    item_completion_rate: DataFrame,
    item_viewer_demographics: DataFrame,
    item_id: str = "",
    item_type: str = "",
    k: int = DETAIL_ROWS,
) -> DataFrame:
    page = _page(items, "item_id", item_id, "type", item_type, k).select(*ITEM_DETAIL)
    shares = ["pct_male", "pct_female", "pct_other", "pct_unknown"]
    return _attach(
        page, "item_id",
        (item_rating_avg, ["avg_rating", "rating_count"]),
        (item_completion_rate, ["completion_rate", "watch_count"]),
        (item_viewer_demographics, ["average_age", *shares, "viewer_count"]),
    )


def item_detail_from_facts(
    items: DataFrame,
    users: DataFrame,
    ratings: DataFrame,
    watches: DataFrame,
    item_id: str = "",
    item_type: str = "",
    k: int = DETAIL_ROWS,
) -> DataFrame:
    """``item_detail`` with its reports built from the facts of the page alone."""
    page = _page(items, "item_id", item_id, "type", item_type, k)
    rated, watched = (_of_page(facts, page, "item_id", item_id) for facts in (ratings, watches))
    return item_detail(
        page,
        reports.rating_avg(rated, None, users, "item_id"),
        reports.completion_rate(watched, F.broadcast(page), users),
        reports.viewer_demographics(watched, None, users),
        item_id, item_type, k,
    )


USER_DETAIL = [
    "user_id", "age", "gender", "country", "subscription_plan", "account_status",
    "signup_date", "primary_device",
]


def user_detail(
    users: DataFrame,
    user_rating_avg: DataFrame,
    user_mood: DataFrame,
    user_series_movie_ratio: DataFrame,
    user_top_genre: DataFrame,
    user_top_device_language: DataFrame,
    user_id: str = "",
    plan: str = "",
    k: int = DETAIL_ROWS,
) -> DataFrame:
    page = _page(users, "user_id", user_id, "subscription_plan", plan, k).select(*USER_DETAIL)
    return _attach(
        page, "user_id",
        (user_rating_avg, ["avg_rating", "rating_count"]),
        (user_mood, ["mood", "avg_recent_rating"]),
        (user_series_movie_ratio, [
            "movie_watch_count", "series_watch_count", "movie_percentage", "series_percentage",
        ]),
        (user_top_genre, ["top_genre", "genre_watch_count", "watches_used"]),
        (user_top_device_language, [
            "top_device", "device_watch_count", "top_language", "language_watch_count",
        ]),
    )


def user_detail_from_facts(
    users: DataFrame,
    items: DataFrame,
    ratings: DataFrame,
    watches: DataFrame,
    user_id: str = "",
    plan: str = "",
    k: int = DETAIL_ROWS,
) -> DataFrame:
    """``user_detail`` with its reports built from the facts of the page alone."""
    page = _page(users, "user_id", user_id, "subscription_plan", plan, k)
    rated, watched = (_of_page(facts, page, "user_id", user_id) for facts in (ratings, watches))
    return user_detail(
        page,
        reports.rating_avg(rated, items, None, "user_id"),
        reports.user_mood(rated, items, None),
        reports.type_ratio(watched, items, None),
        reports.top_genre(watched, items, None),
        reports.top_device_language(watched, items, None),
        user_id, plan, k,
    )


def rating_per_user(
    user_rating_avg: DataFrame, users: DataFrame, user_id: str = "", plan: str = "", k: int = DETAIL_ROWS
) -> DataFrame:
    chosen = alive(_only(user_rating_avg, "user_id", user_id), _only(users, "subscription_plan", plan), "user_id")
    best = chosen.orderBy(F.desc("avg_rating"), numeric_id("user_id"))
    return best.select("user_id", "avg_rating", "rating_count").limit(k)


def trending(ranking: DataFrame, items: DataFrame, item_type: str) -> DataFrame:
    """One type's ranking with titles. The ranking holds only its top rows."""
    measures = [name for name in ranking.columns if name not in ("type", "rank", "item_id")]
    titled = _only(ranking, "type", item_type).join(items.select("item_id", "title"), "item_id")
    return titled.select("rank", "item_id", "title", *measures).orderBy("rank")


def options(df: DataFrame, column: str, unique: bool = False) -> DataFrame:
    """Filter choices: 'All', then every distinct value.

    ``unique`` says the column has no repeats, which saves the distinct.
    """
    everything = df.sparkSession.range(1).select(F.lit("All").alias("text"), F.lit("").alias("value"))
    values = df.select(F.col(column).alias("text"), F.col(column).alias("value"))
    return everything.unionByName(values if unique else values.distinct()).orderBy("text")
