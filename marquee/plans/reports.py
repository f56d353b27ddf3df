"""The eleven report tables.

Each report counts only facts whose item and user still exist. The filter on
the *other* dimension runs on the facts; the filter on the report's own key
runs after the aggregation, on one row per key, so a hot key never meets that
join. All group aggregates combine on the map side. Where a dimension serves
only as a filter, None says that the facts are known to be live; where a report
looks up columns of items, that they carry these already.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.blocks import alive, last_n, mode_of, since, top_k_per_group

# Fixed values.
RECENT_RATINGS = 3
GOOD_ABOVE = 4.5
BAD_BELOW = 3.5
TRENDING_MINUTES = 10
TRENDING_TOP = 10
COMPLETION_SHARE = Decimal("0.85")
EPISODE_SECONDS = 2400
RECENT_WATCHES = 8
NAMED_GENDERS = ["male", "female", "other"]
# Sketches of distinct counts: 2 ** SKETCH_BITS registers, and the relative standard error that this gives.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole


def rating_avg(
    ratings: DataFrame, items: DataFrame | None, users: DataFrame | None, key: str
) -> DataFrame:
    """All-time mean and number of ratings, per ``user_id`` or per ``item_id``."""
    own, other, other_key = (
        (users, items, "item_id") if key == "user_id" else (items, users, "user_id")
    )
    averages = alive(ratings, other, other_key).groupBy(key).agg(
        F.avg("rating").alias("avg_rating"),
        F.count("*").alias("rating_count"),
    )
    return alive(averages, own, key)


def user_mood(
    ratings: DataFrame,
    items: DataFrame | None,
    users: DataFrame | None,
    n: int = RECENT_RATINGS,
    good: float = GOOD_ABOVE,
    bad: float = BAD_BELOW,
) -> DataFrame:
    """Mood from the mean of a user's last ``n`` ratings."""
    recent = last_n(
        alive(ratings, items, "item_id").select("user_id", "item_id", "rating", "rated_at"),
        "user_id",
        [F.desc("rated_at"), F.asc("item_id")],
        n,
    )
    mean = F.col("avg_recent_rating")
    moods = recent.groupBy("user_id").agg(
        F.avg("rating").alias("avg_recent_rating"),
        F.count("*").cast("int").alias("ratings_used"),
    ).select(
        "user_id",
        F.when(mean > good, "good").when(mean >= bad, "average").otherwise("bad").alias("mood"),
        "avg_recent_rating",
        "ratings_used",
    )
    return alive(moods, users, "user_id")


def _start(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_dt_interval(mins=F.lit(minutes))


def view_ranking(
    watches: DataFrame,
    items: DataFrame,
    users: DataFrame | None,
    as_of: Column,
    minutes: int = TRENDING_MINUTES,
    top_n: int = TRENDING_TOP,
) -> DataFrame:
    """Most watched items per type since ``as_of`` minus ``minutes``."""
    recent = since(watches, "session_ended_at", _start(as_of, minutes))
    views = alive(recent, users, "user_id").groupBy("item_id").agg(F.count("*").alias("view_count"))
    typed = views.join(items.select("item_id", "type"), "item_id")
    ranked = top_k_per_group(typed, "type", [F.desc("view_count"), F.asc("item_id")], top_n)
    return ranked.select("type", "rank", "item_id", "view_count")


def rating_ranking(
    ratings: DataFrame,
    watches: DataFrame,
    items: DataFrame,
    users: DataFrame | None,
    as_of: Column,
    minutes: int = TRENDING_MINUTES,
    top_n: int = TRENDING_TOP,
) -> DataFrame:
    """Best rated items per type, from ratings given inside the window.

    Equal means fall to the rating count, then to views inside the window.
    """
    rated = alive(since(ratings, "rated_at", _start(as_of, minutes)), users, "user_id")
    scores = rated.groupBy("item_id").agg(
        F.avg("rating").alias("avg_rating"), F.count("*").alias("rating_count")
    )
    watched = alive(since(watches, "session_ended_at", _start(as_of, minutes)), users, "user_id")
    views = watched.groupBy("item_id").agg(F.count("*").alias("view_count"))
    combined = (
        scores.join(items.select("item_id", "type"), "item_id")
        .join(views, "item_id", "left")
        .withColumn("view_count", F.coalesce("view_count", F.lit(0)))
    )
    best = [F.desc("avg_rating"), F.desc("rating_count"), F.desc("view_count"), F.asc("item_id")]
    ranked = top_k_per_group(combined, "type", best, top_n)
    return ranked.select("type", "rank", "item_id", "avg_rating", "rating_count")


def _of_items(watches: DataFrame, items: DataFrame | None, *columns: str) -> DataFrame:
    """Watches with some columns of their item."""
    return watches if items is None else watches.join(items.select("item_id", *columns), "item_id")


def completion_rate(
    watches: DataFrame,
    items: DataFrame | None,
    users: DataFrame | None,
    share: Decimal = COMPLETION_SHARE,
    episode_seconds: int = EPISODE_SECONDS,
) -> DataFrame:
    """Share of an item's watches that reached ``share`` of its length.

    Watches are first counted per (item, seconds watched): the number of
    distinct lengths is bounded, so the join to items sees few rows per item
    however popular it is. A movie without a runtime has no rate.
    """
    watched = alive(watches, users, "user_id")
    if items is None:
        lengths = watched.withColumn("n", F.lit(1))
    else:
        lengths = watched.groupBy("item_id", "watched_seconds").agg(F.count("*").alias("n"))
    duration = F.when(F.col("type") == "movie", F.col("runtime_minutes") * 60).otherwise(episode_seconds)
    completed = F.col("watched_seconds") >= F.lit(share) * duration
    done = F.sum(F.when(completed, F.col("n")).when(~completed, 0))
    judged = F.sum(F.when(completed.isNotNull(), F.col("n")))
    return (
        _of_items(lengths, items, "type", "runtime_minutes")
        .groupBy("item_id", "type")
        .agg(_share(done, judged).alias("completion_rate"), F.sum("n").alias("watch_count"))
    )


def viewer_demographics(watches: DataFrame, items: DataFrame | None, users: DataFrame) -> DataFrame:
    """Age and gender of an item's distinct viewers."""
    viewers = (
        watches.select("item_id", "user_id").distinct()
        .join(users.select("user_id", "age", "gender"), "user_id")
    )
    bucket = F.when(F.col("gender").isin(NAMED_GENDERS), F.col("gender")).otherwise("unknown")
    viewer_count = F.count("*")
    profile = viewers.withColumn("bucket", bucket).groupBy("item_id").agg(
        F.avg("age").alias("average_age"),
        *[
            _share(F.count_if(F.col("bucket") == name), viewer_count).alias(f"pct_{name}")
            for name in [*NAMED_GENDERS, "unknown"]
        ],
        viewer_count.alias("viewer_count"),
    )
    return alive(profile, items, "item_id")


def type_ratio(watches: DataFrame, items: DataFrame | None, users: DataFrame | None) -> DataFrame:
    """How a user's watches, rewatches included, split over movies and series."""
    movies, series = (F.count_if(F.col("type") == kind) for kind in ("movie", "series"))
    ratios = (
        _of_items(watches, items, "type")
        .groupBy("user_id")
        .agg(
            movies.alias("movie_watch_count"),
            series.alias("series_watch_count"),
            _share(movies, F.count("*")).alias("movie_percentage"),
            _share(series, F.count("*")).alias("series_percentage"),
        )
    )
    return alive(ratios, users, "user_id")


def top_genre(
    watches: DataFrame, items: DataFrame | None, users: DataFrame | None, n: int = RECENT_WATCHES
) -> DataFrame:
    """Most frequent primary genre among a user's last ``n`` watches.

    The last ``n`` are taken first; watches without a genre then cast no vote.
    """
    watched = _of_items(watches, items, "genre_primary").select("user_id", "item_id", "session_ended_at", "genre_primary")
    recent = last_n(watched, "user_id", [F.desc("session_ended_at"), F.asc("item_id")], n)
    votes = (
        recent.filter(F.col("genre_primary").isNotNull())
        .groupBy("user_id", "genre_primary")
        .agg(F.count("*").alias("n"))
    )
    tops = votes.groupBy("user_id").agg(
        mode_of("genre_primary", "n").alias("top"), F.sum("n").alias("watches_used")
    ).select(
        "user_id",
        F.col("top.value").alias("top_genre"),
        F.col("top.n").alias("genre_watch_count"),
        "watches_used",
    )
    return alive(tops, users, "user_id")


def top_device_language(watches: DataFrame, items: DataFrame | None, users: DataFrame | None) -> DataFrame:
    """A user's all-time favourite device and original language.

    Ties go to the value watched last, then to the smaller value. Grouping sets
    count both in one pass over the watches.
    """
    counted = (
        _of_items(watches, items, "original_language")
        .select("user_id", "device_type", "original_language", "session_ended_at")
        .groupingSets(
            [["user_id", "device_type"], ["user_id", "original_language"]],
            "user_id", "device_type", "original_language",
        )
        .agg(
            F.count("*").alias("n"),
            F.max("session_ended_at").alias("last_watched_at"),
            F.grouping("device_type").alias("not_device"),
        )
    )
    # Microseconds negated, so that the later watch is the smaller tie value.
    earlier = -F.unix_micros(F.col("last_watched_at").cast("timestamp"))
    is_device = F.col("not_device") == 0
    has_language = (F.col("not_device") == 1) & F.col("original_language").isNotNull()
    tops = counted.groupBy("user_id").agg(
        mode_of("device_type", "n", earlier, where=is_device).alias("device"),
        mode_of("original_language", "n", earlier, where=has_language).alias("language"),
    ).select(
        "user_id",
        F.col("device.value").alias("top_device"),
        F.col("device.n").alias("device_watch_count"),
        F.col("language.value").alias("top_language"),
        F.col("language.n").alias("language_watch_count"),
    )
    return alive(tops, users, "user_id")


def watch_counts(watches: DataFrame, items: DataFrame | None, users: DataFrame | None) -> DataFrame:
    """Distinct items and all watches per user."""
    counts = alive(watches.select("user_id", "item_id"), items, "item_id").groupBy("user_id").agg(
        F.count_distinct("item_id").alias("distinct_items_watched"),
        F.count("*").alias("total_watches"),
    )
    return alive(counts, users, "user_id")


def viewer_sketches(watches: DataFrame, key: str) -> DataFrame:
    """An HLL sketch of the viewers per ``key``: some kilobytes however many there are, and mergeable.

    Opt-in beside the exact counts: sketches of days or items can be stored and
    merged later, but nothing can be taken out of one.
    """
    return watches.groupBy(key).agg(F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("sketch"))


def merge_sketches(sketches: DataFrame, key: str) -> DataFrame:
    """The approximate distinct count per ``key`` over the sketches that belong to it."""
    return sketches.groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_count"))
