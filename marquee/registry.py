"""Every operator as a named query over the star-schema tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import wire
from marquee.operators import blocks, catalog, changes, quality, sessions
from marquee.plans import admin, loading, panels, reports
from marquee.schemas import struct
from marquee.session import freed_shuffles, shared_dir, tune
from marquee.sources import files, normalise, star_schema, tables
from marquee.streaming import incremental, mirror, refresh, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The test data is at day grain and years old, so trends look back 90 days.
TREND_MINUTES = 90 * 24 * 60


class Inputs:
    """The model tables and reports of one data directory, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def _read(self, build: Callable) -> DataFrame:
        return build(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return star_schema.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def items(self):
        return self._read(star_schema.items)

    @cached_property
    def users(self):
        return self._read(star_schema.users)

    @cached_property
    def catalogue(self):
        return self._read(star_schema.catalogue)

    @cached_property
    def accounts(self):
        return self._read(star_schema.accounts)

    @cached_property
    def change_log(self):
        return self._read(star_schema.change_log)

    @cached_property
    def watches(self):
        return self._read(star_schema.watch_events)

    @cached_property
    def ratings(self):
        return self._read(star_schema.ratings)

    @cached_property
    def rating_events(self):
        return self._read(star_schema.rating_events)

    @cached_property
    def heartbeats(self):
        return self._read(star_schema.heartbeats)

    @cached_property
    def as_of(self):
        return self._read(star_schema.latest_watch_time)

    @cached_property
    def heartbeat_as_of(self):
        return self._read(star_schema.latest_heartbeat_time)

    @cached_property
    def user_rating_avg(self):
        return reports.rating_avg(self.ratings, self.items, self.users, "user_id")

    @cached_property
    def item_rating_avg(self):
        return reports.rating_avg(self.ratings, self.items, self.users, "item_id")

    @cached_property
    def user_mood(self):
        return reports.user_mood(self.ratings, self.items, self.users)

    @cached_property
    def item_view_ranking(self):
        return reports.view_ranking(self.watches, self.items, self.users, self.as_of, TREND_MINUTES)

    @cached_property
    def item_rating_ranking(self):
        return reports.rating_ranking(
            self.ratings, self.watches, self.items, self.users, self.as_of, TREND_MINUTES
        )

    @cached_property
    def item_completion_rate(self):
        return reports.completion_rate(self.watches, self.items, self.users)

    @cached_property
    def item_viewer_demographics(self):
        return reports.viewer_demographics(self.watches, self.items, self.users)

    @cached_property
    def user_series_movie_ratio(self):
        return reports.type_ratio(self.watches, self.items, self.users)

    @cached_property
    def user_top_genre(self):
        return reports.top_genre(self.watches, self.items, self.users)

    @cached_property
    def user_top_device_language(self):
        return reports.top_device_language(self.watches, self.items, self.users)

    @cached_property
    def user_watch_count(self):
        return reports.watch_counts(self.watches, self.items, self.users)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


REPORT_NAMES = [
    "user_rating_avg", "item_rating_avg", "user_mood", "item_view_ranking",
    "item_rating_ranking", "item_completion_rate", "item_viewer_demographics",
    "user_series_movie_ratio", "user_top_genre", "user_top_device_language",
    "user_watch_count",
]
for _name in REPORT_NAMES:
    QUERIES[_name] = lambda spark, sf_dir, _name=_name: getattr(Inputs(spark, sf_dir), _name)


def _named(name: str, build: Callable[[Inputs], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))


# Change streams and state

ITEM_KEY = struct("item_id string")
USER_KEY = struct("user_id string")


def _item_changes(t: Inputs) -> DataFrame:
    routed = changes.route(t.change_log, r"\.item$")
    return changes.unwrap_changes(
        changes.decode_changes(routed, ITEM_KEY, star_schema.ITEM_CHANGE), ["item_id"]
    )


def _user_changes(t: Inputs) -> DataFrame:
    routed = changes.route(t.change_log, r"\.app_user$")
    return changes.unwrap_changes(
        changes.decode_changes(routed, USER_KEY, star_schema.USER_CHANGE), ["user_id"]
    )


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables have them."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"})


@query
def unwrap_changes(t):
    return _plain_times(_item_changes(t))


@query
def unwrap_user_changes(t):
    return _plain_times(_user_changes(t))


@query
def decode_watches(t):
    """Watches as JSON events with times in epoch milliseconds, those of one minute as tombstones."""
    value = F.when(F.col("watched_seconds") > 60, F.to_json(wire.encode_row(schemas.WATCHES, wire.MILLIS)))
    return _plain_times(changes.append_mirror(changes.decode_events(t.watches.select(value.alias("value")), schemas.WATCHES)))


@query
def route_changes(t):
    return changes.route(t.change_log, r"\.app_user$").select("origin", "key", "seq")


@query
def current_state(t):
    return _plain_times(changes.current_state(_item_changes(t), ["item_id"]))


@query
def current_state_users(t):
    return _plain_times(changes.current_state(_user_changes(t), ["user_id"]))


@query
def latest_ratings(t):
    return t.ratings


@query
def append_mirror(t):
    """Watches of one minute arrive as tombstones here."""
    value = F.when(F.col("watched_seconds") > 60, F.struct(*t.watches.columns))
    return changes.append_mirror(t.watches.select(value.alias("value")))


@query
def project_items(t):
    return changes.project(t.items, ["item_id"], ["type", "runtime_minutes", "catalog_status"])


@query
def project_users(t):
    return changes.project(t.users, ["user_id"], ["account_status"])


@query
def fk_valid(t):
    return changes.split_valid(t.watches, t.items, t.users)[0]


@query
def fk_dead_letters(t):
    return changes.split_valid(t.watches, t.items, t.users)[1]


@query
def fk_dead_letter_ratings(t):
    return changes.split_valid(t.ratings, t.items, t.users)[1]


@query
def live_watches(t):
    return blocks.live_facts(t.watches, t.items, t.users)


@query
def live_ratings(t):
    return blocks.live_facts(t.ratings, t.items, t.users)


@query
def stale_keys(t):
    """The full catalogue as the mirror, the live items as its source."""
    return changes.stale_tombstones(t.catalogue, t.items, "item_id")


@query
def stale_user_keys(t):
    return changes.stale_tombstones(t.accounts, t.users, "user_id")


@query
def delete_keys(t):
    archived = t.items.filter(F.col("catalog_status") == "archived").select("item_id")
    return changes.delete_keys(t.items, archived, "item_id")[0].select("item_id", "title")


@query
def delete_keys_tombstones(t):
    archived = t.items.filter(F.col("catalog_status") == "archived").select("item_id")
    return changes.delete_keys(t.items, archived, "item_id")[1]


@query
def clear_genres(t):
    cleared = changes.clear_values(t.items, ["genre_primary", "genre_secondary"], ["Brand#1", "Brand#3"])
    return cleared.select("item_id", "genre_primary", "genre_secondary")


@query
def clear_countries(t):
    gone = ["NATION_1", "NATION_2"]
    items = changes.clear_values(t.items, ["country"], gone).select(F.col("item_id").alias("id"), "country")
    users = changes.clear_values(t.users, ["country"], gone).select(F.col("user_id").alias("id"), "country")
    return items.unionByName(users)


@query
def delete_vocabulary(t):
    return changes.delete_vocabulary(_genres(t), "name", ["Brand#1", "Brand#3"])


@query
def unload_source(t):
    return changes.unload_source(t.items, "pack2").select("item_id", "seed_source")


@query
def forget_source(t):
    return changes.forget_source(_load_log(t), "pack2")


def _earlier_ratings(t: Inputs) -> DataFrame:
    """Averages over the ratings given up to the end of 1999."""
    early = t.ratings.filter(F.col("rated_at") < "2000-01-01")
    return reports.rating_avg(early, t.items, t.users, "item_id")


@query
def full_sync_changes(t):
    """From the item averages of an earlier tick to those of the last."""
    return changes.full_sync(_earlier_ratings(t), t.item_rating_avg, "item_id")


@query
def full_sync_deletes(t):
    """The reverse sync: rows missing from the result are deleted."""
    return changes.full_sync(t.item_rating_avg, _earlier_ratings(t), "item_id")


@query
def full_sync_applied(t):
    """The averages of an earlier tick, stored, brought to the last ones by the change feed alone."""
    root = f"{shared_dir(t.spark)}/sync-{uuid.uuid4().hex}"
    earlier = _earlier_ratings(t)
    mirror.apply_sync(root, changes.full_sync(earlier.limit(0), earlier, "item_id"), "item_id", 1)
    mirror.apply_sync(root, changes.full_sync(tables.latest(t.spark, root), t.item_rating_avg, "item_id"), "item_id", 2)
    return tables.latest(t.spark, root)


@query
def full_replace(t):
    """A table published as version 1, replaced by version 2, and read back."""
    root = f"{shared_dir(t.spark)}/replace-{uuid.uuid4().hex}"
    tables.publish(t.item_rating_ranking.select("type", "rank", "item_id"), root, 1)
    tables.publish(t.item_view_ranking, root, 2)
    return tables.latest(t.spark, root)


@query
def retention(t):
    return changes.retain(t.heartbeats, "session_ended_at", t.heartbeat_as_of).drop("seq")


@query
def retained_watches(t):
    return changes.retain(t.watches, "session_ended_at", t.as_of, days=30)


# Rows rules and pools


@query
def validate_watches(t):
    """Some watches get a blank device or no length, and the last month is the future."""
    seconds = F.col("watched_seconds")
    dirty = t.watches.withColumns({
        "watched_seconds": F.when(seconds % 7 == 0, -seconds).otherwise(seconds),
        "device_type": F.when(F.col("device_type") == "tablet", "").otherwise(F.col("device_type")),
    })
    now = t.as_of - F.make_dt_interval(F.lit(30))
    return quality.first_error(dirty, quality.watch_rules(now))


@query
def validate_ratings(t):
    dirty = t.ratings.withColumn("rating", F.col("rating") * 2 - 2)
    now = t.as_of - F.make_dt_interval(F.lit(30))
    return quality.first_error(dirty, quality.rating_rules(now))


@query
def valid_watches(t):
    now = t.as_of - F.make_dt_interval(F.lit(30))
    return quality.split_events(t.watches, quality.watch_rules(now))[0]


def _pad(column: str):
    return F.concat(F.lit(" "), F.col(column).cast("string"), F.lit(" "))


@query
def validate_items(t):
    """Parts as submitted forms with assorted mistakes; some lack the status, which is none."""
    key = F.col("p_partkey")
    forms = t.catalogue.select(
        "item_id",
        F.when(key % 11 == 0, "film").otherwise(_pad("type")).alias("type"),
        F.when(key % 17 == 0, "  ").otherwise(F.col("title")).alias("title"),
        F.when(key % 5 == 0, "12.5").otherwise(_pad("release_year")).alias("release_year"),
        F.col("runtime_minutes").cast("string").alias("runtime_minutes"),
        F.when(key % 19 == 0, "two").otherwise(F.col("season_count").cast("string")).alias("season_count"),
        F.lit("").alias("episode_count"),
        F.lower(_pad("country")).alias("country"),
        F.upper("original_language").alias("original_language"),
        F.when(key % 23 == 0, "n/a").otherwise(F.col("imdb_score").cast("string")).alias("imdb_score"),
        "genre_primary",
        "genre_secondary",
        F.when(key % 29 == 0, "gone").when(key % 31 != 0, F.col("catalog_status")).alias("catalog_status"),
    )
    genres = t.items.select("genre_primary").filter(F.col("genre_primary").isNotNull()).distinct()
    countries = t.users.select("country").filter(F.col("country") != "NATION_5").distinct()
    languages = t.items.select("original_language").filter(F.col("original_language") != "la").distinct()
    checked = quality.validate_items(forms, genres, countries, languages)
    return checked.select("item_id", F.array_join("errors", "; ").alias("errors"))


@query
def validate_users(t):
    key = F.col("c_custkey")
    forms = t.accounts.select(
        "user_id",
        F.when(key % 7 == 0, "old").otherwise(_pad("age")).alias("age"),
        "country",
        "preferred_language",
        F.when(key % 13 == 0, "gold").when(key % 23 != 0, _pad("subscription_plan")).alias("subscription_plan"),
        F.when(key % 17 == 0, "1,5").otherwise("7.25").alias("monthly_spend_hours"),
        F.when(key % 19 == 0, "").when(key % 29 != 0, F.col("account_status")).alias("account_status"),
    )
    countries = t.users.select("country").filter(F.col("country") != "NATION_5").distinct()
    languages = t.users.select("preferred_language").filter(F.col("preferred_language") != "es").distinct()
    checked = quality.validate_users(forms, countries, languages)
    return checked.select("user_id", F.array_join("errors", "; ").alias("errors"))


@query
def table_constraints(t):
    odd = t.items.withColumns({
        "item_id": F.when(F.col("release_year") == 1960, F.upper("item_id")).otherwise(F.col("item_id")),
        "type": F.when(F.col("release_year") == 1961, "clip").otherwise(F.col("type")),
    })
    broken = quality.all_errors(odd, quality.table_rules("item_id")).filter(F.size("errors") > 0)
    return broken.select("item_id", F.array_join("errors", "; ").alias("errors"))


@query
def active_pool(t):
    return quality.active_items(t.items)


@query
def active_user_pool(t):
    return quality.active_users(t.users)


# Loading


def _genres(t: Inputs) -> DataFrame:
    """The genre vocabulary: all brands in use, and one that is not."""
    used = catalog.sync_vocab(
        t.spark.createDataFrame([], "name string"), "name",
        t.catalogue.select("genre_primary"), t.catalogue.select("genre_secondary"),
    )
    return used.union(t.spark.createDataFrame([("Unused",)], "name string"))


def _load_log(t: Inputs) -> DataFrame:
    """One load per part batch, named after its source, full or partial."""
    key = F.col("p_partkey")
    suffix = F.when(key % 3 == 0, ":items").when(key % 3 == 1, ":users").otherwise("")
    return t.catalogue.filter(F.col("seed_source").isNotNull()).select(
        F.concat("seed_source", suffix).alias("seed_name"),
        (key % 100).alias("item_count"),
        (key % 50).alias("user_count"),
        F.col("date_added").cast("timestamp_ntz").alias("loaded_at"),
    )


def _ordered(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(files.ORDER, F.col(key))


def _title_rows(t: Inputs) -> DataFrame:
    """Parts written the way a title file holds them."""
    key = F.col("p_partkey")
    listed = F.concat(F.lit("['"), F.col("p_brand"), F.lit("', '"), F.col("p_type"), F.lit("']"))
    return _ordered(t.table("part").select(
        key,
        F.when(key % 50 != 3, F.concat(F.lit("ts"), key)).otherwise(" ").alias("id"),
        F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")).alias("title"),
        F.when(F.col("p_size") % 3 == 0, "show").otherwise("MOVIE").alias("type"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("About "), "p_name")).alias("description"),
        F.when(key % 9 == 0, "").otherwise(F.concat(1950 + key % 30, F.lit(".0"))).alias("release_year"),
        F.when(key % 3 == 0, "").otherwise("TV-14").alias("age_certification"),
        F.when(key % 8 == 0, "inf").otherwise(F.concat(F.col("p_size"), F.lit(".9"))).alias("runtime"),
        F.when(key % 5 == 0, F.concat("p_type", F.lit(", "), "p_brand"))
        .when(key % 5 == 1, "").when(key % 5 == 2, "[]").otherwise(listed).alias("genres"),
        F.when(key % 6 == 0, "['DE', 'US']").when(key % 6 == 1, "['ZZ']").when(key % 6 == 2, "('FR', 'US')")
        .otherwise("").alias("production_countries"),
        (F.col("p_size") % 10).cast("string").alias("seasons"),
        F.when(key % 7 == 0, "n/a").otherwise((key % 100 / 10).cast("decimal(3,1)").cast("string")).alias("imdb_score"),
    ), "p_partkey").drop("p_partkey")


def _lookup_rows(t: Inputs) -> DataFrame:
    """Parts as rows of the metadata lookup, with repeated titles; every second title is unknown to the pack."""
    key = F.col("p_partkey")
    day = F.date_add(F.lit("2021-01-01").cast("date"), (key % 365).cast("int"))
    return _ordered(t.table("part").select(
        key,
        F.when(key % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit("unlisted "), "p_name")).alias("title"),
        (1950 + key % 30).cast("string").alias("release_year"),
        F.when(key % 4 == 0, "soon").otherwise(F.date_format(day, "MMMM d, yyyy")).alias("date_added"),
        F.when(key % 3 == 0, "").otherwise("PG").alias("rating"),
    ), "p_partkey").drop("p_partkey")


@query
def normalise_titles(t):
    return normalise.normalise_titles(_title_rows(t), "large").drop("description")


@query
def enrich_titles(t):
    lookup = normalise.title_lookup(_lookup_rows(t))
    return normalise.enrich_titles(_new_items(t), lookup).select(
        files.ORDER, "title", "release_year", "date_added", "content_rating"
    )


@query
def normalise_movies(t):
    key = F.col("p_partkey")
    rows = t.table("part").select(
        key,
        F.when(key % 40 == 5, " ").otherwise(F.col("p_name")).alias("title"),
        F.when(key % 3 == 0, F.concat("p_size", F.lit(".0"))).alias("number_of_seasons"),
        F.when(key % 4 == 0, F.col("p_size").cast("string")).otherwise("").alias("number_of_episodes"),
        F.concat(1950 + key % 75, F.lit("")).alias("release_year"),
        F.concat("p_size", F.lit(".7")).alias("duration_minutes"),
        F.when(key % 2 == 0, " PG ").alias("rating"),
        F.element_at(F.array(*map(F.lit, ["English", "korean ", "Klingon"])), (key % 3 + 1).cast("int")).alias("language"),
        F.element_at(F.array(*map(F.lit, ["USA", "South Korea", "Atlantis"])), (key % 3 + 1).cast("int")).alias("country_of_origin"),
        F.when(key % 5 == 0, "").otherwise((key % 100 / 10).cast("decimal(3,1)").cast("string")).alias("imdb_rating"),
        F.when(key % 2 == 0, "True").otherwise("yes").alias("is_netflix_original"),
        F.when(key % 7 == 0, " TRUE").alias("content_warning"),
        F.when(key % 6 == 0, "2023-13-01").otherwise("2023-8-07").alias("added_to_platform"),
        F.col("p_brand").alias("genre_primary"),
        F.lit("").alias("genre_secondary"),
    )
    items = normalise.normalise_movies(_ordered(rows, "p_partkey"), "native")
    return items.drop("description")


def _dat_lines(t: Inputs) -> DataFrame:
    """Customers as ``::`` lines; some have a field too many or too few."""
    key = F.col("c_custkey")
    gender = F.element_at(F.array(*map(F.lit, ["M", "F", "x"])), (key % 3 + 1).cast("int"))
    zipped = F.when(key % 20 == 0, "1::2").otherwise("12345")
    line = F.concat_ws("::", key, gender, 18 + key % 40, key % 25, zipped)
    return t.table("customer").select(
        F.when(key % 30 == 7, "1::M::20").otherwise(line).alias("value"), key.alias(files.ORDER)
    )


@query
def users_dat(t):
    return files.parse_users_dat(_dat_lines(t))


@query
def normalise_ml_users(t):
    users = normalise.normalise_ml_users(files.parse_users_dat(_dat_lines(t)), "large")
    return users.select(
        files.ORDER, "age", "gender", "occupation", "country", "preferred_language",
        "signup_date", "subscription_plan", "account_status", "seed_source",
    )


def _user_rows(t: Inputs) -> DataFrame:
    key = F.col("c_custkey")

    def turn(*values):
        return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))

    return _ordered(t.table("customer").select(
        key,
        F.concat(F.lit("user_"), key).alias("user_id"),
        F.concat(F.lit(" c"), key, F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("first_name"),
        F.lit("  ").alias("last_name"),
        F.concat(key % 130 - 10, F.lit(".0")).alias("age"),
        turn("Male", "female ", "Prefer not to say", "", "robot").alias("gender"),
        turn("USA", "uk", "Japan", "Mars").alias("country"),
        F.lit(None).cast("string").alias("state_province"),
        F.col("c_mktsegment").alias("city"),
        turn("Basic", "Premium+", " STANDARD", "gold", "premium").alias("subscription_plan"),
        turn("2022-10-07", "2022/10/07", "").alias("subscription_start_date"),
        turn("True", "False", "1").alias("is_active"),
        F.format_string("%.2f", F.abs("c_acctbal")).alias("monthly_spend_hours"),
        turn("Desktop", "").alias("primary_device"),
    ), "c_custkey").drop("c_custkey")


@query
def normalise_users(t):
    return normalise.normalise_users(_user_rows(t), "native").drop("occupation")


def _new_items(t: Inputs) -> DataFrame:
    rows = normalise.normalise_titles(_title_rows(t), "large")
    known = t.items.filter(F.col("seed_source") == "pack1")
    return catalog.new_items(rows, known)


@query
def new_items_dedup(t):
    return _new_items(t).select(files.ORDER, "title", "release_year")


@query
def load_counts(t):
    rows = normalise.normalise_titles(_title_rows(t), "large")
    return catalog.load_counts(rows, _new_items(t))


@query
def assign_ids(t):
    """New ids for the de-duplicated titles, after the highest id in use."""
    start = catalog.last_number(t.items, "item_id", "i")
    return catalog.assign_ids(_new_items(t), "item_id", "i", start, [files.ORDER]).select(
        "item_id", "title", "release_year"
    )


@query
def load_pack(t):
    """A title pack with its lookup loaded into the catalogue, ids and all."""
    none = t.spark.createDataFrame([], "code string")
    before = loading.Catalogue(
        items=t.items, users=t.users, counter=t.spark.createDataFrame([], "prefix string, next_n bigint"),
        log=t.spark.createDataFrame([], schemas.LOAD_LOG), genres=none, countries=none, languages=none,
    )
    rows = normalise.normalise_titles(_title_rows(t), "large")
    after, _ = loading.load(
        before, "large", datetime(2024, 1, 1), rows, lookup=normalise.title_lookup(_lookup_rows(t))
    )
    return after.items.select("item_id", "title", "release_year", "seed_source", "content_rating")


def _stored_load(t: Inputs) -> str:
    """The title pack loaded into a stored catalogue that has the items and users already; returns its root."""
    root = f"{shared_dir(t.spark)}/catalogue-{uuid.uuid4().hex}"
    nothing = loading.read_catalogue(t.spark, root)
    filled = {name: getattr(nothing, name).unionByName(getattr(t, name), allowMissingColumns=True) for name in ("items", "users")}
    loading.store(root, replace(nothing, **filled))
    rows = normalise.normalise_titles(_title_rows(t), "large")
    for _ in range(2):
        try:
            loading.load_stored(t.spark, root, "large", datetime(2024, 1, 1), rows, lookup=normalise.title_lookup(_lookup_rows(t)))
        except catalog.AlreadyLoaded:
            pass  # the second time
    return root


@query
def load_stored_pack(t):
    """Items, ids and all, of a stored load that was tried twice."""
    items = loading.read_catalogue(t.spark, _stored_load(t)).items
    return items.select("item_id", "title", "release_year", "seed_source", "content_rating")


@query
def load_stored_tables(t):
    """Counter, log and vocabularies of the same load."""
    after = loading.read_catalogue(t.spark, _stored_load(t))

    def rows(kind, name, n):
        return getattr(after, kind).select(F.lit(kind).alias("kind"), F.col(name).alias("name"), n.cast("bigint").alias("n"))

    return admin.stack([
        rows("counter", "prefix", F.col("next_n")), rows("log", "seed_name", F.col("item_count") + F.col("user_count")),
        rows("genres", "name", F.lit(1)), rows("countries", "code", F.lit(1)), rows("languages", "code", F.lit(1)),
    ])


@query
def load_guard(t):
    """For every source and mode, whether a load is refused as a repeat."""
    modes = F.explode(F.array(*map(F.lit, ["full", "items", "users"]))).alias("mode")
    sources = t.catalogue.select(F.coalesce("seed_source", F.lit("none")).alias("seed_name")).distinct()
    return catalog.refused(_load_log(t), sources.select("seed_name", modes))


@query
def mirror_log(t):
    """The whole change log streamed into the item and user state tables."""
    root = f"{shared_dir(t.spark)}/log-{uuid.uuid4().hex}"
    t.change_log.write.parquet(f"{root}/in")
    targets = [
        mirror.Target(r"\.item$", ITEM_KEY, star_schema.ITEM_CHANGE, f"{root}/items"),
        mirror.Target(r"\.app_user$", USER_KEY, star_schema.USER_CHANGE, f"{root}/users"),
    ]
    records = files.read_stream(t.spark, f"{root}/in", t.change_log.schema)
    job = mirror.mirror_log(records, targets, f"{root}/checkpoint").trigger(availableNow=True).start()
    job.awaitTermination()
    items = mirror.read_state(t.spark, f"{root}/items").select(F.col("item_id").alias("id"), F.col("catalog_status").alias("status"))
    users = mirror.read_state(t.spark, f"{root}/users").select(F.col("user_id").alias("id"), F.col("account_status").alias("status"))
    return items.unionByName(users)


@query
def assign_user_ids(t):
    rows = normalise.normalise_users(_user_rows(t), "native")
    return catalog.assign_ids(rows, "user_id", "u", 0, [files.ORDER]).select("user_id", "email")


@query
def vocab_sync(t):
    known = t.catalogue.filter(F.col("seed_source") == "pack1").select(F.col("genre_primary").alias("name"))
    return catalog.sync_vocab(
        known.filter(F.col("name").isNotNull()).distinct(), "name",
        t.items.select("genre_primary"), t.items.select("genre_secondary"),
    )


@query
def vocab_sync_countries(t):
    known = t.spark.createDataFrame([("NATION_1",)], "code string")
    return catalog.sync_vocab(known, "code", t.items.select("country"), t.users.select("country"))


@query
def vocab_sync_languages(t):
    known = t.spark.createDataFrame([("en",)], "code string")
    return catalog.sync_vocab(
        known, "code", t.items.select("original_language"), t.users.select("preferred_language")
    )


@query
def load_history(t):
    return catalog.load_history(_load_log(t))


@query
def title_pack_counts(t):
    users = files.parse_users_dat(_dat_lines(t))
    return catalog.title_pack_counts(_title_rows(t), users)


@query
def movie_pack_counts(t):
    movies = t.items.select("title", "genre_primary", "genre_secondary")
    return catalog.movie_pack_counts(movies, _user_rows(t))


def _csv_folder(t: Inputs) -> str:
    """Parts written as CSV lines: quoted commas, quotes and line breaks, and
    every 25th row a field short, every 40th a field long."""
    key = F.col("p_partkey")
    quoted = F.concat(F.lit('"'), "p_name", F.lit(', the ""'), "p_brand", F.lit('""\n film"'))
    line = F.concat_ws(
        ",", key, quoted, F.when(key % 25 != 0, F.lit("MOVIE")), F.when(key % 40 == 1, F.lit("extra")), F.col("p_size")
    )
    folder = f"{shared_dir(t.spark)}/titles-{uuid.uuid4().hex}"
    t.table("part").select(line.alias("value")).write.text(folder)
    return folder


SHORT_TITLES = struct("id string, title string, type string, runtime string")


@query
def strict_csv_rows(t):
    rows, _ = files.read_titles(t.spark, _csv_folder(t), SHORT_TITLES, header=False)
    return rows.drop(files.ORDER)


@query
def strict_csv_rejects(t):
    _, rejects = files.read_titles(t.spark, _csv_folder(t), SHORT_TITLES, header=False)
    return rejects.select("id")


@query
def lenient_csv_rows(t):
    return files.read_pack(t.spark, _csv_folder(t), SHORT_TITLES, header=False).select("id", "title", "type")


# Sessions

GAP_SECONDS = 12 * 3600


@query
def settle_sessions(t):
    return sessions.settle_sessions(t.heartbeats, gap_seconds=GAP_SECONDS)


@query
def settle_sessions_closed(t):
    return sessions.settle_sessions(
        t.heartbeats, gap_seconds=GAP_SECONDS, closed_by=t.heartbeat_as_of
    )


@query
def settle_stream(t):
    """The streaming job over the events, run until they are used up."""
    source = files.read_stream(t.spark, f"{t.sf_dir}/events*.parquet", star_schema.TABLES["events"])
    beats = star_schema.as_heartbeats(source).withColumn(
        "session_ended_at", F.col("session_ended_at").cast("timestamp")
    )
    root = f"{shared_dir(t.spark)}/settle-{uuid.uuid4().hex}"
    settled = settle.settle_stream(beats, gap_seconds=GAP_SECONDS)
    job = settled.writeStream.outputMode("append").trigger(availableNow=True).option(
        "checkpointLocation", f"{root}/checkpoint"
    ).start(f"{root}/settled", format="parquet")
    job.awaitTermination()
    return t.spark.read.schema(settled.schema).parquet(f"{root}/settled").withColumn(
        "session_ended_at", F.col("session_ended_at").cast("timestamp_ntz")
    )


# Heartbeats of one file that settle_stream_late plays.
LATE_FILE_ROWS = 250_000


@query
def settle_stream_late(t):
    """Late records without tolerance: every heartbeat plays three keys over four batches in a row.

    Key a comes again 4 s later, but after key b at 15 s has closed it; key d
    comes at 0, 15 and 8 s, of which the last bridges only sessions still open.
    A last batch, far in the future, closes everything.
    """
    root = f"{shared_dir(t.spark)}/late-{uuid.uuid4().hex}"
    files_each = 4 + t.heartbeats.count() // LATE_FILE_ROWS  # as many tasks write and read a batch
    moment = F.unix_seconds(F.col("session_ended_at").cast("timestamp")) % 8
    beats = t.heartbeats.withColumn("item_id", F.concat(F.lit(":"), F.col("seq").cast("string")))
    for batch, records in enumerate([[("a", 0), ("d", 0)], [("b", 15), ("d", 15)], [("a", 4), ("d", 8)], [("z", 1000)]]):
        steps = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(at).alias("at")) for kind, at in records])).alias("step")
        beats.select("*", steps).withColumns({
            "item_id": F.concat("step.kind", "item_id"), "session_ended_at": F.timestamp_seconds(moment + F.col("step.at")),
            "watched_seconds": F.col("step.at"),
        }).drop("step").repartition(files_each).write.mode("append").parquet(f"{root}/in")
    schema = t.spark.read.parquet(f"{root}/in").schema
    with settle.no_tolerance(t.spark):
        source = files.read_stream(t.spark, f"{root}/in", schema, max_files_per_trigger=files_each)
        settled = settle.settle_stream(source).writeStream.outputMode("append").trigger(availableNow=True)
        settled.option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/settled", format="parquet").awaitTermination()
    return t.spark.read.schema(schema).parquet(f"{root}/settled").select(
        "user_id", "item_id", "watched_seconds", F.unix_seconds("session_ended_at").alias("ended"))


@query
def open_sessions(t):
    return sessions.open_sessions(t.heartbeats, t.heartbeat_as_of, gap_seconds=GAP_SECONDS)


@query
def free_users(t):
    return sessions.free_users(quality.active_users(t.users), _open(t))


@query
def target_seconds(t):
    return sessions.target_seconds(t.items)


def _open(t: Inputs) -> DataFrame:
    return sessions.open_sessions(t.heartbeats, t.heartbeat_as_of, gap_seconds=GAP_SECONDS)


# Streaming state


@query
def incremental_user_rating_avg(t):
    """Averages kept as sums, over two batches of rating events."""
    first = t.rating_events.filter(F.col("rated_at") < "2000-01-01")
    second = t.rating_events.filter(F.col("rated_at") >= "2000-01-01")
    nothing = t.spark.createDataFrame([], "user_id string, rating_sum bigint, rating_count bigint")
    unrated = first.limit(0)
    deltas, known = mirror.rating_deltas(unrated, first)
    state = mirror.update_averages(nothing, deltas, "user_id")
    deltas, _ = mirror.rating_deltas(known, second)
    return mirror.averages(mirror.update_averages(state, deltas, "user_id"), "user_id")


# The columns of each report: its key, texts and numbers.
REPORT_COLUMNS = {
    "user_rating_avg": (["user_id"], [], ["avg_rating", "rating_count"]),
    "item_rating_avg": (["item_id"], [], ["avg_rating", "rating_count"]),
    "user_mood": (["user_id"], ["mood"], ["avg_recent_rating", "ratings_used"]),
    "item_view_ranking": (["type", "rank"], ["item_id"], ["view_count"]),
    "item_rating_ranking": (["type", "rank"], ["item_id"], ["avg_rating", "rating_count"]),
    "item_completion_rate": (["item_id"], ["type"], ["completion_rate", "watch_count"]),
    "item_viewer_demographics": (
        ["item_id"], [], ["average_age", "pct_male", "pct_female", "pct_other", "pct_unknown", "viewer_count"]),
    "user_series_movie_ratio": (
        ["user_id"], [], ["movie_watch_count", "series_watch_count", "movie_percentage", "series_percentage"]),
    "user_top_genre": (["user_id"], ["top_genre"], ["genre_watch_count", "watches_used"]),
    "user_top_device_language": (["user_id"], ["top_device", "top_language"], ["device_watch_count", "language_watch_count"]),
    "user_watch_count": (["user_id"], [], ["distinct_items_watched", "total_watches"]),
}


def _content(read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of all reports under common columns."""
    def rows(name, key, texts, numbers):
        none = F.lit(None)
        return read(name).select(
            F.lit(name).alias("report"), F.concat_ws(":", *key).alias("key"),
            *[(F.col(texts[k]) if k < len(texts) else none.cast("string")).alias(f"text{k + 1}") for k in range(2)],
            *[(F.col(numbers[k]) if k < len(numbers) else none).cast("double").alias(f"n{k + 1}") for k in range(6)])
    return admin.stack([rows(name, *columns) for name, columns in REPORT_COLUMNS.items()])


@query
def approximate_watch_counts(t):
    """Distinct viewers per type from sketches merged over items, and whether they are within the stated error of the exact count."""
    sketches = reports.viewer_sketches(blocks.live_facts(t.watches, t.items, t.users), "item_id")
    typed = sketches.join(t.items.select("item_id", "type"), "item_id")
    merged = reports.merge_sketches(typed, "type")
    exact = blocks.live_facts(t.watches, t.items, t.users).join(t.items.select("item_id", "type"), "item_id").groupBy("type").agg(
        F.count_distinct("user_id").alias("viewers"))
    return merged.join(exact, "type").select(
        "type", "viewers", (F.abs(F.col("approx_count") - F.col("viewers")) <= 3 * reports.SKETCH_ERROR * F.col("viewers")).alias("within_error"))


@query
def refresh_tick(t):
    """A whole tick written and read back: the rows of every report table."""
    root = f"{shared_dir(t.spark)}/tick-{uuid.uuid4().hex}"
    with freed_shuffles(t.spark):  # a tick reads stored facts, not the joins these are made by
        facts = {"ratings": t.ratings, "watch_events": t.watches}
        stored = {name: tables.as_files(rows, f"{root}/facts/{name}") for name, rows in facts.items()}
    refresh.run_tick({"items": t.items, "users": t.users, **stored}, root, 1, t.as_of)
    tables.remove(t.spark, f"{root}/facts")
    return _content(lambda name: tables.latest(t.spark, f"{root}/{name}"))


def _between(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    return df.filter((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))


@query
def incremental_reports(t):
    """All reports kept by deltas over three ticks, with changed attributes in the second and deletes in the second and third."""
    root = f"{shared_dir(t.spark)}/increments-{uuid.uuid4().hex}"
    number, account = F.col("p_partkey"), F.col("c_custkey")
    everything, everyone = t.catalogue, t.accounts
    first = (
        everything.withColumns({
            "type": F.when(number % 9 == 0, "movie").otherwise(F.col("type")),
            "genre_primary": F.when(number % 7 != 0, F.col("genre_primary")),
            "original_language": F.when(number % 4 == 0, "xx").otherwise(F.col("original_language")),
            "runtime_minutes": F.when(number % 5 == 0, 7).otherwise(F.col("runtime_minutes")),
        }).drop("p_partkey"),
        everyone.withColumns({"age": F.when(account % 6 != 0, F.col("age")), "gender": F.when(account % 8 != 0, F.col("gender"))}),
    )
    second = everything.filter(number % 100 != 7), everyone.filter(account % 80 != 3)
    ticks = [
        (first, "1900-01-01", "1997-06-01"), (second, "1997-06-01", "1999-09-01"), ((t.items, t.users), "1999-09-01", "2900-01-01"),
    ]
    for number, ((items, users), start, end) in enumerate(ticks):
        as_of = t.as_of if number == 2 else F.lit(end).cast("timestamp_ntz")
        ratings, watches = _between(t.rating_events, "rated_at", start, end), _between(t.watches, "session_ended_at", start, end)
        incremental.advance(root, number, items, users, ratings, watches, as_of, parts=4, minutes=TREND_MINUTES)
    return _content(lambda name: incremental.read_report(t.spark, root, name))


# Dashboard panels

_named("total_items", lambda t: panels.total(t.items, "total_items"))
_named("total_users", lambda t: panels.total(t.users, "total_users"))
_named("overall_avg_rating", lambda t: panels.overall_rating(t.user_rating_avg, t.users))
_named("users_with_rating", lambda t: panels.users_with_rating(t.user_rating_avg, t.users))
_named("items_by_type", lambda t: panels.items_by_type(t.items))
_named("users_by_plan", lambda t: panels.users_by_plan(t.users))
_named("item_count_movie", lambda t: panels.item_count(t.items, "movie"))
_named("item_detail", lambda t: panels.item_detail_from_facts(
    t.items, t.users, t.ratings, t.watches))
_named("item_detail_series", lambda t: panels.item_detail_from_facts(
    t.items, t.users, t.ratings, t.watches, item_type="series"))
_named("avg_completion_pct", lambda t: panels.mean_completion(t.item_completion_rate, t.items))
_named("avg_completion_pct_movie", lambda t: panels.mean_completion(t.item_completion_rate, t.items, "movie"))
_named("avg_item_rating_series", lambda t: panels.mean_item_rating(t.item_rating_avg, t.items, "series"))
_named("user_count_premium", lambda t: panels.user_count(t.users, "premium"))
_named("avg_user_rating_basic", lambda t: panels.mean_user_rating(t.user_rating_avg, t.users, "basic"))
_named("users_by_country_top10", lambda t: panels.users_by_country(t.users))
_named("users_by_country_top10_basic", lambda t: panels.users_by_country(t.users, "basic"))
_named("rating_per_user", lambda t: panels.rating_per_user(t.user_rating_avg, t.users))
_named("user_detail", lambda t: panels.user_detail_from_facts(
    t.users, t.items, t.ratings, t.watches))
_named("user_detail_one", lambda t: panels.user_detail_from_facts(
    t.users, t.items, t.ratings, t.watches, user_id="u20"))
_named("users_by_mood", lambda t: panels.users_by_mood(t.user_mood, t.users))
_named("users_by_top_genre", lambda t: panels.users_by_top_genre(t.user_top_genre, t.users))
_named("trending_series_views", lambda t: panels.trending(t.item_view_ranking, t.items, "series"))
_named("trending_movie_views", lambda t: panels.trending(t.item_view_ranking, t.items, "movie"))
_named("trending_series_ratings", lambda t: panels.trending(t.item_rating_ranking, t.items, "series"))
_named("trending_movie_ratings", lambda t: panels.trending(t.item_rating_ranking, t.items, "movie"))
_named("item_id_options", lambda t: panels.options(t.items, "item_id", unique=True))
_named("item_type_options", lambda t: panels.options(t.items, "type"))
_named("user_id_options", lambda t: panels.options(t.users, "user_id", unique=True))
_named("user_plan_options", lambda t: panels.options(t.users, "subscription_plan"))

# Catalogue and activity

_named("catalog_summary", lambda t: admin.catalog_summary(t.items, t.users))
_named("item_search", lambda t: admin.item_search(
    t.items, id_text="I1", item_type="movie", status="active", genre="Brand#7", sort="item_id", direction="desc")
    .select("item_id", "title", "genre_primary", "genre_secondary"))
_named("user_search", lambda t: admin.user_search(
    t.users, id_text="u1", gender="female", plan="basic", status="active", sort="age").select("user_id", "age", "country"))
_named("items_per_genre", lambda t: admin.items_per_genre(t.items))
_named("option_counts", lambda t: admin.option_counts(t.items, t.users))
_named("genre_usage", lambda t: admin.genre_usage(_genres(t), t.items))
_named("country_usage", lambda t: admin.code_usage(
    t.table("nation").select(F.col("n_name").alias("code")), t.items.select("country"), t.users.select("country")))
_named("language_usage", lambda t: admin.code_usage(
    t.items.select(F.col("original_language").alias("code")).filter(F.col("code").isNotNull()).distinct(),
    t.items.select("original_language"), t.users.select("preferred_language")))
_named("items_per_source", lambda t: admin.rows_per_source(t.items))
_named("users_per_source", lambda t: admin.rows_per_source(t.users))
_named("device_breakdown", lambda t: admin.device_breakdown(t.watches))
_named("recent_watches", lambda t: admin.recent_watches(t.watches))
_named("activity_counts", lambda t: admin.activity_counts(_open(t), t.watches))
