"""The four-table model read off the star-schema parquet tables.

Parts play catalogue items, customers play users, line items joined to their
orders play watches and ratings, and events play heartbeats. A fixed share of
parts and customers is left out, so some facts point at deleted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas
from marquee.functions import wire
from marquee.operators.changes import latest_by_key
from marquee.schemas import struct


TABLES = {
    "nation": struct("n_nationkey integer, n_name string, n_regionkey integer"),
    "customer": struct(
        "c_custkey long, c_name string, c_nationkey integer, c_acctbal double, c_mktsegment string"
    ),
    "part": struct(
        "p_partkey long, p_name string, p_brand string, p_type string, p_size integer, p_retailprice double"
    ),
    "orders": struct(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": struct(
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber integer, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": struct(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table under its declared schema, which saves a look into the files."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _prefixed(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _pick(index: Column, values: list[str | None]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _is_deleted_item() -> Column:
    return F.col("p_partkey") % 50 == 7


def _is_deleted_user() -> Column:
    return F.col("c_custkey") % 40 == 3


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as an item row, deleted ones included, with its part key."""
    key = F.col("p_partkey")
    is_series = F.col("p_size") % 3 == 0
    return read_table(spark, sf_dir, "part").select(
        key,
        _prefixed("i", "p_partkey").alias("item_id"),
        F.when(is_series, "series").otherwise("movie").alias("type"),
        F.col("p_name").alias("title"),
        F.lit(None).cast("string").alias("description"),
        (1950 + key % 75).cast("int").alias("release_year"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")).alias("date_added"),
        F.when(~is_series & (key % 97 != 0), F.col("p_size")).alias("runtime_minutes"),
        F.when(is_series, F.col("p_size") % 10 + 1).alias("season_count"),
        F.when(is_series, F.col("p_size")).alias("episode_count"),
        _pick(key % 3, ["PG", "TV-MA", None]).alias("content_rating"),
        F.when(key % 13 != 0, F.concat(F.lit("NATION_"), (key % 20).cast("string"))).alias("country"),
        F.when(F.col("p_type") != "ECONOMY", F.lower(F.substring("p_type", 1, 2))).alias("original_language"),
        ((key % 100).cast("decimal(3,0)") / 10).cast("decimal(3,1)").alias("imdb_score"),
        (key % 4 == 0).alias("is_netflix_original"),
        (key % 9 == 0).alias("content_warning"),
        F.when(F.col("p_brand") != "Brand#11", F.col("p_brand")).alias("genre_primary"),
        F.when(F.col("p_size") % 2 != 0, F.concat(F.lit("Brand#"), F.col("p_size").cast("string"))).alias("genre_secondary"),
        F.when(key % 10 == 0, "archived").when(key % 10 == 1, "coming_soon").otherwise("active").alias("catalog_status"),
        F.when(key % 6 != 0, F.concat(F.lit("pack"), (key % 6).cast("string"))).alias("seed_source"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue(spark, sf_dir).filter(~_is_deleted_item()).drop("p_partkey")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a user row, deleted ones included, with its key.

    The nation table is fixed at 25 rows; as a one-row map it costs no join and
    is pruned away when the country is not asked for.
    """
    key = F.col("c_custkey")
    nation_names = (
        read_table(spark, sf_dir, "nation")
        .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name"))))
        .scalar()
    )
    return read_table(spark, sf_dir, "customer").select(
        key,
        _prefixed("u", "c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") >= 0, 18 + key % 60).cast("int").alias("age"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "male")
        .when(F.col("c_mktsegment") == "BUILDING", "female")
        .when(F.col("c_mktsegment") == "FURNITURE", "other")
        .when(F.col("c_mktsegment") == "MACHINERY", "nonbinary").alias("gender"),
        F.lower("c_mktsegment").alias("occupation"),
        F.element_at(nation_names, F.col("c_nationkey")).alias("country"),
        _pick(key % 5, ["en", "es", "st", "me", None]).alias("preferred_language"),
        F.date_add(F.lit("2023-01-01").cast("date"), (key % 700).cast("int")).alias("signup_date"),
        _pick(key % 4, ["basic", "standard", "premium", "premium_plus"]).alias("subscription_plan"),
        F.when(key % 10 == 0, "cancelled").when(key % 10 == 1, "suspended").otherwise("active").alias("account_status"),
        _pick(key % 3, ["Mobile", "Smart TV", None]).alias("primary_device"),
        F.when(key % 7 != 0, F.concat(F.lit("pack"), (key % 7).cast("string"))).alias("seed_source"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounts(spark, sf_dir).filter(~_is_deleted_user()).drop("c_custkey")


# What the change log carries of each table: all its columns.
ITEM_CHANGE = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.ITEMS])
USER_CHANGE = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.USERS])


def _created(day: Column, key: Column) -> Column:
    """A time on ``day`` with microseconds."""
    return F.timestamp_micros(F.unix_date(day).cast("bigint") * 86_400_000_000 + key % 86_400 * 1_000_007)


def full_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item row with all columns of the items table."""
    key = F.col("p_partkey")
    created = _created(F.col("date_added"), key)
    return catalogue(spark, sf_dir).withColumns({
        "created_at": created, "updated_at": F.when(key % 4 != 0, created + F.make_dt_interval(F.lit(1)))})


def full_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user row with all columns of the users table."""
    key = F.col("c_custkey")
    spend = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(6,2)").alias("monthly_spend_hours"))
    created = _created(F.col("signup_date"), key)
    return accounts(spark, sf_dir).join(spend, "c_custkey").withColumns({
        "email": F.when(key % 9 != 0, F.concat(F.lit("c"), key, F.lit("@example.com"))), "first_name": F.lit("Ann"),
        "last_name": F.lit(None).cast("string"), "state_province": F.lit(None).cast("string"), "city": F.initcap("occupation"),
        "created_at": created, "updated_at": created})


def _changes(rows: DataFrame, number: str, origin: str, row: T.StructType, status: str, deleted: Column) -> DataFrame:
    """Up to three JSON change records per row: created as a draft, completed, deleted.

    One row in three stays a draft. Deletes come as a NULL value for every
    second deleted row, else as an envelope without an after image.
    """
    key, number = row.names[0], F.col(number)
    final = wire.encode_row(row)
    draft = final.withField(status, F.lit("draft"))

    def envelope(before, after):
        return F.to_json(F.struct(before.alias("before"), after.alias("after")))

    def record(step, wanted, value):
        return F.struct(
            F.lit(step).alias("step"),
            F.coalesce(wanted, F.lit(False)).alias("wanted"),
            value.alias("value"),
        )

    nothing = F.lit(None).cast(wire.wire_schema(row))
    records = F.array(
        record(0, F.lit(True), envelope(nothing, draft)),
        record(1, number % 3 != 1, envelope(draft, final)),
        record(2, deleted, F.when(number % 80 < 40, envelope(final, nothing))),
    )
    return rows.select(
        F.lit(origin).alias("origin"),
        F.to_json(F.struct(key)).alias("key"),
        number.alias("number"),
        F.explode(F.filter(records, lambda r: r["wanted"])).alias("record"),
    ).select("origin", "key", "record.value", (F.col("number") * 4 + F.col("record.step")).alias("seq"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of items and users in one log, ordered per key by ``seq``."""
    item_changes = _changes(
        full_catalogue(spark, sf_dir), "p_partkey", "catalog.public.item", ITEM_CHANGE, "catalog_status", _is_deleted_item()
    )
    user_changes = _changes(
        full_accounts(spark, sf_dir), "c_custkey", "catalog.public.app_user", USER_CHANGE, "account_status", _is_deleted_user()
    )
    return item_changes.unionByName(user_changes)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def watch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        _prefixed("u", "o_custkey").alias("user_id"),
        _prefixed("i", "l_partkey").alias("item_id"),
        (F.col("l_quantity") * 60).cast("int").alias("watched_seconds"),
        _pick(
            F.substring("o_orderpriority", 1, 1).cast("int") - 1,
            ["smart_tv", "mobile", "desktop", "tablet", "game_console"],
        ).alias("device_type"),
        F.col("l_shipdate").alias("session_ended_at"),
    )


def _rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating given, by the numbers of its user and item.

    ``seq`` is the arrival order: ship date, order, line and discount packed
    into one bigint, which compares faster than a struct.
    """
    cents = F.round(F.col("l_discount") * 100).cast("int")
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    line = F.col("l_linenumber") * 16 + cents
    return _order_lines(spark, sf_dir).select(
        "o_custkey",
        "l_partkey",
        (1 + cents % 5).alias("rating"),
        F.col("l_shipdate").alias("rated_at"),
        ((day * 2**40 + F.col("l_orderkey")) * 128 + line).alias("seq"),
    )


def _rating_rows(lines: DataFrame) -> DataFrame:
    return lines.select(
        _prefixed("u", "o_custkey").alias("user_id"), _prefixed("i", "l_partkey").alias("item_id"), *lines.columns[2:])


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rating given, re-ratings included."""
    return _rating_rows(_rating_lines(spark, sf_dir))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest rating of each pair, found by the numbers of the keys, which are shorter than the ids."""
    return _rating_rows(latest_by_key(_rating_lines(spark, sf_dir), ["o_custkey", "l_partkey"], "seq", unique=True).drop("seq"))


def as_heartbeats(events: DataFrame) -> DataFrame:
    """Events as heartbeats; ``seq`` is the arrival order."""
    return events.select(
        _prefixed("u", "user_id").alias("user_id"),
        F.col("event_type").alias("item_id"),
        F.col("value").cast("int").alias("watched_seconds"),
        _pick(F.col("event_id") % 5, ["smart_tv", "mobile", "desktop", "tablet", "game_console"]).alias("device_type"),
        F.col("ts").alias("session_ended_at"),
        F.col("event_id").alias("seq"),
    )


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_heartbeats(read_table(spark, sf_dir, "events"))


def latest_watch_time(spark: SparkSession, sf_dir: str) -> Column:
    """The newest watch time as a scalar; stands in for the wall clock."""
    return read_table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()


def latest_heartbeat_time(spark: SparkSession, sf_dir: str) -> Column:
    return read_table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
