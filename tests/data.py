"""Small model tables built in the tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

NOW = datetime(2024, 5, 1, 12, 0, 0)


def ago(minutes=0, seconds=0):
    return NOW - timedelta(minutes=minutes, seconds=seconds)


def items(spark, *rows):
    """Rows are (item_id, type, runtime_minutes, genre_primary, original_language)."""
    filled = [tuple(row) + ("movie", 100, None, None)[len(row) - 1:] for row in rows]
    schema = "item_id string, type string, runtime_minutes int, genre_primary string, original_language string"
    return spark.createDataFrame(filled, schema).withColumn("title", F.col("item_id"))


def users(spark, *rows):
    """Rows are (user_id, age, gender)."""
    filled = [tuple(row) + (30, "female")[len(row) - 1:] for row in rows]
    return spark.createDataFrame(filled, "user_id string, age int, gender string")


def ratings(spark, *rows):
    return spark.createDataFrame(
        list(rows), "user_id string, item_id string, rating int, rated_at timestamp"
    )


def watches(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "user_id string, item_id string, watched_seconds int, device_type string, session_ended_at timestamp",
    )


def by_key(df, key):
    return {row[key]: row for row in df.collect()}
