from datetime import timedelta

from pyspark.sql import functions as F

from data import NOW
from marquee.operators import quality


def errors(spark, rows, schema, rules):
    checked = quality.first_error(spark.createDataFrame(rows, schema), rules)
    return [r.error for r in checked.orderBy("n").collect()]


def test_watch_events_stop_at_the_first_error(spark):
    later = NOW + timedelta(minutes=1)
    rows = [
        (0, 1, "mobile", NOW), (1, 0, "mobile", NOW), (2, -1, "", later), (3, 5, "", later), (4, 5, None, NOW),
        (5, 5, "mobile", later), (6, None, "mobile", NOW),
    ]
    schema = "n int, watched_seconds int, device_type string, session_ended_at timestamp"
    length, device, future = [message for message, _ in quality.watch_rules(F.lit(NOW))]
    assert errors(spark, rows, schema, quality.watch_rules(F.lit(NOW))) == [
        None, length, length, device, device, future, length,
    ]


def test_ratings(spark):
    later = NOW + timedelta(minutes=1)
    rows = [(0, 1, NOW), (1, 5, NOW), (2, 0, NOW), (3, 6, NOW), (4, 3, later)]
    scale, future = [message for message, _ in quality.rating_rules(F.lit(NOW))]
    assert errors(spark, rows, "n int, rating int, rated_at timestamp", quality.rating_rules(F.lit(NOW))) == [
        None, None, scale, scale, future,
    ]


def vocabulary(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "code string")


def test_item_rows_collect_all_errors(spark):
    names = (
        "type title release_year runtime_minutes season_count episode_count country original_language "
        "imdb_score genre_primary genre_secondary catalog_status"
    ).split()
    rows = [
        (" movie ", "A", "2016", "", None, "", "us", "EN", "7.5", "drama", "", "active"),
        ("film", " ", "2016.5", "x", "1", "2", "FR", "xx", "high", "noir", "drama", "gone"),
    ]
    checked = quality.validate_items(
        spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)),
        vocabulary(spark, "drama"), vocabulary(spark, "US"), vocabulary(spark, "en"),
    ).collect()
    found = {r.type: r.errors for r in checked}
    assert found[" movie "] == []
    assert [e.split()[0] for e in found["film"]] == [
        "type", "title", "release_year", "runtime_minutes", "country", "original_language", "imdb_score",
        "genre_primary", "catalog_status",
    ]


def test_user_rows(spark):
    names = "age country preferred_language subscription_plan monthly_spend_hours account_status".split()
    rows = [("30", "us", None, "basic", "1.5", "active"), ("3.5", "FR", "xx", "gold", "x", "")]
    checked = quality.validate_users(
        spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), vocabulary(spark, "US"), vocabulary(spark, "en")
    ).collect()
    found = {r.age: [e.split()[0] for e in r.errors] for r in checked}
    assert found == {"30": [], "3.5": names}


def test_an_absent_status_or_plan_takes_its_default(spark):
    names = "age country preferred_language subscription_plan monthly_spend_hours account_status".split()
    row = spark.createDataFrame([(None,) * 6], ", ".join(f"{n} string" for n in names))
    assert quality.validate_users(row, vocabulary(spark, "US"), vocabulary(spark, "en")).first().errors == []


def test_stored_rows(spark):
    df = spark.createDataFrame(
        [("i1", "movie", "active"), ("x1", "clip", "active"), ("i", "movie", None)], "item_id string, type string, catalog_status string"
    )
    checked = quality.all_errors(df, quality.table_rules("item_id")).collect()
    assert {r.item_id: len(r.errors) for r in checked} == {"i1": 0, "x1": 2, "i": 2}


def test_a_vocabulary_that_repeats_a_value_repeats_no_row(spark):
    names = "age country preferred_language subscription_plan monthly_spend_hours account_status".split()
    row = spark.createDataFrame([("30", "us", None, "basic", "1.5", "active")], ", ".join(f"{n} string" for n in names))
    assert quality.validate_users(row, vocabulary(spark, "US", "US"), vocabulary(spark, "en")).count() == 1
