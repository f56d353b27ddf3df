"""What the plans must look like to hold at scale."""

import contextlib
import io
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import data
from data import NOW
from marquee.operators import blocks, changes
from marquee.plans import reports
from marquee.sources import star_schema, tables
from marquee.streaming import incremental, refresh

QUERIES = spark_entry.queries()
# These run jobs while they build their result.
EAGER = {"refresh_tick", "settle_stream", "full_replace", "assign_ids", "assign_user_ids", "load_pack", "mirror_log"}


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    with settings(spark, **{"spark__sql__autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas", plan)


def test_only_the_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["item_completion_rate"](spark, sf_dir))
    read = set(re.findall(r"[lopc]_\w+(?=:)", " ".join(re.findall(r"ReadSchema: (.*)", plan))))
    assert read == {"l_orderkey", "l_partkey", "l_quantity", "o_orderkey", "o_custkey", "p_partkey", "p_size", "c_custkey"}


def test_the_time_window_reaches_the_scan(spark, sf_dir):
    watches = star_schema.watch_events(spark, sf_dir)
    items, users = star_schema.items(spark, sf_dir), star_schema.users(spark, sf_dir)
    as_of = F.lit(NOW).cast("timestamp_ntz")
    plan = plan_of(reports.view_ranking(watches, items, users, as_of))
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_an_event_table_is_pruned_to_the_days_of_the_window(spark, tmp_path):
    for batch, days in enumerate((0, 1, 400)):
        watched = data.watches(spark, ("u1", "i1", 60, "mobile", NOW - timedelta(days=days)))
        tables.append_batch(watched, f"{tmp_path}/watches", batch, "session_ended_at")
    watches = tables.appended(spark, f"{tmp_path}/watches")
    items, users = data.items(spark, ("i1",)), data.users(spark, ("u1",))
    ranking = reports.view_ranking(watches, items, users, F.lit(NOW), minutes=2 * 24 * 60)
    assert ranking.first().view_count == 2
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-04-29", plan_of(ranking, "simple"))
    kept = changes.retain(watches, "session_ended_at", F.lit(NOW))
    assert kept.count() == 2 and "day#" in plan_of(kept, "simple").split("PartitionFilters")[1]


@pytest.mark.parametrize("name", ["user_mood", "user_top_genre", "item_view_ranking", "item_rating_ranking"])
def test_groups_are_cut_to_their_top_rows_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir), "simple")
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 1
    assert len(re.findall(r"WindowGroupLimit.*Final", plan)) == 1


def test_latest_ratings_are_aggregated_without_a_sort(spark, sf_dir):
    plan = plan_of(QUERIES["latest_ratings"](spark, sf_dir), "simple")
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_the_id_of_a_detail_panel_reaches_the_facts(spark, sf_dir):
    plan = plan_of(QUERIES["user_detail_one"](spark, sf_dir))
    scans = [s for s in re.split(r"\n\n", plan) if "Scan parquet" in s and "orders.parquet" in s]
    filters = re.findall(r"Condition : .*o_custkey.*u20", plan)
    assert scans and len(filters) >= len(scans)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Watches of which one user has a third and one item another, in many files."""
    folder = str(tmp_path_factory.mktemp("hot"))
    n = F.col("id")
    spark.range(0, 120_000, numPartitions=12).select(
        F.concat(F.lit("u"), F.when(n % 3 == 0, 0).otherwise(n * 104729 % 5000)).alias("user_id"),
        F.concat(F.lit("i"), F.when(n % 3 == 1, 0).otherwise(n * 7919 % 4999)).alias("item_id"),
        (n % 3000).cast("int").alias("watched_seconds"),
        F.lit("mobile").alias("device_type"),
        F.timestamp_seconds(n).alias("session_ended_at"),
    ).write.parquet(f"{folder}/watches")
    items = spark.range(4999).select(
        F.concat(F.lit("i"), "id").alias("item_id"), F.lit("movie").alias("type"), F.lit(30).alias("runtime_minutes"),
        F.lit("Drama").alias("genre_primary"), F.lit("en").alias("original_language"),
    )
    users = spark.range(5000).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit(30).alias("age"), F.lit("male").alias("gender")
    )
    items.write.parquet(f"{folder}/items")
    users.write.parquet(f"{folder}/users")
    return [spark.read.parquet(f"{folder}/{name}") for name in ("watches", "items", "users")]


JOINS = {
    "user report, hot item": lambda w, i, u: reports.watch_counts(w, i, u),
    "item report, hot user": lambda w, i, u: reports.completion_rate(w, i, u),
    "last watches, hot item": lambda w, i, u: reports.top_genre(w, i, u),
    "type ratio, hot item": lambda w, i, u: reports.type_ratio(w, i, u),
    "device and language, hot item": lambda w, i, u: reports.top_device_language(w, i, u),
    "live facts": lambda w, i, u: blocks.live_facts(w, i, u),
    "dead letters": lambda w, i, u: changes.split_valid(w, i, u)[0],
}


@pytest.mark.parametrize("case", JOINS)
def test_a_hot_join_key_is_split(spark, hot, case):
    """With no broadcast possible, adaptive execution splits the hot partition."""
    build = JOINS[case]
    plain = sorted(map(tuple, build(*hot).collect()), key=repr)
    with settings(spark, **{
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    }):
        split = build(*hot)
        got = sorted(map(tuple, split.collect()), key=repr)
        assert "skew=true" in plan_of(split, "simple")
    assert got == plain


def test_a_hot_key_shuffles_few_rows(spark, hot):
    """The steps that must see a whole key get it reduced: one row per key and
    length, slot or task, not one per record."""
    watches, items, users = hot
    lengths = watches.filter("item_id = 'i0'").groupBy("item_id", "watched_seconds").count()
    assert lengths.count() <= 3000
    rate = reports.completion_rate(watches, items, users).filter("item_id = 'i0'").first()
    assert rate.watch_count == watches.filter("item_id = 'i0'").count()


def _arrived(watches, items, users):
    dims = incremental.Changed("item_id", incremental.ITEM_COLUMNS, None, items), incremental.Changed("user_id", incremental.USER_COLUMNS, None, users)
    try:
        return incremental._with_attributes(watches, *[dim.arrived for dim in dims])
    finally:
        for dim in dims:
            dim.both.unpersist()


@pytest.mark.parametrize("build", [refresh._with_items, _arrived])
def test_a_hot_key_is_split_where_watches_get_the_columns_of_their_item(spark, hot, build):
    with settings(spark, **{
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    }):
        split = build(*hot)
        found = sorted(tuple(r[c] for c in hot[0].columns) for r in split.collect())
        assert plan_of(split, "simple").count("(skew=true)") == 2
    wanted = hot[0].join(hot[1], "item_id", "left_semi").join(hot[2], "user_id", "left_semi").select(*hot[0].columns)
    assert found == sorted(map(tuple, wanted.collect()))
