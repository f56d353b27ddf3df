import random
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import data
from data import NOW
from marquee import registry
from marquee.operators import quality
from marquee.plans import reports
from marquee.schemas import struct
from marquee.sources import files, tables
from marquee.streaming import mirror, refresh


def run(writer):
    job = writer.trigger(availableNow=True).start()
    job.awaitTermination()


def test_state_follows_its_changes(spark, tmp_path):
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"
    batches = [
        [("i1", "a", False, 1), ("i2", "b", False, 2)],
        [("i1", "a2", False, 4), ("i1", "a1", False, 3), ("i2", None, True, 5)],
        [("i2", "revived too late", False, 2), ("i3", "c", False, 6)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = files.read_stream(spark, f"{tmp_path}/in", schema, max_files_per_trigger=1)
        run(mirror.mirror_state(source, root, ["item_id"], f"{tmp_path}/checkpoint"))
    state = mirror.read_state(spark, root)
    assert sorted(tuple(r) for r in state.collect()) == [("i1", "a2"), ("i3", "c")]


def test_reconciling_deletes_orphans(spark, tmp_path):
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"
    rows = [("i1", "a", False, 1), ("i2", "b", False, 2), ("i3", None, True, 3)]
    mirror.apply_changes(root, spark.createDataFrame(rows, schema), ["item_id"], 1)
    source = spark.createDataFrame([("i2",), ("i3",)], "item_id string")
    deletes = mirror.reconcile(tables.latest(spark, root), source, "item_id")
    # the delete comes right after the row it deletes, and before any later change
    assert [tuple(r) for r in deletes.collect()] == [("i1", True, 1, True)]
    mirror.apply_changes(root, deletes, ["item_id"], 2)
    assert [tuple(r) for r in mirror.read_state(spark, root).collect()] == [("i2", "b")]


def test_a_change_after_the_deleted_row_survives_reconciling(spark, tmp_path):
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"
    rows = [("i1", "a", False, 1), ("i2", "b", False, 9)]
    mirror.apply_changes(root, spark.createDataFrame(rows, schema), ["item_id"], 1)
    none = spark.createDataFrame([("i2",)], "item_id string")
    mirror.apply_changes(root, mirror.reconcile(tables.latest(spark, root), none, "item_id"), ["item_id"], 1, "reconcile")
    again = spark.createDataFrame([("i1", "back", False, 2)], schema)
    mirror.apply_changes(root, again, ["item_id"], 2)
    assert sorted(tuple(r) for r in mirror.read_state(spark, root).collect()) == [("i1", "back"), ("i2", "b")]


def test_a_batch_rewrites_only_the_parts_of_its_keys(spark, tmp_path):
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"
    rows = [(f"i{n}", "old", False, n) for n in range(40)]
    mirror.apply_changes(root, spark.createDataFrame(rows, schema), ["item_id"], 1, parts=4)
    mirror.apply_changes(root, spark.createDataFrame([("i7", "new", False, 99)], schema), ["item_id"], 2, parts=4)
    written = {f.parent.parent.name.split("-")[0]: set() for f in tmp_path.glob("items/data/*/*/*.parquet")}
    for f in tmp_path.glob("items/data/*/*/*.parquet"):
        written[f.parent.parent.name.split("-")[0]].add(f.parent.name)
    assert len(written["version=1"]) == 4 and len(written["version=2"]) == 1
    state = {r.item_id: r.title for r in mirror.read_state(spark, root).collect()}
    assert len(state) == 40 and [k for k, v in state.items() if v == "new"] == ["i7"]
    with pytest.raises(ValueError):
        mirror.apply_changes(root, spark.createDataFrame(rows[:1], schema), ["item_id"], 3, parts=8)


def test_old_deletes_expire_and_empty_parts_can_be_read(spark, tmp_path):
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"

    def apply(batch, *rows, **more):
        mirror.apply_changes(root, spark.createDataFrame(list(rows), schema), ["item_id"], batch, parts=1, **more)

    apply(0)
    assert mirror.read_state(spark, root).collect() == []
    apply(1, ("i1", None, True, 1))
    assert tables.latest(spark, root).count() == 1
    apply(2, ("i2", None, True, 2), keep_deletes=timedelta(days=-1))
    assert tables.latest(spark, root).count() == 0
    apply(3, ("i3", "c", False, 3))
    assert [tuple(r) for r in mirror.read_state(spark, root).collect()] == [("i3", "c")]


def test_no_writer_hides_another(spark, tmp_path):
    """A stream, a reconciliation, the stream again and a stream with a new checkpoint all use small batch numbers."""
    schema = struct("item_id string, title string, is_delete boolean, seq long")
    root = f"{tmp_path}/items"

    def stream(row, source, checkpoint):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{source}")
        records = files.read_stream(spark, f"{tmp_path}/{source}", schema, max_files_per_trigger=1)
        run(mirror.mirror_state(records, root, ["item_id"], f"{tmp_path}/{checkpoint}"))

    stream(("i1", "a", False, 1), "in", "c1")
    kept = spark.createDataFrame([("i9",)], "item_id string")
    mirror.apply_changes(root, mirror.reconcile(tables.latest(spark, root), kept, "item_id"), ["item_id"], 1, "reconcile")
    stream(("i2", "b", False, 10), "in", "c1")
    stream(("i3", "c", False, 11), "other", "c2")
    assert sorted(tuple(r) for r in mirror.read_state(spark, root).collect()) == [("i2", "b"), ("i3", "c")]


def test_two_writers_append_the_same_batch_number(spark, tmp_path):
    rows = [data.ratings(spark, ("u1", item, 5, NOW)) for item in ("i1", "i2")]
    tables.append_batch(rows[0], f"{tmp_path}/facts", 0, "rated_at", "one")
    tables.append_batch(rows[1], f"{tmp_path}/facts", 0, "rated_at", "two")
    tables.append_batch(rows[1], f"{tmp_path}/facts", 0, "rated_at", "two")  # a retry
    landed = tables.appended(spark, f"{tmp_path}/facts")
    assert sorted(r.item_id for r in landed.collect()) == ["i1", "i2"] and "day" in landed.columns


def test_a_table_of_empty_batches_has_no_rows(spark, tmp_path):
    assert tables.appended(spark, f"{tmp_path}/dead") is None
    tables.append_batch(data.ratings(spark, ("u1", "i1", 5, NOW)).limit(0), f"{tmp_path}/dead", 0, "rated_at")
    assert tables.appended(spark, f"{tmp_path}/dead").collect() == []


def test_facts_land_or_become_dead_letters(spark, tmp_path):
    schema = data.ratings(spark, ("u1", "i1", 5, NOW)).schema
    known_items = {"ids": [("i1",)]}
    people = data.users(spark, ("u1",))
    rows = [("u1", "i1", 5, NOW), ("u1", "i2", 4, NOW), ("u1", "i1", 9, NOW), ("ghost", "i1", 1, NOW)]
    for attempt in range(2):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = files.read_stream(spark, f"{tmp_path}/in", schema, max_files_per_trigger=1)
        run(mirror.mirror_facts(
            source, lambda: data.items(spark, *known_items["ids"]), lambda: people, f"{tmp_path}/ok",
            f"{tmp_path}/dead", f"{tmp_path}/checkpoint", "rated_at", lambda: quality.rating_rules(F.lit(NOW)),
        ))
        known_items["ids"].append(("i2",))  # arrives after the first batch
    landed = tables.appended(spark, f"{tmp_path}/ok")
    assert sorted(r.item_id for r in landed.collect()) == ["i1", "i1", "i2"]
    dead = tables.appended(spark, f"{tmp_path}/dead")
    assert sorted(r.error_reason for r in dead.collect()) == [
        "rating out of range", "rating out of range", "unknown item", "unknown user", "unknown user",
    ]


def test_a_tick_writes_every_report_and_skips_missing_sources(spark, tmp_path):
    sources = {
        "items": data.items(spark, ("i1", "movie", 100, "Drama", "en")),
        "users": data.users(spark, ("u1", 30, "female")),
        "ratings": None,
        "watch_events": data.watches(spark, ("u1", "i1", 6000, "mobile", NOW)),
    }
    root = str(tmp_path)
    written = refresh.run_tick(sources, root, 1, F.lit(NOW))
    assert "user_mood" not in written and "user_top_genre" in written and "item_view_ranking" not in written
    sources["ratings"] = data.ratings(spark, ("u1", "i1", 5, NOW))
    assert refresh.run_tick(sources, root, 2, F.lit(NOW)) == list(refresh.REPORTS)
    assert tables.latest(spark, f"{root}/item_rating_ranking").first().avg_rating == 5
    sources["items"] = sources["items"].limit(0)
    refresh.run_tick(sources, root, 3, F.lit(NOW))
    assert all(tables.latest(spark, f"{root}/{name}").isEmpty() for name in refresh.REPORTS)


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for folder in folders for f in Path(folder.getPath()).glob("*/shuffle_*.data")}


def test_a_tick_leaves_no_shuffle_files_and_joins_items_once(spark, tmp_path):
    """Of an item that comes twice each row counts, as where every report joins the items itself; a watch counts once."""
    items = data.items(spark, ("i1", "movie", 100, "Drama", "en"), ("i1", "series", 100, "Crime", "de"), ("i2", "movie", 10, "Drama", "en"), ("i4", "movie"))
    users = data.users(spark, ("u1", 30, "female"), ("u2", 40, "male"), ("u4",))
    watches = data.watches(
        spark, ("u1", "i1", 6000, "mobile", NOW), ("u1", "i2", 60, "tv", NOW - timedelta(minutes=1)), ("u2", "i2", 6000, "tv", NOW),
        ("u3", "i2", 60, "tv", NOW), ("u1", "i3", 60, "tv", NOW), (None, "i2", 60, "tv", NOW), ("u1", None, 60, "tv", NOW))
    ratings = data.ratings(spark, *[(f"u{k % 3}", f"i{k}", k % 5, NOW) for k in range(9)])
    wanted = {
        "item_completion_rate": reports.completion_rate(watches, items, users), "user_series_movie_ratio": reports.type_ratio(watches, items, users),
        "user_top_genre": reports.top_genre(watches, items, users), "user_top_device_language": reports.top_device_language(watches, items, users),
        "user_watch_count": reports.watch_counts(watches, items, users), "item_viewer_demographics": reports.viewer_demographics(watches, items, users),
        "user_mood": reports.user_mood(ratings, items, users), "item_view_ranking": reports.view_ranking(watches, items, users, F.lit(NOW)),
        "item_rating_ranking": reports.rating_ranking(ratings, watches, items, users, F.lit(NOW)),
    }
    rows = {name: (report.columns, sorted(map(tuple, report.collect()), key=repr)) for name, report in wanted.items()}
    before = _shuffle_files(spark)
    refresh.run_tick({"items": items, "users": users, "ratings": ratings, "watch_events": watches}, str(tmp_path), 1, F.lit(NOW))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    for name, (columns, content) in rows.items():
        found = tables.latest(spark, f"{tmp_path}/{name}")
        assert found.columns == columns and sorted(map(tuple, found.collect()), key=repr) == content, name


def test_refresh_runs_on_a_clock(spark, tmp_path):
    sources = {
        "items": data.items(spark, ("i1",)), "users": data.users(spark, ("u1",)),
        "ratings": data.ratings(spark, ("u1", "i1", 5, NOW)), "watch_events": None,
    }
    spark.range(1).write.parquet(f"{tmp_path}/clock")
    clock = spark.readStream.schema("id long").parquet(f"{tmp_path}/clock")
    run(refresh.refresh(clock, lambda _: sources, f"{tmp_path}/reports", f"{tmp_path}/checkpoint"))
    assert tables.latest(spark, f"{tmp_path}/reports/user_mood").first().mood == "good"


@pytest.mark.parametrize("key", ["user_id", "item_id"])
def test_incremental_averages_equal_a_full_recompute(spark, key):
    rng = random.Random(3)
    schema = "user_id string, item_id string, rating int, seq long"
    history = [
        (f"u{rng.choice([0, 0, 0, 1, 2, 3])}", f"i{rng.randrange(5)}", rng.randint(1, 5), n) for n in range(120)
    ]
    rng.shuffle(history)  # batches may hold records older than those already seen
    known = spark.createDataFrame([], schema)
    state = spark.createDataFrame([], f"{key} string, rating_sum long, rating_count long")
    for start in range(0, 120, 60):
        batch = spark.createDataFrame(history[start:start + 60], schema)
        deltas, known = mirror.rating_deltas(known, batch)
        state = mirror.update_averages(state, deltas, key)
    removed = known.filter("item_id = 'i4'")
    state = mirror.update_averages(state, mirror.removal_deltas(removed), key)
    got = {r[key]: (r.avg_rating, r.rating_count) for r in mirror.averages(state, key).collect()}

    latest = {}
    for user, item, rating, seq in sorted(history, key=lambda r: r[3]):
        latest[user, item] = rating
    expected = {}
    for (user, item), rating in latest.items():
        if item != "i4":
            expected.setdefault(user if key == "user_id" else item, []).append(rating)
    assert got == {k: (sum(v) / len(v), len(v)) for k, v in expected.items()}


def test_a_delete_removes_facts_on_the_next_tick(spark):
    rated = data.ratings(spark, ("u1", "i1", 5, NOW), ("u1", "i2", 1, NOW - timedelta(minutes=1)))
    people = data.users(spark, ("u1",))
    both = reports.user_mood(rated, data.items(spark, ("i1",), ("i2",)), people).first()
    one = reports.user_mood(rated, data.items(spark, ("i1",)), people).first()
    assert (both.mood, one.mood) == ("bad", "good")


def test_a_shared_log_is_not_cached_whole(spark, tmp_path, monkeypatch):
    key, row = T.StructType.fromDDL("item_id string"), T.StructType.fromDDL("item_id string, title string")
    value = '{"before": null, "after": {"item_id": "%s", "title": "%s"}}'
    records = [("a.item", '{"item_id": "i1"}', value % ("i1", "old"), 1), ("a.item", '{"item_id": "i1"}', value % ("i1", "new"), 2),
               ("a.other", '{"item_id": "i9"}', value % ("i9", "x"), 3), ("a.item", '{"item_id": "i2"}', None, 4)]
    spark.createDataFrame(records, "origin string, key string, value string, seq bigint").write.parquet(f"{tmp_path}/in")
    cached, route = [], mirror.route
    monkeypatch.setattr(mirror, "route", lambda raw, *rest: cached.append(raw.storageLevel.useMemory) or route(raw, *rest))
    targets = [mirror.Target(rf"\.{name}$", key, row, f"{tmp_path}/{name}") for name in ("item", "other")]
    source = spark.readStream.schema("origin string, key string, value string, seq bigint").parquet(f"{tmp_path}/in")
    mirror.mirror_log(source, targets, f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    # a text in memory takes many times the room of its compressed file, and a task would read its whole file's
    assert cached == [False, False]
    assert [tuple(r) for r in mirror.read_state(spark, f"{tmp_path}/item").collect()] == [("i1", "new")]
    assert [tuple(r) for r in mirror.read_state(spark, f"{tmp_path}/other").collect()] == [("i9", "x")]


def test_rankings_do_not_build_undated_facts_again(spark, tmp_path):
    items, users = data.items(spark, ("i1",)), data.users(spark, ("u1",))
    ratings, watches = data.ratings(spark, ("u1", "i1", 5, NOW)), data.watches(spark, ("u1", "i1", 60, "mobile", NOW))
    costly = [df.withColumn("user_id", F.raise_error(F.lit("built again")).cast("string")) for df in (ratings, watches)]
    tick = refresh.Tick(items, users, *costly, ratings, watches, F.lit(NOW))
    assert refresh.RANKINGS["item_rating_ranking"](tick).first().avg_rating == 5
    assert refresh.RANKINGS["item_view_ranking"](tick).first().view_count == 1


def test_late_heartbeats_play_from_as_many_files_as_their_number_asks_for(spark, tmp_path, monkeypatch):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    spark.range(40).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 3 AS user_id",
        "'e' AS event_type", "double(id) AS value", "'' AS props").write.parquet(f"{tmp_path}/events.parquet")

    def played():
        before = set(folder.glob("late-*"))
        rows = sorted(map(tuple, registry.QUERIES["settle_stream_late"](spark, str(tmp_path)).collect()))
        root, = set(folder.glob("late-*")) - before
        return rows, len(list(root.glob("in/*.parquet")))

    few = played()
    monkeypatch.setattr(registry, "LATE_FILE_ROWS", 10)
    many = played()
    assert (few[1], many[1]) == (16, 32) and few[0] == many[0]
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "true"
