import pytest
from pyspark.sql import functions as F

from data import NOW, items, ratings, users
from marquee.operators import blocks, changes
from marquee.schemas import struct
from marquee.sources import tables
from marquee.streaming import mirror


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_envelopes_to_current_state(spark):
    raw = spark.createDataFrame(
        [
            ("db.public.item", '{"item_id":"i1"}', '{"before":null,"after":{"item_id":"i1","title":"a"}}', 1),
            ("db.public.item", '{"item_id":"i1"}', '{"after":{"item_id":"i1","title":"b"}}', 3),
            ("db.public.item", '{"item_id":"i1"}', '{"after":{"item_id":"i1","title":"late"}}', 2),
            ("db.public.item", '{"item_id":"i2"}', '{"after":{"item_id":"i2","title":"c"}}', 1),
            ("db.public.item", '{"item_id":"i2"}', None, 2),
            ("db.public.item", '{"item_id":"i3"}', '{"after":{"item_id":"i3","title":"d"}}', 1),
            ("db.public.item", '{"item_id":"i3"}', '{"before":{"item_id":"i3"},"after":null}', 2),
            ("db.public.item", '{"item_id":"i3"}', '{"after":{"item_id":"i3","title":"back"}}', 4),
            ("db.public.app_user", '{"user_id":"u1"}', '{"after":{"user_id":"u1"}}', 1),
        ],
        "origin string, key string, value string, seq int",
    )
    routed = changes.route(raw, r"^db\.public\.item$")
    decoded = changes.decode_changes(routed, struct("item_id string"), struct("item_id string, title string"))
    flat = changes.unwrap_changes(decoded, ["item_id"])
    assert flat.filter("is_delete").count() == 2
    assert rows(changes.current_state(flat, ["item_id"])) == [("i1", "b"), ("i3", "back")]


def test_latest_rating_is_the_last_to_arrive(spark):
    events = spark.createDataFrame(
        [("u1", "i1", 5, "late date", 1), ("u1", "i1", 2, "early date", 2), ("u2", "i1", None, "x", 9)],
        "user_id string, item_id string, rating int, rated_at string, seq int",
    )
    got = changes.latest_by_key(events, ["user_id", "item_id"], "seq").select("user_id", "rating")
    assert rows(got) == [("u1", 2), ("u2", None)]


def test_tombstones_are_not_appended(spark):
    records = spark.createDataFrame([((1, "a"),), (None,), ((1, "a"),)], "value struct<n:int, s:string>")
    assert rows(changes.append_mirror(records)) == [(1, "a"), (1, "a")]


def test_ghost_references_become_dead_letters(spark):
    facts = ratings(
        spark, ("u1", "i1", 5, NOW), ("ghost", "i1", 5, NOW), ("u1", "ghost", 5, NOW), ("ghost", "ghost", 5, NOW)
    )
    ok, dead = changes.split_valid(facts, items(spark, ("i1",)), users(spark, ("u1",)))
    assert rows(ok.select("user_id", "item_id")) == [("u1", "i1")]
    assert rows(dead.select("user_id", "item_id", "error_reason")) == [
        ("ghost", "ghost", "unknown item and user"), ("ghost", "i1", "unknown user"), ("u1", "ghost", "unknown item"),
    ]
    live = blocks.live_facts(facts, items(spark, ("i1",)), users(spark, ("u1",)))
    assert rows(live) == rows(ok)


def test_stale_keys_and_deletes(spark):
    mirror = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "item_id string")
    source = spark.createDataFrame([("i2",)], "item_id string")
    assert rows(changes.stale_tombstones(mirror, source, "item_id")) == [("i1", None), ("i3", None)]
    wanted = spark.createDataFrame([("i2",), ("i2",), ("i9",)], "item_id string")
    left, gone = changes.delete_keys(mirror, wanted, "item_id")
    assert rows(left) == [("i1",), ("i3",)] and rows(gone) == [("i2", True)]


def test_clearing_keeps_nulls_and_other_values(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "a"), (3, "c", None)], "id int, x string, y string")
    assert rows(changes.clear_values(df, ["x", "y"], ["a"])) == [(1, None, "b"), (2, None, None), (3, "c", None)]


def test_unload_keeps_rows_without_source(spark):
    df = spark.createDataFrame([("i1", "p"), ("i2", None), ("i3", "q")], "item_id string, seed_source string")
    assert rows(changes.unload_source(df, "p").select("item_id")) == [("i2",), ("i3",)]
    log = spark.createDataFrame([("p",), ("p:items",), ("p:users",), ("pq",)], "seed_name string")
    assert rows(changes.forget_source(log, "p")) == [("pq",)]


def test_full_sync_compares_nulls_as_equal(spark):
    schema = "k string, a int, b int"
    target = spark.createDataFrame([("same", 1, None), ("new value", 1, None), ("gone", 1, 1), ("nulled", 1, 1)], schema)
    result = spark.createDataFrame([("same", 1, None), ("new value", 1, 2), ("added", None, None), ("nulled", 1, None)], schema)
    assert rows(changes.full_sync(target, result, "k").select("k", "action")) == [
        ("added", "insert"), ("gone", "delete"), ("new value", "update"), ("nulled", "update"),
    ]


def test_retention_includes_the_edge(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-01-01 00:00:00', timestamp'2023-12-31 23:59:59')) AS ts")
    assert changes.retain(df, "ts", F.lit("2024-01-03").cast("timestamp")).count() == 1


def test_published_tables(spark, tmp_path):
    root = str(tmp_path / "table")
    assert tables.latest(spark, root) is None
    tables.publish(spark.range(3), root, 1)
    tables.publish(spark.range(5), root, 2)
    assert tables.latest(spark, root).count() == 5
    tables.publish(spark.range(9), root, 2)  # a retried batch that was already current
    assert tables.latest(spark, root).count() == 5
    spark.range(7).write.parquet(f"{root}/data/version=3")  # written, but never made current
    assert tables.latest(spark, root).count() == 5
    tables.publish(spark.range(8), root, 3)
    assert tables.latest(spark, root).count() == 8


def test_a_writer_that_loses_a_race_keeps_its_batch_after_a_retry(spark, tmp_path, monkeypatch):
    """Writer B looks at the table before A publishes, and comes to its ledger entry after A."""
    root = f"{tmp_path}/table"
    tables.publish(spark.range(1), root, 1, "a")
    create = tables._create

    def late(*args):
        monkeypatch.setattr(tables, "_create", create)
        tables.publish(spark.range(2), root, 2, "a")
        return create(*args)

    monkeypatch.setattr(tables, "_create", late)
    with pytest.raises(tables.Conflict):
        tables.publish(spark.range(3), root, 1, "b")
    assert tables.latest(spark, root).count() == 2  # A's rows are current, nothing of B counts
    assert not tables.is_published(spark, root, 1, "b")
    tables.publish(spark.range(3), root, 1, "b")
    assert tables.latest(spark, root).count() == 3
    assert tables.is_published(spark, root, 2, "a") and tables.is_published(spark, root, 1, "b")


def test_two_writers_of_parts_keep_both_batches(spark, tmp_path, monkeypatch):
    root, schema = f"{tmp_path}/items", "item_id string, title string, is_delete boolean, seq long"

    def apply(row, writer):
        mirror.apply_changes(root, spark.createDataFrame([row], schema), ["item_id"], 1, writer, parts=2)

    create = tables._create

    def late(*args):
        monkeypatch.setattr(tables, "_create", create)
        apply(("i1", "a", False, 1), "a")
        return create(*args)

    monkeypatch.setattr(tables, "_create", late)
    with pytest.raises(tables.Conflict):
        apply(("i2", "b", False, 1), "b")
    apply(("i2", "b", False, 1), "b")
    assert sorted(tuple(r) for r in mirror.read_state(spark, root).collect()) == [("i1", "a"), ("i2", "b")]


def test_tables_published_together_change_together(spark, tmp_path):
    root = f"{tmp_path}/tables"
    part = tables.with_part(spark.range(8), ["id"], 4)
    tables.publish_all(spark, {"a": spark.range(1), "b": tables.Parts(part, range(4), 4)}, root, 1)
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.publish_all(spark, {"a": spark.range(5), "b": broken}, root, 2)
    assert tables.latest(spark, root, name="a").count() == 1
    tables.publish_all(spark, {"b": tables.Parts(part.filter("_part = 1 and id < 0"), [1], 4)}, root, 2)
    kept = sorted(r.id for r in tables.latest(spark, root, name="b").collect())
    assert kept == sorted(r.id for r in part.filter("_part != 1").collect())
    assert tables.latest(spark, root, name="a").count() == 1 and tables.latest(spark, root, name="c") is None
