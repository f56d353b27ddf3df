"""Reports kept by deltas against the same reports recomputed over all facts."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from data import NOW
from marquee.plans import reports
from marquee.sources import tables
from marquee.streaming import incremental, refresh

ITEMS = "item_id string, type string, runtime_minutes int, genre_primary string, original_language string"
USERS = "user_id string, age int, gender string"
RATINGS = "user_id string, item_id string, rating int, rated_at timestamp, seq bigint"
WATCHES = "user_id string, item_id string, watched_seconds int, device_type string, session_ended_at timestamp"
MINUTES = 60


def _item(rng, key):
    return (f"i{key}", rng.choice(["movie", "series"]), rng.choice([None, 1, 2]), rng.choice([None, "Drama", "Crime"]), rng.choice([None, "en", "de"]))


def _user(rng, key):
    return (f"u{key}", rng.choice([None, 20, 50]), rng.choice([None, "male", "female", "other", "nonbinary"]))


def _expected(spark, items, users, ratings, watches, as_of):
    items, users = spark.createDataFrame(items, ITEMS), spark.createDataFrame(users, USERS)
    ratings, watches = spark.createDataFrame(ratings, RATINGS), spark.createDataFrame(watches, WATCHES)
    return {
        "user_rating_avg": reports.rating_avg(ratings, None, None, "user_id"),
        "item_rating_avg": reports.rating_avg(ratings, None, None, "item_id"),
        "user_mood": reports.user_mood(ratings, None, None),
        "item_completion_rate": reports.completion_rate(watches, items, None),
        "item_viewer_demographics": reports.viewer_demographics(watches, None, users),
        "user_series_movie_ratio": reports.type_ratio(watches, items, None),
        "user_top_genre": reports.top_genre(watches, items, None),
        "user_top_device_language": reports.top_device_language(watches, items, None),
        "user_watch_count": reports.watch_counts(watches, None, None),
        "item_view_ranking": reports.view_ranking(watches, items, None, as_of, MINUTES),
        "item_rating_ranking": reports.rating_ranking(ratings, watches, items, None, as_of, MINUTES),
    }


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_reports_after_every_tick_equal_a_full_recompute(spark, tmp_path):
    """Ticks with deletes, keys created again, changed attributes, overwritten, late and tied ratings, rewatches, unknown keys."""
    rng, root = random.Random(1), str(tmp_path / "reports")
    items, users = {k: _item(rng, k) for k in range(6)}, {k: _user(rng, k) for k in range(8)}
    live_ratings, live_watches, seq = {}, [], 0
    for tick in range(5):
        if tick:
            for known, make in ((items, _item), (users, _user)):
                for key in rng.sample(sorted(known), 1):
                    del known[key]
                for key in rng.sample(range(9), 2):
                    known[key] = make(rng, key)
        if tick == 3:  # nothing new but the deletes
            new_ratings, new_watches = [], []
        else:
            moment = [NOW + timedelta(minutes=20 * tick - rng.randrange(30)) for _ in range(90)]
            new_watches = [(f"u{rng.choice([0, 0, 1, 2, 3, 4, 5, 6, 7])}", f"i{rng.randrange(7)}", rng.choice([50, 51, 102, 2039, 2040]),
                            rng.choice(["tv", "phone", "pc"]), t) for t in moment]
            new_ratings = []
            for t in moment[:60]:
                seq += 1
                late = rng.random() < 0.2
                new_ratings.append((f"u{rng.choice([0, 0, 1, 2, 3, 4, 5, 6, 7])}", f"i{rng.randrange(7)}", rng.randint(1, 5), t, max(0, seq - 50) * 1000 + seq if late else seq * 1000))
        ids = {r[0] for r in items.values()}, {r[0] for r in users.values()}
        live_watches = [w for w in live_watches + new_watches if w[1] in ids[0] and w[0] in ids[1]]
        for row in sorted(new_ratings, key=lambda r: r[4]):
            pair = row[:2]
            if row[1] in ids[0] and row[0] in ids[1] and (pair not in live_ratings or live_ratings[pair][4] <= row[4] or live_ratings[pair][1] not in ids[0]):
                live_ratings[pair] = row
        live_ratings = {p: r for p, r in live_ratings.items() if p[1] in ids[0] and p[0] in ids[1]}

        as_of = F.lit(NOW + timedelta(minutes=20 * tick))
        new = spark.createDataFrame(new_ratings, RATINGS), spark.createDataFrame(new_watches, WATCHES)
        dims = spark.createDataFrame(list(items.values()), ITEMS), spark.createDataFrame(list(users.values()), USERS)
        for _ in range(2):  # a retried tick changes nothing
            incremental.advance(root, tick, *dims, *new, as_of, parts=2, minutes=MINUTES)
        wanted = _expected(spark, list(items.values()), list(users.values()), list(live_ratings.values()), live_watches, as_of)
        for name, report in wanted.items():
            found = incremental.read_report(spark, root, name)
            assert found.columns == report.columns and [t for _, t in found.dtypes] == [t for _, t in report.dtypes], name
            assert _rows(found) == _rows(report), (tick, name)


def test_a_tick_that_fails_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    root, as_of = str(tmp_path / "reports"), F.lit(NOW)
    dims = spark.createDataFrame([("i1", "movie", 1, "Drama", "en")], ITEMS), spark.createDataFrame([("u1", 20, "male"), ("u2", 20, "male")], USERS)
    no_ratings = spark.createDataFrame([], RATINGS)

    def watch(user):
        return spark.createDataFrame([(user, "i1", 60, "tv", NOW)], WATCHES)

    incremental.advance(root, 0, *dims, no_ratings, watch("u1"), as_of, parts=2)
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "trends", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.advance(root, 1, *dims, no_ratings, watch("u2"), as_of, parts=2)
    assert incremental.read_report(spark, root, "user_watch_count").count() == 1
    assert incremental.stored_watches(spark, root).count() == 1  # the landed batch does not count yet
    incremental.advance(root, 1, *dims, no_ratings, watch("u2"), as_of, parts=2)
    assert incremental.read_report(spark, root, "user_watch_count").count() == 2
    assert incremental.read_report(spark, root, "item_completion_rate").first().watch_count == 2


def test_a_tick_without_deletes_reads_no_old_facts(spark, tmp_path, monkeypatch):
    root, as_of = str(tmp_path / "reports"), F.lit(NOW)
    items = spark.createDataFrame([("i1", "movie", 1, "Drama", "en"), ("i2", "movie", 1, "Drama", "en")], ITEMS)
    users = spark.createDataFrame([("u1", 20, "male")], USERS)
    ratings = spark.createDataFrame([("u1", "i1", 3, NOW, 1)], RATINGS)
    watches = spark.createDataFrame([("u1", "i1", 60, "tv", NOW), ("u1", "i2", 60, "tv", NOW)], WATCHES)
    incremental.advance(root, 0, items, users, ratings, watches, as_of, parts=2)
    reads, deltas = [], []
    stored, of_tick = incremental.stored_watches, incremental.watch_deltas
    monkeypatch.setattr(incremental, "stored_watches", lambda *a: reads.append(stored(*a)) or reads[-1])
    monkeypatch.setattr(incremental, "watch_deltas", lambda *a: deltas.append(of_tick(*a)) or deltas[-1])

    def sources(df):
        return {f for f in df.inputFiles() if "/watches/" in f}

    incremental.advance(root, 1, items, users, ratings, watches, as_of, parts=2)
    assert not reads and not sources(deltas[0][0])
    incremental.advance(root, 2, items.filter("item_id = 'i1'"), users, ratings.limit(0), watches.limit(0), as_of, parts=2)
    assert reads and sources(deltas[1][0])
    assert incremental.read_report(spark, root, "user_watch_count").collect() == [("u1", 1, 2)]


def test_a_tick_writes_only_the_parts_it_touches(spark, tmp_path):
    root, as_of = str(tmp_path / "reports"), F.lit(NOW)
    items = spark.createDataFrame([("i1", "movie", 1, "Drama", "en")], ITEMS)
    users = spark.createDataFrame([(f"u{k}", 20, "male") for k in range(40)], USERS)
    no_ratings = spark.createDataFrame([], RATINGS)
    incremental.advance(root, 0, items, users, no_ratings, spark.createDataFrame([(f"u{k}", "i1", 60, "tv", NOW) for k in range(40)], WATCHES), as_of, parts=4)
    before = tables.ledger(spark, root)["tables"]
    incremental.advance(root, 1, items, users, no_ratings, spark.createDataFrame([("u7", "i1", 60, "tv", NOW)], WATCHES), as_of, parts=4)
    after = tables.ledger(spark, root)["tables"]
    assert before["users"] == after["users"] and before["ratings"] == after["ratings"]
    for name in ("user_watch_count", "watched_pairs", "user_votes", "last_watches"):
        moved = {p for p in after[name]["parts"] if after[name]["parts"][p] != before[name]["parts"].get(p)}
        assert len(moved) == 1 and len(after[name]["parts"]) == 4, name


def test_small_cached_tables_have_few_partitions(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        items = spark.createDataFrame([("i1", "movie", 1, "Drama", "en")], ITEMS)
        users = spark.createDataFrame([(f"u{k}", 20, "male") for k in range(40)], USERS)
        tick = incremental.Tick(spark, str(tmp_path / "reports"), 0, items, users, tables.DIRECT, 2)
        sums = tick.hold(incremental.add_sums(None, users.selectExpr("user_id", "1L n"), ["user_id"], ["n"], "n"))
        assert sums.count() == 40 and sums.rdd.getNumPartitions() <= 8
        tick.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_what_a_watch_keeps_is_not_looked_up_again(spark, tmp_path, monkeypatch):
    root, as_of = str(tmp_path / "reports"), F.lit(NOW)
    items, users = [("i1", "movie", 1, "Drama", "en"), ("i2", "movie", 1, "Drama", "de")], spark.createDataFrame([("u1", 20, "male"), ("u2", 30, "male")], USERS)
    watches = spark.createDataFrame([("u1", "i1", 60, "tv", NOW), ("u1", "i2", 60, "pc", NOW - timedelta(minutes=1)), ("u2", "i2", 60, "pc", NOW)], WATCHES)
    no_ratings = spark.createDataFrame([], RATINGS)
    incremental.advance(root, 0, spark.createDataFrame(items, ITEMS), users, no_ratings, watches, as_of, parts=2)
    again, read = [], incremental.watches_of
    monkeypatch.setattr(incremental, "watches_of", lambda tick, of, landed: again.append({r.user_id for r in of.collect()}) or read(tick, of, landed))

    def tick(number, first):
        again.clear()
        incremental.advance(root, number, spark.createDataFrame([first, *items[1:]], ITEMS), users, no_ratings, watches.limit(0), as_of, parts=2)
        return {r.user_id: r[1:] for r in incremental.read_report(spark, root, "user_top_device_language").collect()}

    same = {"u1": ("tv", 1, "en", 1), "u2": ("pc", 1, "de", 1)}
    assert tick(1, ("i1", "movie", 100, "Crime", "en")) == same and again == [set(), set()]
    assert incremental.read_report(spark, root, "item_completion_rate").filter("item_id = 'i1'").first().completion_rate == 0
    assert tick(2, ("i1", "movie", 100, "Crime", "de")) == same | {"u1": ("tv", 1, "de", 2)} and again == [set(), set()]


def test_old_facts_are_read_once_and_few_keys_are_sent_to_them(spark, tmp_path):
    spark.createDataFrame([("u1", "i1", 60, "tv", NOW), ("u1", "i2", 60, "tv", NOW), ("u2", "i2", 60, "tv", NOW), ("u3", None, 60, "tv", NOW), (None, "i2", 60, "tv", NOW)], WATCHES).write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    old, new = (spark.createDataFrame(rows, USERS) for rows in ([("u1", 20, "male"), ("u2", 20, "male"), ("u3", 5, "male")], [("u1", 30, "male"), ("u2", 20, "male")]))
    items = spark.createDataFrame([("i1", "movie", 1, "Drama", "en"), ("i2", "movie", 1, "Drama", "en")], ITEMS)
    users, items = incremental.Changed("user_id", incremental.USER_COLUMNS, old, new), incremental.Changed("item_id", incremental.ITEM_COLUMNS, items, items.filter("item_id = 'i1'"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = incremental._of_keys(facts, items.rows, users.rows)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FileScan parquet") == 1 and plan.count("BroadcastHashJoin") == 2
        assert sorted(((r.user_id, r.item_id) for r in found.collect()), key=repr) == [("u1", "i1"), ("u1", "i2"), ("u2", "i2"), ("u3", None), (None, "i2")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        users.both.unpersist()
        items.both.unpersist()


def test_reports_follow_a_stream(spark, tmp_path):
    items = spark.createDataFrame([("i1", "movie", 1, "Drama", "en")], ITEMS)
    users = spark.createDataFrame([("u1", 20, "male")], USERS)
    schema = f"rating struct<{RATINGS.replace(' ', ':').replace(',:', ',')}>, watch struct<{WATCHES.replace(' ', ':').replace(',:', ',')}>"
    root = str(tmp_path / "reports")
    for row in ((("u1", "i1", 2, NOW, 1), None), (None, ("u1", "i1", 60, "tv", NOW)), (("u1", "i1", 5, NOW, 2), None)):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        job = refresh.refresh_increments(stream, lambda: items, lambda: users, root, f"{tmp_path}/checkpoint", lambda: F.lit(NOW), parts=2)
        job.trigger(availableNow=True).start().awaitTermination()
    assert incremental.read_report(spark, root, "user_mood").first().mood == "good"
    assert incremental.read_report(spark, root, "user_watch_count").first().total_watches == 1
