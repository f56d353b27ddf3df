import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from data import items
from marquee.operators import sessions
from marquee.schemas import struct
from marquee.streaming.settle import settle_stream

BASE = datetime(2026, 8, 16, 10, 0, 0)
BEATS = struct(
    "user_id string, item_id string, watched_seconds integer, device_type string, "
    "session_ended_at timestamp, seq long"
)


def beats(*rows):
    """Rows are (user, item, watched, device, seconds after the base)."""
    return [(u, i, w, d, BASE + timedelta(seconds=t), n) for n, (u, i, w, d, t) in enumerate(rows)]


def settled(df):
    found = df.select("user_id", "watched_seconds", "device_type", "session_ended_at").collect()
    return sorted((r[0], r[1], r[2], (r[3] - BASE).total_seconds()) for r in found)


CASES = {
    "single": (
        [("u1", "i1", 120, "mobile", 0), ("u2", "i2", 1, "mobile", 15)],
        [("u1", 120, "mobile", 0)],
    ),
    "out of order": (
        [("u1", "i1", 90, "smart_tv", 5), ("u1", "i1", 60, "mobile", 0), ("u2", "i2", 1, "mobile", 20)],
        [("u1", 90, "smart_tv", 5)],
    ),
    "two sessions": (
        [("u1", "i1", 60, "mobile", 0), ("u1", "i1", 90, "mobile", 30), ("u9", "i9", 1, "mobile", 60)],
        [("u1", 60, "mobile", 0), ("u1", 90, "mobile", 30)],
    ),
    "still active": ([("u1", "i1", 30 * n, "mobile", 3 * n) for n in range(5)], []),
    "bridge": (
        [("u1", "i1", 10, "mobile", 0), ("u1", "i1", 20, "tablet", 8), ("u1", "i1", 30, "desktop", 15),
         ("u2", "i2", 1, "mobile", 35)],
        [("u1", 30, "desktop", 15)],
    ),
    "gap is inclusive": (
        [("u1", "i1", 1, "mobile", 0), ("u1", "i1", 2, "mobile", 10), ("u1", "i1", 3, "mobile", 20.001),
         ("u2", "i2", 1, "mobile", 60)],
        [("u1", 2, "mobile", 10), ("u1", 3, "mobile", 20.001)],
    ),
    "equal times": (
        [("u1", "i1", 9, "tablet", 0), ("u1", "i1", 1, "mobile", 0), ("u2", "i2", 1, "mobile", 60)],
        [("u1", 1, "mobile", 0)],
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_batch(spark, case):
    rows, expected = CASES[case]
    events = spark.createDataFrame(beats(*rows), BEATS)
    newest = events.agg(F.max("session_ended_at")).scalar()
    assert settled(sessions.settle_sessions(events, closed_by=newest)) == expected


def _stream(spark, folder, batches, **options):
    """Settle the batches, one file and one run each; returns the settled rows."""
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, BEATS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(BEATS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        job = (
            settle_stream(source, **options).writeStream.outputMode("append").trigger(availableNow=True)
            .option("checkpointLocation", f"{folder}/checkpoint").start(f"{folder}/out", format="parquet")
        )
        job.awaitTermination()
    return spark.read.schema(BEATS).parquet(f"{folder}/out")


@pytest.mark.parametrize("case", ["single", "out of order", "two sessions", "still active", "bridge", "equal times"])
def test_stream(spark, tmp_path, case):
    rows, expected = CASES[case]
    assert settled(_stream(spark, tmp_path, [beats(*rows)])) == expected


def test_stream_drops_a_record_later_than_its_closed_session(spark, tmp_path):
    rows = beats(
        ("a", "i", 1, "mobile", 0), ("b", "i", 2, "mobile", 15), ("a", "i", 3, "mobile", 4), ("c", "i", 4, "mobile", 100)
    )
    got = settled(_stream(spark, tmp_path, [[row] for row in rows]))
    assert got == [("a", 1, "mobile", 0), ("b", 2, "mobile", 15)]


def test_batch_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (f"u{rng.choice([0, 0, 0, 1, 2])}", f"i{rng.randrange(2)}", n, "mobile", round(rng.uniform(0, 2000), 3))
        for n in range(600)
    ]
    events = beats(*rows)
    expected = []
    keys = {row[:2] for row in events}
    for key in keys:
        ordered = sorted((row[4], row[5], row) for row in events if row[:2] == key)
        for (at, _, row), following in zip(ordered, [*ordered[1:], None]):
            if following is None or following[0] - at > timedelta(seconds=10):
                expected.append((row[0], row[2], row[3], (at - BASE).total_seconds()))
    got = settled(sessions.settle_sessions(spark.createDataFrame(events, BEATS)))
    assert got == sorted(expected)


def test_slots_before_the_epoch(spark):
    early = [("u1", "i1", n, "mobile", datetime(1969, 12, 31, 23, 59, 55) + timedelta(seconds=n * 8), n) for n in range(4)]
    got = sessions.settle_sessions(spark.createDataFrame(early, BEATS)).collect()
    assert [r.watched_seconds for r in got] == [3]


def test_open_sessions_and_free_users(spark):
    rows = beats(("u1", "i1", 1, "mobile", 0), ("u1", "i2", 2, "mobile", 5), ("u2", "i1", 3, "mobile", -10), ("u3", "i1", 4, "mobile", -5))
    as_of = F.lit(BASE)
    open_now = sessions.open_sessions(spark.createDataFrame(rows, BEATS), as_of)
    assert sorted((r.user_id, r.item_id) for r in open_now.collect()) == [("u1", "i2"), ("u3", "i1")]
    everyone = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "user_id string")
    assert [r.user_id for r in sessions.free_users(everyone, open_now).collect()] == ["u2"]


def test_target_seconds(spark):
    catalogue = items(spark, ("a", "movie", 90), ("b", "movie", 0), ("c", "movie", None), ("d", "series", 50))
    got = {r.item_id: r.target_seconds for r in sessions.target_seconds(catalogue).collect()}
    assert got == {"a": 5400, "b": 2400, "c": 2400, "d": 2400}
