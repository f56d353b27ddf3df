"""Settling heartbeats into one record per watch, as they arrive."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.sessions import SESSION_GAP_SECONDS


def settle_stream(
    events: DataFrame,
    keys: Sequence[str] = ("user_id", "item_id"),
    ts: str = "session_ended_at",
    seq: str = "seq",
    gap_seconds: int = SESSION_GAP_SECONDS,
    delay: str = "0 seconds",
) -> DataFrame:
    """The latest record of every session, once the session has closed.

    Run it in append mode. A session closes when the watermark passes its last
    record by the gap; ``delay`` holds the watermark back to wait for late
    records, and should cover the lag between source partitions. State is held
    per key, and the session settings let each task merge its own records of a
    key before the shuffle.
    """
    rest = [name for name in events.columns if name not in (*keys, ts, seq)]
    return (
        events.withWatermark(ts, delay)
        .groupBy(*keys, F.session_window(ts, f"{gap_seconds} seconds"))
        .agg(F.max(F.struct(ts, seq, *rest)).alias("_last"))
        .select(*keys, *[f"_last.{name}" for name in rest], f"_last.{ts}")
    )


ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


@contextmanager
def no_tolerance(spark: SparkSession) -> Iterator[None]:
    """Streams started inside drop a record as late by the watermark of all batches before its own.

    By default Spark goes by the watermark one batch earlier, so that a record
    that follows the batch that closed its session is still merged. A stream
    keeps the setting it was first started with in its checkpoint. It allows one
    stateful operator per stream, which settling is.
    """
    before = spark.conf.get(ALLOW_MULTIPLE)
    spark.conf.set(ALLOW_MULTIPLE, "false")
    try:
        yield
    finally:
        spark.conf.set(ALLOW_MULTIPLE, before)
