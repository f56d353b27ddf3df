"""Watch sessions over bounded tables, and what is being watched right now."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SESSION_GAP_SECONDS = 10
EPISODE_SECONDS = 2400


def _micros(ts: str | Column) -> Column:
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def settle_sessions(
    events: DataFrame,
    keys: Sequence[str] = ("user_id", "item_id"),
    ts: str = "session_ended_at",
    seq: str = "seq",
    gap_seconds: int = SESSION_GAP_SECONDS,
    closed_by: Column | None = None,
) -> DataFrame:
    """The latest record of every session; a pause longer than the gap ends one.

    Records are first reduced to one row per key and gap-wide time slot: two
    records in one slot are always in the same session. That step combines on
    the map side, so a hot key reaches the ordering step with at most one row
    per slot of the time it spans, however many records it has.

    With ``closed_by`` (the newest time seen), sessions that could still grow
    are held back.
    """
    gap = gap_seconds * 1_000_000
    rest = [name for name in events.columns if name not in (*keys, seq)]
    slots = (
        events.withColumn("_at", _micros(ts))
        .groupBy(*keys, F.floor(F.col("_at") / F.lit(gap)).alias("_slot"))
        .agg(F.min("_at").alias("_first"), F.max(F.struct("_at", seq, *rest)).alias("_last"))
    )
    upcoming = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slot"))
    pause = F.col("_next") - F.col("_last._at")
    settled = slots.withColumn("_next", upcoming).filter(F.col("_next").isNull() | (pause > gap))
    if closed_by is not None:
        settled = settled.filter(F.col("_last._at") + gap <= _micros(closed_by))
    return settled.select(*keys, *[F.col(f"_last.{name}").alias(name) for name in rest])


def open_sessions(
    events: DataFrame,
    as_of: Column,
    ts: str = "session_ended_at",
    seq: str = "seq",
    gap_seconds: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """The newest heartbeat of every user heard from within the gap before ``as_of``."""
    recent = events.filter(F.col(ts) > as_of - F.make_dt_interval(secs=F.lit(gap_seconds)))
    rest = [name for name in events.columns if name not in ("user_id", ts, seq)]
    return (
        recent.groupBy("user_id")
        .agg(F.max(F.struct(ts, seq, *rest)).alias("_last"))
        .select("user_id", f"_last.{ts}", *[f"_last.{name}" for name in rest])
    )


def free_users(users: DataFrame, open_now: DataFrame) -> DataFrame:
    """Users without an open session."""
    return users.select("user_id").join(open_now.select("user_id"), "user_id", "left_anti")


def target_seconds(items: DataFrame) -> DataFrame:
    """Expected length: a movie's runtime when it has one, else one episode."""
    has_runtime = (F.col("type") == "movie") & (F.col("runtime_minutes") != 0)
    seconds = F.when(has_runtime, F.col("runtime_minutes") * 60).otherwise(EPISODE_SECONDS)
    return items.select("item_id", seconds.alias("target_seconds"))
