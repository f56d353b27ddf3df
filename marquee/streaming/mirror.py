"""Keeping state tables and fact tables in step with their streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from marquee.operators.changes import (
    check_references,
    decode_changes,
    latest_by_key,
    route,
    stale_tombstones,
    unwrap_changes,
)
from marquee.operators.quality import Rule, split_events
from marquee.sources import tables

# Columns of a state table besides those of its rows, ``is_delete`` and ``seq``.
RECONCILED, DELETED_AT = "_reconciled", "_deleted_at"
KEEP_DELETES = timedelta(days=7)


def apply_changes(
    root: str,
    changes: DataFrame,
    keys: Sequence[str],
    batch: int,
    writer: str = tables.DIRECT,
    parts: int = tables.PARTS,
    keep_deletes: timedelta = KEEP_DELETES,
) -> None:
    """Merge one batch of ``writer``'s changes into the state table at ``root``.

    Only the batch's last change per key is merged; a delete needs no other
    columns than its key. The table lies in ``parts`` parts by hash of the key,
    and only those that hold a changed key are read and written again. Deletes
    stay in the table as marked rows, so that an older change arriving later
    cannot revive them; one older than ``keep_deletes`` goes when its part is
    next written. Readers use ``read_state``.
    """
    spark = changes.sparkSession
    if tables.is_published(spark, root, batch, writer):
        return
    if RECONCILED not in changes.columns:
        changes = changes.withColumn(RECONCILED, F.lit(False))
    now = datetime.now(UTC)
    winners = latest_by_key(changes, keys, "seq", [RECONCILED]).withColumn(
        DELETED_AT, F.when(F.col("is_delete"), F.lit(now)))
    winners = tables.with_part(winners, keys, parts).persist()
    try:
        touched = [r[0] for r in winners.select(tables.PART).distinct().collect()]  # at most ``parts``
        known = tables.latest(spark, root, touched)
        merged = winners
        if known is not None:
            both = tables.with_part(known, keys, parts).unionByName(winners, allowMissingColumns=True)
            merged = latest_by_key(both, [*keys, tables.PART], "seq", [RECONCILED])
        expired = F.col("is_delete") & (F.col(DELETED_AT) < F.lit(now - keep_deletes))
        tables.publish_parts(merged.filter(~F.coalesce(expired, F.lit(False))), root, batch, touched, parts, writer)
    finally:
        winners.unpersist()


def read_state(spark, root: str) -> DataFrame | None:
    known = tables.latest(spark, root)
    return None if known is None else known.filter(~F.col("is_delete")).drop("is_delete", "seq", RECONCILED, DELETED_AT)


def apply_sync(root: str, changes: DataFrame, key: str, batch: int, writer: str = tables.DIRECT, parts: int = tables.PARTS) -> None:
    """Merge the changes of ``full_sync`` into the table at ``root``: only parts with a changed key are written.

    A table that does not exist yet is made from the inserts.
    """
    spark = changes.sparkSession
    if tables.is_published(spark, root, batch, writer):
        return
    changes = tables.with_part(changes, [key], parts).persist()
    try:
        touched = [r[0] for r in changes.select(tables.PART).distinct().collect()]  # at most ``parts``
        rows = changes.filter("action != 'delete'").drop("action")
        known = tables.latest(spark, root, touched)
        if known is not None:
            kept = tables.with_part(known, [key], parts).join(changes.select(key), key, "left_anti")
            rows = kept.unionByName(rows)
        tables.publish_parts(rows, root, batch, touched, parts, writer)
    finally:
        changes.unpersist()


def reconcile(state: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Change rows that delete the keys ``source`` no longer has.

    ``state`` is the stored table with ``is_delete`` and ``seq``; feed the
    result to ``apply_changes`` with a writer of its own. A delete takes the
    ``seq`` of the row it deletes and is marked as reconciled, by which it
    comes after that row and before every later change.
    """
    live = state.filter(~F.col("is_delete"))
    gone = stale_tombstones(live, source, key).select(key)
    return live.select(key, "seq").join(gone, key, "left_semi").select(
        key, F.lit(True).alias("is_delete"), "seq", F.lit(True).alias(RECONCILED)
    )


def mirror_state(changes: DataFrame, root: str, keys: Sequence[str], checkpoint: str) -> DataStreamWriter:
    """A writer that keeps the state table at ``root`` current; start it yourself."""
    return changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: apply_changes(root, batch, keys, number, tables.stream_id(batch.sparkSession, checkpoint))
    )


@dataclass(frozen=True)
class Target:
    """A state table fed from a change log: which origin, which key, which row."""

    pattern: str
    key: T.StructType
    row: T.StructType
    root: str


def mirror_log(records: DataFrame, targets: Sequence[Target], checkpoint: str) -> DataStreamWriter:
    """A writer that keeps one state table per target current from one shared log."""
    def write(batch: DataFrame, number: int) -> None:
        writer = tables.stream_id(batch.sparkSession, checkpoint)
        for target in targets:  # each reads the batch: cached texts take many times the room of their compressed files
            routed = decode_changes(route(batch, target.pattern), target.key, target.row)
            changes = unwrap_changes(routed, target.key.names)
            apply_changes(target.root, changes, target.key.names, number, writer)

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def land_facts(
    facts: DataFrame,
    items: DataFrame,
    users: DataFrame,
    root: str,
    dead_letters: str,
    batch: int,
    ts: str,
    rules: Sequence[Rule] = (),
    writer: str = tables.DIRECT,
) -> None:
    """Append a batch's good facts by day, and the others with their reason."""
    bad = None
    if rules:
        facts, bad = split_events(facts, rules)
    checked = check_references(facts, items, users)
    if bad is not None:
        checked = checked.unionByName(bad.withColumnRenamed("error", "error_reason"))
    checked = checked.persist()  # joined once for both tables
    try:
        ok = checked.filter(F.col("error_reason").isNull()).drop("error_reason")
        tables.append_batch(ok, root, batch, ts, writer)
        tables.append_batch(checked.filter(F.col("error_reason").isNotNull()), dead_letters, batch, ts, writer)
    finally:
        checked.unpersist()


def mirror_facts(
    facts: DataFrame,
    read_items: Callable[[], DataFrame],
    read_users: Callable[[], DataFrame],
    root: str,
    dead_letters: str,
    checkpoint: str,
    ts: str,
    rules: Callable[[], Sequence[Rule]] = tuple,
) -> DataStreamWriter:
    """A writer that appends facts, checked against the items and users of the moment.

    ``ts`` is the event time, by whose day the tables are partitioned.
    """
    return facts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: land_facts(
            batch, read_items(), read_users(), root, dead_letters, number, ts, rules(),
            tables.stream_id(batch.sparkSession, checkpoint),
        )
    )


def rating_deltas(known: DataFrame, batch: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """``(deltas, ratings)`` after a batch of ratings.

    ``deltas`` has the change of sum and count per rated pair; ``ratings`` is
    the new table of latest ratings, ``seq`` included.
    """
    pair = ["user_id", "item_id"]
    winners = latest_by_key(batch, pair, seq)
    before = known.select(*pair, F.col("rating").alias("_old"), F.col(seq).alias("_old_seq"))
    newer = F.col("_old_seq").isNull() | (F.col(seq) >= F.col("_old_seq"))
    deltas = winners.join(before, pair, "left").filter(newer).select(
        *pair,
        (F.col("rating") - F.coalesce("_old", F.lit(0))).cast("bigint").alias("rating_sum"),
        F.when(F.col("_old").isNull(), 1).otherwise(0).cast("bigint").alias("rating_count"),
    )
    return deltas, latest_by_key(known.unionByName(winners), pair, seq)


def removal_deltas(removed: DataFrame) -> DataFrame:
    """What ratings that go away take from the sums and counts."""
    return removed.select(
        "user_id",
        "item_id",
        (-F.col("rating")).cast("bigint").alias("rating_sum"),
        F.lit(-1).cast("bigint").alias("rating_count"),
    )


def update_averages(state: DataFrame, deltas: DataFrame, key: str) -> DataFrame:
    """Sums and counts per key after ``deltas``; keys left without ratings are gone.

    Touches only sums, so a tick costs as much as its batch plus the state, not
    the whole history.
    """
    totals = state.select(key, "rating_sum", "rating_count").unionByName(
        deltas.select(key, "rating_sum", "rating_count")
    )
    summed = totals.groupBy(key).agg(
        F.sum("rating_sum").alias("rating_sum"), F.sum("rating_count").alias("rating_count")
    )
    return summed.filter(F.col("rating_count") > 0)


def averages(state: DataFrame, key: str) -> DataFrame:
    mean: Column = F.col("rating_sum").cast("double") / F.col("rating_count")
    return state.select(key, mean.alias("avg_rating"), "rating_count")
