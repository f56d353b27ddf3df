"""Change streams, keyed state, dead letters and table synchronisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import wire
from marquee.operators.blocks import since


def decode_changes(records: DataFrame, key: T.StructType, row: T.StructType) -> DataFrame:
    """JSON ``key`` and ``value`` texts of one table's change records as structs, typed as in ``row``."""
    image = wire.wire_schema(row)
    envelope = T.StructType([T.StructField("before", image), T.StructField("after", image)])
    value = F.from_json("value", envelope)
    images = [wire.decode_row(F.col("value")[name], row).alias(name) for name in ("before", "after")]
    return records.withColumns({"key": F.from_json("key", key), "value": value}).withColumn(
        "value", F.when(F.col("value").isNotNull(), F.struct(*images)))


def decode_events(records: DataFrame, row: T.StructType) -> DataFrame:
    """JSON ``value`` texts of events, whose times are epoch milliseconds, as a struct typed as in ``row``; NULL is a tombstone."""
    image = F.from_json("value", wire.wire_schema(row, wire.MILLIS))
    return records.withColumn("value", image).withColumn("value", wire.decode_row(F.col("value"), row, wire.MILLIS))


def unwrap_changes(raw: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Flatten change envelopes into rows with ``is_delete`` and ``seq``.

    ``raw`` has ``key`` (struct), ``value`` (NULL, or a struct with ``before``
    and ``after``) and ``seq``. A NULL value, or an envelope without an
    ``after`` image, deletes the key.
    """
    fields = raw.schema["value"].dataType["after"].dataType.names
    after = F.col("value.after")
    return raw.select(
        *[F.col(f"key.{name}").alias(name) for name in key_cols],
        *[after[name].alias(name) for name in fields if name not in key_cols],
        after.isNull().alias("is_delete"),
        "seq",
    )


def route(raw: DataFrame, pattern: str, origin: str = "origin") -> DataFrame:
    """The records of one source table, picked by a pattern on their origin."""
    return raw.filter(F.col(origin).rlike(pattern))


def latest_by_key(events: DataFrame, keys: Sequence[str], seq: str, ties: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """One row per key, the last to arrive.

    The winner is kept per map task first, so a hot key shuffles one row per
    task. Rows of one key that share a ``seq`` fall back to the ``ties`` columns,
    then to the others. ``unique`` says that no two rows of a key share a
    ``seq`` and none is null; columns of fixed width are then aggregated by hash,
    without a sort.
    """
    rest = [name for name in events.columns if name not in keys and name != seq]
    if unique:
        kept = [F.max_by(name, seq).alias(name) for name in rest]
        return events.groupBy(*keys).agg(*kept, F.max(seq).alias(seq)).select(*keys, *rest, seq)
    order = [*ties, *[name for name in rest if name not in ties]]
    winner = F.max(F.struct(seq, *order)).alias("_winner")
    return events.groupBy(*keys).agg(winner).select(*keys, *[f"_winner.{name}" for name in [*rest, seq]])


def current_state(changes: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Latest value per key; keys whose latest change is a delete are gone."""
    return latest_by_key(changes, keys, seq).filter(~F.col("is_delete")).drop("is_delete", seq)


def append_mirror(records: DataFrame) -> DataFrame:
    """Every record with a value as a row of its own; tombstones are dropped."""
    return records.filter(F.col("value").isNotNull()).select("value.*")


def project(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Keys plus the listed fields."""
    return df.select(*keys, *fields)


def check_references(facts: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Facts with ``error_reason``, NULL where both references exist.

    ``items`` and ``users`` hold one row per key, as state tables do; a
    ``distinct`` here would keep Spark from splitting a hot key's partition.
    """
    known_items = items.select("item_id", F.lit(True).alias("_item_known"))
    known_users = users.select("user_id", F.lit(True).alias("_user_known"))
    checked = facts.join(known_items, "item_id", "left").join(known_users, "user_id", "left")
    return checked.withColumn(
        "error_reason",
        F.when(F.col("_item_known").isNull() & F.col("_user_known").isNull(), "unknown item and user")
        .when(F.col("_item_known").isNull(), "unknown item")
        .when(F.col("_user_known").isNull(), "unknown user"),
    ).select(*facts.columns, "error_reason")


def split_valid(facts: DataFrame, items: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ok, dead_letters)``: facts whose references exist, and the others with ``error_reason``."""
    checked = check_references(facts, items, users)
    ok = checked.filter(F.col("error_reason").isNull()).drop("error_reason")
    return ok, checked.filter(F.col("error_reason").isNotNull())


def stale_tombstones(state: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Deletes for keys the mirror holds but the source no longer has."""
    gone = state.select(key).join(source.select(key), key, "left_anti")
    return gone.select(key, F.lit(None).cast("string").alias("value"))


def delete_keys(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(remaining rows, tombstones)`` after deleting the keys in ``ids``."""
    remaining = df.join(ids.select(key), key, "left_anti")
    tombstones = df.select(key).join(ids.select(key), key, "left_semi")
    return remaining, tombstones.withColumn("is_delete", F.lit(True))


def clear_values(df: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Set ``columns`` to NULL where they hold one of ``values``."""
    wiped = {name: F.when(~F.col(name).isin(list(values)), F.col(name)) for name in columns}
    return df.withColumns(wiped)


def delete_vocabulary(vocabulary: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The vocabulary without ``values``."""
    return vocabulary.filter(~F.col(column).isin(list(values)))


def unload_source(df: DataFrame, source: str) -> DataFrame:
    """Rows not loaded from ``source``; rows without a source stay."""
    return df.filter(~F.col("seed_source").eqNullSafe(F.lit(source)))


def forget_source(log: DataFrame, source: str) -> DataFrame:
    """The load log without the full, items-only and users-only loads of a source."""
    return log.filter(~F.col("seed_name").isin(source, f"{source}:items", f"{source}:users"))


def full_sync(target: DataFrame, result: DataFrame, key: str) -> DataFrame:
    """The changes that turn ``target`` into ``result``, one row per changed key.

    ``action`` is insert, update or delete. Non-key columns hold the new values
    and are NULL for deletes. Rows that compare equal, NULLs included, are left
    out.
    """
    fields = [name for name in result.columns if name != key]
    new = result.select(key, F.struct(*fields).alias("_new"))
    old = target.select(key, F.struct(*fields).alias("_old"))
    action = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        old.join(new, key, "full_outer")
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select(key, "action", "_new.*")
    )


def retain(df: DataFrame, ts: str, as_of: Column, days: int = 2) -> DataFrame:
    """Events of the last ``days`` days."""
    return since(df, ts, as_of - F.make_dt_interval(F.lit(days)))
