"""Building blocks shared by the reports.

None of these pulls a whole group through one task: ``last_n`` and
``top_k_per_group`` are cut to k rows per key before the shuffle (Spark plans a
partial ``WindowGroupLimit``), and modes are aggregates over counted values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def alive(df: DataFrame, dim: DataFrame | None, key: str) -> DataFrame:
    """Rows whose ``key`` still exists in ``dim``; None says that all do.

    No broadcast hint: Spark broadcasts the key set when its size is known to
    be small, and otherwise shuffles, where adaptive execution splits a hot
    key's partition.
    """
    return df if dim is None else df.join(dim.select(key), key, "left_semi")


def live_facts(facts: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Facts whose item and user both still exist (a delete removes its facts)."""
    return alive(alive(facts, items, "item_id"), users, "user_id")


DAY = "day"


def with_day(df: DataFrame, ts: str) -> DataFrame:
    """Adds the date of ``ts``, by which event tables are partitioned."""
    return df.withColumn(DAY, F.col(ts).cast("date"))


def since(df: DataFrame, ts: str, start: Column) -> DataFrame:
    """Rows from ``start`` on; a table partitioned by day is pruned to its days."""
    recent = df.filter(F.col(ts) >= start)
    return recent.filter(F.col(DAY) >= start.cast("date")) if DAY in df.columns else recent


def last_n(df: DataFrame, key: str, newest_first: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` newest rows of every key.

    The cut before the shuffle needs ``n`` within
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 by default.
    """
    position = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))
    return df.withColumn("_position", position).filter(F.col("_position") <= n).drop("_position")


def top_k_per_group(df: DataFrame, group: str, best_first: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` best rows of every group with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*best_first))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def numbered(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds the number of a row among those of its ``key``, 1 where a key has one row as it should.

    The hash keeps the rows from lying as a join by ``key`` needs them, so that
    such a join shuffles them itself and can split a hot key.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.xxhash64(key), key).orderBy(*order)))


def mode_of(value: str, count: str, *ties: Column, where: Column | None = None) -> Column:
    """Aggregate over counted values: the most frequent as ``struct(value, n)``.

    Equal counts fall to the smallest ``ties`` expressions, then to the smallest
    value. NULL values take part only if ``where`` lets them.
    """
    candidate = F.struct(
        (-F.col(count)).alias("less"),
        *[tie.alias(f"tie{i}") for i, tie in enumerate(ties)],
        F.col(value).alias("value"),
    )
    if where is not None:
        candidate = F.when(where, candidate)
    best = F.min(candidate)
    return F.when(best.isNotNull(), F.struct(best["value"].alias("value"), (-best["less"]).alias("n")))


def numeric_id(key: str | Column) -> Column:
    """The number after an id's one-letter prefix, NULL when there is none."""
    column = F.col(key) if isinstance(key, str) else key
    return F.substring(column, 2, 20).try_cast("bigint")
