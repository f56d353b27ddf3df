"""Report tables kept current by what changed, instead of by a scan of the history.

A tick gets the items and users of the moment and the ratings and watches that
arrived since the last one. It turns them into deltas: a new fact counts +1, one
that goes away -1, and one whose item or user has new attributes -1 with the old
and +1 with the new. A watch is one row with both, so that what did not change
cancels out before it is summed. Facts go away with their item or user, and
only then are old facts read, by a join to the few keys that are gone or
changed. Sums of the deltas are added to the state of each report:

* ratings per user and item: sum and count;
* completions per item, types per user: counts of conditions;
* viewers: how often each (user, item) was watched; a member counts while that
  is above 0, which gives the distinct counts per item and per user;
* favourites: counted values with their last time; where a last one went away,
  the user's facts are read again;
* last ratings and watches: the few newest per user; users who lost one of them
  are read again;
* trends: counts by time and item inside the window, which enter and expire.

All states and reports lie in parts by hash of their key under one root. A tick
reads and writes only the parts of the keys it touched and becomes current by
one ledger entry, so a tick that fails leaves nothing behind and is run again
from the same states. ``plans.reports`` over all facts is the check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.blocks import last_n, mode_of, numbered, top_k_per_group
from marquee.operators.changes import latest_by_key
from marquee.plans.reports import (
    BAD_BELOW,
    COMPLETION_SHARE,
    EPISODE_SECONDS,
    GOOD_ABOVE,
    NAMED_GENDERS,
    RECENT_RATINGS,
    RECENT_WATCHES,
    TRENDING_MINUTES,
    TRENDING_TOP,
)
from marquee.sources import tables

# The attributes that reports depend on.
ITEM_COLUMNS = ["item_id", "type", "runtime_minutes", "genre_primary", "original_language"]
USER_COLUMNS = ["user_id", "age", "gender"]
RATING_COLUMNS = ["user_id", "item_id", "rating", "rated_at", "seq"]
WATCH_COLUMNS = ["user_id", "item_id", "watched_seconds", "device_type", "session_ended_at"]

# Name of each report's table, and the column by whose hash it lies in parts.
REPORT_KEYS = {
    "user_rating_avg": "user_id", "item_rating_avg": "item_id", "user_mood": "user_id", "item_completion_rate": "item_id",
    "item_viewer_demographics": "item_id", "user_series_movie_ratio": "user_id", "user_top_genre": "user_id",
    "user_top_device_language": "user_id", "user_watch_count": "user_id",
}
RANKINGS = ["item_view_ranking", "item_rating_ranking"]
WEIGHT = "weight"
# So many gone or changed keys of a dimension, some 20 MB at most, go to every task instead of all facts through a shuffle.
FEW_KEYS = 200_000

# The numbers of the parts that deltas touch, by key.
Touched = Mapping[str, Sequence[int]]


def _long(column: Column) -> Column:
    return column.cast("bigint")


def signed(rows: DataFrame, weight: int) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(weight).cast("bigint"))


def _numbered(rows: DataFrame, key: str, rest: Sequence[str], name: str) -> DataFrame:
    """``rest`` as the struct ``name``, with the number ``_no`` of the row among those of its key."""
    return numbered(rows.select(key, *rest), key, rest, "_no").select(key, "_no", F.struct(*rest).alias(name))


def add_sums(state: DataFrame | None, deltas: DataFrame, keys: Sequence[str], sums: Sequence[str], count: str) -> DataFrame:
    """``state`` plus ``deltas``, summed per key; keys whose ``count`` has come to 0 are gone."""
    both = deltas.select(*keys, *sums)
    if state is not None:
        both = both.unionByName(state.select(*keys, *sums))
    return both.groupBy(*keys).agg(*[_long(F.sum(name)).alias(name) for name in sums]).filter(F.col(count) != 0)


class Changed:
    """What became of the keys of one dimension since the last tick.

    ``both`` pairs the old row of a key with the new one, ``arrived`` has the new
    ones alone, which is what new facts count for. ``rows`` are the keys
    that are gone or have other attributes, ``gone`` those that are gone; few of
    them come as a broadcast.
    """

    def __init__(self, key: str, columns: Sequence[str], old: DataFrame | None, new: DataFrame):
        self.key, self.new = key, new.select(*columns)
        self.old = self.new.limit(0) if old is None else old
        rest = [c for c in columns if c != key]
        before, after = _numbered(self.old, key, rest, "_old"), _numbered(self.new, key, rest, "_new")
        self.arrived = after.withColumn("_old", F.when(F.lit(False), F.col("_new")))
        self.both = before.join(after, [key, "_no"], "full_outer").persist()
        every = self.both.filter(~F.col("_old").eqNullSafe(F.col("_new")))
        self.every = every.select(key, F.col("_old").isNull().alias("is_new"), F.col("_new").isNull().alias("is_gone"))
        new_keys, gone_keys, keys = self.every.agg(F.count_if("is_new"), F.count_if("is_gone"), F.count("*")).first()
        self.any_gone, self.any, self.same = gone_keys > 0, keys > new_keys, keys == 0 and old is not None
        self.rows = self._keys("not is_new", keys - new_keys)
        self.gone = self._keys("is_gone", gone_keys)

    def _keys(self, which: str, number: int) -> DataFrame:
        found = self.every.filter(which).select(self.key).distinct()
        return F.broadcast(found) if number <= FEW_KEYS else found


class Tick:
    """One step from the states of the last version to those of the next."""

    def __init__(self, spark: SparkSession, root: str, batch: int, items: DataFrame, users: DataFrame, writer: str, parts: int):
        self.spark, self.root, self.batch, self.writer, self.parts = spark, root, batch, writer, parts
        self.known = tables.ledger(spark, root)
        self.number = self.known["version"] + 1
        self.folder = tables.new_folder(self.number)
        self.items = Changed("item_id", ITEM_COLUMNS, self.state("items"), items)
        self.users = Changed("user_id", USER_COLUMNS, self.state("users"), users)
        self.changes: dict[str, DataFrame | tables.Parts | tables.Written] = {}
        for name, dim in (("items", self.items), ("users", self.users)):
            if not dim.same:
                self.changes[name] = dim.new
        self.held: list[DataFrame] = [self.items.both, self.users.both]

    def state(self, name: str, touched: Sequence[int] | None = None) -> DataFrame | None:
        return tables.latest(self.spark, self.root, touched, name, self.known)

    def hold(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist())
        return df

    def parts_of(self, keys: DataFrame, key: str) -> list[int]:
        """The parts that hold ``keys``, at most ``parts``."""
        return self.parts_by(keys, key)[key]

    def parts_by(self, rows: DataFrame, *keys: str) -> dict[str, list[int]]:
        """The same for several keys of ``rows`` in one pass."""
        found = rows.select(*[tables.part_number([key], self.parts).alias(key) for key in keys]).distinct().collect()
        return {key: sorted({r[key] for r in found}) for key in keys}

    def write(self, name: str, rows: DataFrame, key: str, touched: Sequence[int], together: bool = False) -> DataFrame:
        """Note ``rows`` as the new content of the ``touched`` parts of a table and return them."""
        if touched or name not in self.known["tables"]:
            self.changes[name] = tables.Parts(tables.with_part(rows, [key], self.parts), touched, self.parts, together)
        return rows

    def store(self, name: str, rows: DataFrame, key: str, touched: Sequence[int]) -> DataFrame:
        """The same, but written at once and read back: for rows that a report is built from."""
        self.write(name, rows, key, touched)
        if name in self.changes:
            self.changes[name] = tables.write_parts(self.spark, self.changes[name], self.root, f"{self.folder}/{name}")
            rows = tables.rows_of(self.spark, self.changes[name], self.root)
        return rows

    def add(self, name: str, deltas: DataFrame, key: str, keys: Sequence[str], sums: Sequence[str], count: str, touched: Sequence[int]) -> DataFrame:
        """Add signed sums to the state ``name``; the new rows of the ``touched`` parts, which hold all keys of ``deltas``."""
        return self.store(name, add_sums(self.state(name, touched), deltas, keys, sums, count), key, touched)

    def commit(self) -> None:
        tables.publish_all(self.spark, self.changes, self.root, self.batch, self.writer)

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


# Facts


def _alive(tick: Tick, facts: DataFrame) -> DataFrame:
    return facts.join(tick.items.new.select("item_id"), "item_id", "left_semi").join(
        tick.users.new.select("user_id"), "user_id", "left_semi")


# The attributes of an item that sums of watches go by, and their names in an old row.
COUNTED = {"type": "old_type", "runtime_minutes": "old_runtime_minutes", "original_language": "old_original_language"}


def _with_attributes(facts: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Facts with the old and new attributes of their item, and whether both item and user ``was`` and are ``now`` there.

    A key with several rows gives as many rows; those beyond the first of each key are ``extra``.
    """
    items = items.select(
        "item_id", F.col("_no").alias("_item_no"), F.col("_old").isNotNull().alias("_item_was"), F.col("_new").isNotNull().alias("_item_now"),
        *[F.col(f"_new.{name}").alias(name) for name in COUNTED], *[F.col(f"_old.{name}").alias(old) for name, old in COUNTED.items()])
    users = users.select(
        "user_id", F.col("_no").alias("_user_no"), F.col("_old").isNotNull().alias("_user_was"), F.col("_new").isNotNull().alias("_user_now"))
    return facts.join(items, "item_id").join(users, "user_id").select(
        *WATCH_COLUMNS, (F.col("_item_was") & F.col("_user_was")).alias("was"), (F.col("_item_now") & F.col("_user_now")).alias("now"),
        *COUNTED, *COUNTED.values(), ((F.col("_item_no") > 1) | (F.col("_user_no") > 1)).alias("extra"))


def land_watches(tick: Tick, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Store the live watches of this tick in parts by user; a retried tick replaces its own.

    Returns them, and the same as deltas.
    """
    new = tick.hold(_with_attributes(batch.select(*WATCH_COLUMNS), tick.items.arrived, tick.users.arrived))
    live = new.filter("not extra").select(*WATCH_COLUMNS, F.lit(tick.number).cast("bigint").alias("tick"))
    in_parts = tables.with_part(live, ["user_id"], tick.parts).hint("rebalance", tables.PART)
    tables.append_rows(in_parts, f"{tick.root}/watches", tick.batch, tables.PART, tick.writer)
    return live, new


def stored_watches(spark: SparkSession, root: str, known: dict | None = None, touched: Sequence[int] | None = None) -> DataFrame | None:
    """All watches of published ticks whose item and user have not gone since they came, or those of the ``touched`` parts of users.

    A key that is deleted takes its facts along for good: if it is created
    again, only later facts count.
    """
    known = known or tables.ledger(spark, root)
    facts = tables.appended(spark, f"{root}/watches", known["batches"])
    if facts is None:
        return None
    if touched is not None:
        facts = facts.filter(F.col(tables.PART).isin(list(touched)))
    for key in ("item_id", "user_id"):
        gone = tables.latest(spark, root, None, f"gone_{key}", known)
        if gone is not None:
            facts = facts.join(gone, key, "left").filter(F.col("gone_at").isNull() | (F.col("tick") >= F.col("gone_at"))).drop("gone_at")
    return facts.select(*WATCH_COLUMNS)


def watches_of(tick: Tick, users: DataFrame, landed: DataFrame) -> DataFrame:
    """All live watches of some users, those of this tick included; reads only the parts of these users."""
    users = tick.hold(users.select("user_id").distinct())
    known = stored_watches(tick.spark, tick.root, tick.known, tick.parts_of(users, "user_id"))
    return _alive(tick, landed.select(*WATCH_COLUMNS).unionByName(known).join(users, "user_id", "left_semi"))


def note_gone(tick: Tick) -> None:
    """Keep the tick at which each deleted key went."""
    for dim in (tick.items, tick.users):
        if dim.any_gone:
            now = dim.gone.withColumn("gone_at", F.lit(tick.number).cast("bigint"))
            before = tick.state(f"gone_{dim.key}")
            every = now if before is None else now.unionByName(before)
            tick.changes[f"gone_{dim.key}"] = every.groupBy(dim.key).agg(F.max("gone_at").alias("gone_at"))


def _of_keys(facts: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Facts with one of the ``items`` or ``users``, which are distinct; reads the facts once."""
    item, user = (keys.withColumn(f"_{key}", F.lit(True)) for keys, key in ((items, "item_id"), (users, "user_id")))
    found = facts.join(item, "item_id", "left").join(user, "user_id", "left")
    return found.filter(F.col("_item_id").isNotNull() | F.col("_user_id").isNotNull()).select(*facts.columns)


def watch_deltas(tick: Tick, new: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The deltas of watches: ``new`` ones and, where some key is gone or changed, stored ones; and the latter alone.

    A row has what its watch counts for with the old attributes if it ``was``
    counted, and with the new ones if it is ``now``; ``weight`` is the difference
    in watches.
    """
    deltas, moved = new, None
    if tick.items.any or tick.users.any:
        known = stored_watches(tick.spark, tick.root, tick.known)
        if known is not None:
            moved = tick.hold(_with_attributes(_of_keys(known, tick.items.rows, tick.users.rows), tick.items.both, tick.users.both))
            deltas = deltas.unionByName(moved)
    return deltas.withColumn(WEIGHT, _difference(F.lit(True), F.lit(True))), moved


def _difference(now: Column, was: Column) -> Column:
    """What a row adds to the number of watches for which a condition holds, ``now`` by the new attributes and ``was`` by the old ones."""
    return _long(F.coalesce(F.col("now") & now, F.lit(False))) - _long(F.coalesce(F.col("was") & was, F.lit(False)))


def rating_deltas(tick: Tick, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed ratings (new and overwritten ones, and those whose item or user is gone), and the touched parts of the latest ratings."""
    pair, values = RATING_COLUMNS[:2], RATING_COLUMNS[2:]
    winners = tick.hold(latest_by_key(_alive(tick, batch.select(*RATING_COLUMNS)), pair, "seq"))
    touched = set(tick.parts_of(winners, "user_id"))
    steps = winners.withColumn("gone", F.lit(False))
    if tick.items.any_gone or tick.users.any_gone:
        known = tick.state("ratings")
        if known is not None:
            removed = tick.hold(_of_keys(known, tick.items.gone, tick.users.gone))
            touched |= set(tick.parts_of(removed, "user_id"))
            steps = steps.unionByName(removed.withColumn("gone", F.lit(True)))
    touched = sorted(touched)
    known = tick.state("ratings", touched)
    if known is None:
        return signed(winners, 1), tick.write("ratings", winners.select(*RATING_COLUMNS), "user_id", touched)
    # each pair once: its known rating, and the one that came or that it is gone
    before = known.select(*pair, F.lit(True).alias("known"), *[F.col(name).alias(f"old_{name}") for name in values])
    beside = before.join(steps, pair, "full_outer")
    comes = ~F.col("gone") & (F.col("known").isNull() | (F.col("seq") >= F.col("old_seq")))
    beside = tick.hold(beside.withColumns({"comes": F.coalesce(comes, F.lit(False)), "goes": F.coalesce("gone", F.lit(False))}))
    old = beside.filter("known and (comes or goes)").select(*pair, *[F.col(f"old_{name}").alias(name) for name in values])
    deltas = signed(beside.filter("comes").select(*RATING_COLUMNS), 1).unionByName(signed(old, -1))
    kept = beside.filter("comes or (known and not goes)").select(
        *pair, *[F.when(F.col("comes"), F.col(name)).otherwise(F.col(f"old_{name}")).alias(name) for name in values])
    return tick.hold(deltas), tick.write("ratings", kept, "user_id", touched)


# Sums


def rating_averages(tick: Tick, deltas: DataFrame, touched: Touched) -> None:
    weighed = deltas.withColumns({"rating_sum": _long(F.col("rating")) * F.col(WEIGHT), "rating_count": F.col(WEIGHT)})
    for key in ("user_id", "item_id"):
        name = f"{key.removesuffix('_id')}_rating_avg"
        sums = tick.add(f"{name}_sums", weighed, key, [key], ["rating_sum", "rating_count"], "rating_count", touched[key])
        tick.write(name, sums.select(key, (F.col("rating_sum").cast("double") / F.col("rating_count")).alias("avg_rating"), "rating_count"), key, touched[key], together=True)


def completion_rates(tick: Tick, deltas: DataFrame, touched: Touched, share: Decimal, episode_seconds: int) -> None:
    """Watches that reached ``share`` of their item's length."""
    def done(kind: str, runtime: str) -> Column:
        length = F.when(F.col(kind) == "movie", F.col(runtime) * 60).otherwise(episode_seconds)
        return F.col("watched_seconds") >= F.lit(share) * length

    now, was = (done(*names) for names in (("type", "runtime_minutes"), ("old_type", "old_runtime_minutes")))
    weighed = deltas.withColumns({
        "done": _difference(now, was), "judged": _difference(now.isNotNull(), was.isNotNull()), "watch_count": F.col(WEIGHT)})
    sums = tick.add("item_completion_sums", weighed, "item_id", ["item_id"], ["done", "judged", "watch_count"], "watch_count", touched["item_id"])
    rate = F.when(F.col("judged") > 0, F.col("done").cast("double") / F.col("judged"))
    typed = sums.join(tick.items.new.select("item_id", "type"), "item_id")
    tick.write("item_completion_rate", typed.select("item_id", "type", rate.alias("completion_rate"), "watch_count"), "item_id", touched["item_id"])


def type_ratios(tick: Tick, deltas: DataFrame, touched: Touched) -> None:
    kinds = {kind: _difference(F.col("type") == kind, F.col("old_type") == kind) for kind in ("movie", "series")}
    weighed = deltas.withColumns({**kinds, "total": F.col(WEIGHT)})
    sums = tick.add("user_type_sums", weighed, "user_id", ["user_id"], ["movie", "series", "total"], "total", touched["user_id"])
    tick.write("user_series_movie_ratio", sums.select(
        "user_id", *[F.col(kind).alias(f"{kind}_watch_count") for kind in kinds],
        *[(F.col(kind).cast("double") / F.col("total")).alias(f"{kind}_percentage") for kind in kinds]), "user_id", touched["user_id"], together=True)


# Distinct counts


def viewers(tick: Tick, deltas: DataFrame, parts: Touched) -> None:
    """How often each pair was watched; a viewer counts for an item, and an item for a user, while that is above 0."""
    pair = ["user_id", "item_id"]
    change = deltas.groupBy(*pair).agg(_long(F.sum(WEIGHT)).alias("change"))
    touched = parts["user_id"]
    known = tick.state("watched_pairs", touched)
    known = change.limit(0).withColumnRenamed("change", "n") if known is None else known
    beside = known.join(change, pair, "full_outer").select(
        *pair, F.coalesce("n", F.lit(0)).alias("before"), F.coalesce("change", F.lit(0)).alias("change"), F.col("change").isNotNull().alias("hit"))
    beside = tick.hold(beside.withColumn("after", F.col("before") + F.col("change")))
    tick.write("watched_pairs", beside.filter("after > 0").select(*pair, _long(F.col("after")).alias("n")), "user_id", touched)

    hit = beside.filter("hit")
    per_user = hit.select("user_id", (_long(F.col("after") > 0) - _long(F.col("before") > 0)).alias("distinct_items_watched"), F.col("change").alias("total_watches"))
    sums = tick.add("user_watch_sums", per_user, "user_id", ["user_id"], ["distinct_items_watched", "total_watches"], "total_watches", touched)
    tick.write("user_watch_count", sums.select("user_id", "distinct_items_watched", "total_watches"), "user_id", touched, together=True)

    # a pair leaves with its viewer's old attributes and enters with the new ones
    left = signed(hit.filter("before > 0").join(tick.users.old, "user_id"), -1)
    entered = signed(hit.filter("after > 0").join(tick.users.new, "user_id"), 1)
    bucket = F.when(F.col("gender").isin(NAMED_GENDERS), F.col("gender")).otherwise("unknown")
    buckets = [*NAMED_GENDERS, "unknown"]
    weighed = left.unionByName(entered).withColumns({
        **{name: F.when(bucket == name, F.col(WEIGHT)).otherwise(0) for name in buckets},
        "age_sum": F.coalesce(_long(F.col("age")) * F.col(WEIGHT), F.lit(0)), "age_count": F.when(F.col("age").isNotNull(), F.col(WEIGHT)).otherwise(0),
        "viewer_count": F.col(WEIGHT)})
    sums = tick.add("item_viewer_sums", weighed, "item_id", ["item_id"], [*buckets, "age_sum", "age_count", "viewer_count"], "viewer_count", parts["item_id"])
    tick.write("item_viewer_demographics", sums.select(
        "item_id", F.when(F.col("age_count") > 0, F.col("age_sum").cast("double") / F.col("age_count")).alias("average_age"),
        *[(F.col(name).cast("double") / F.col("viewer_count")).alias(f"pct_{name}") for name in buckets], "viewer_count"), "item_id", parts["item_id"], together=True)


# Counted values with their last time


def favourites(tick: Tick, deltas: DataFrame, touched: Sequence[int], landed: DataFrame, moved: DataFrame | None) -> None:
    """Devices and languages per user, with count and last time; ties fall to the later one.

    A vote that a watch had and still has is no change, so that only users who
    lost the last watch of a value are looked at again.
    """
    def vote(kind: str, value: str, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(value).alias("value"), n.alias(WEIGHT))

    def votes(facts: DataFrame, *each: Column) -> DataFrame:
        voted = facts.select("user_id", "session_ended_at", F.explode(F.array(*each)).alias("vote")).select("user_id", "session_ended_at", "vote.*")
        return voted.filter((F.col(WEIGHT) != 0) & ((F.col("kind") == "device") | F.col("value").isNotNull()))

    grain = ["user_id", "kind", "value"]
    other = ~(F.col("was") & F.col("now") & F.col("original_language").eqNullSafe(F.col("old_original_language")))
    gains, losses = (F.when(F.col(there) & other, F.lit(n).cast("bigint")).otherwise(0) for there, n in (("now", 1), ("was", -1)))
    changed = votes(
        deltas, vote("device", "device_type", F.col(WEIGHT)), vote("language", "original_language", gains),
        vote("language", "old_original_language", losses))
    change = changed.groupBy(*grain).agg(
        _long(F.sum(WEIGHT)).alias("n"), F.max(F.when(F.col(WEIGHT) > 0, F.col("session_ended_at"))).alias("last"),
        F.max(F.when(F.col(WEIGHT) < 0, F.col("session_ended_at"))).alias("lost"))
    known = tick.state("user_votes", touched)
    both = change if known is None else change.unionByName(known, allowMissingColumns=True)
    summed = both.groupBy(*grain).agg(
        _long(F.sum("n")).alias("n"), F.max("last").alias("last"), F.max("lost").alias("lost")).filter("n > 0")
    if moved is None:
        kept = summed
    else:
        # the last one may be among those that went away: look at these users' facts again
        summed = tick.hold(summed)
        sure = summed.filter("lost is null or lost < last")
        unsure = tick.hold(summed.filter("lost >= last"))
        facts = watches_of(tick, unsure, landed).join(tick.items.new, "item_id")
        one = F.lit(1).cast("bigint")
        again = votes(facts, vote("device", "device_type", one), vote("language", "original_language", one)).groupBy(*grain).agg(F.max("session_ended_at").alias("again"))
        value = F.col("l.value").eqNullSafe(F.col("r.value"))
        looked_up = unsure.alias("l").join(again.alias("r"), (F.col("l.user_id") == F.col("r.user_id")) & (F.col("l.kind") == F.col("r.kind")) & value)
        kept = sure.unionByName(looked_up.select("l.user_id", "l.kind", "l.value", "l.n", F.col("r.again").alias("last"), "l.lost"))
    rows = tick.store("user_votes", kept.drop("lost"), "user_id", touched)

    earlier = -F.unix_micros(F.col("last").cast("timestamp"))
    tops = rows.groupBy("user_id").agg(
        mode_of("value", "n", earlier, where=F.col("kind") == "device").alias("device"),
        mode_of("value", "n", earlier, where=F.col("kind") == "language").alias("language"))
    tick.write("user_top_device_language", tops.select(
        "user_id", F.col("device.value").alias("top_device"), F.col("device.n").alias("device_watch_count"),
        F.col("language.value").alias("top_language"), F.col("language.n").alias("language_watch_count")), "user_id", touched)


# The newest few


def moods(tick: Tick, deltas: DataFrame, touched: Sequence[int], ratings: DataFrame, n: int, good: float, bad: float) -> None:
    """Each user's last ``n`` ratings; a user who lost one of them is read again from ``ratings``, the touched parts as they will be."""
    columns = ["user_id", "item_id", "rating", "rated_at", "seq"]
    known = tick.state("last_ratings", touched)
    newest = [F.desc("rated_at"), F.asc("item_id")]
    new = deltas.filter(F.col(WEIGHT) > 0).select(*columns)
    if known is None:
        rows = last_n(new, "user_id", newest, n)
    else:
        lost = deltas.filter(F.col(WEIGHT) < 0).select("user_id", "item_id", "seq")
        short = tick.hold(known.join(lost, ["user_id", "item_id", "seq"], "left_semi").select("user_id").distinct())
        again = ratings.join(short, "user_id", "left_semi").select(*columns)
        rest = known.unionByName(new).join(short, "user_id", "left_anti")
        rows = last_n(rest.unionByName(again), "user_id", newest, n)
    rows = tick.store("last_ratings", rows.select(*columns), "user_id", touched)
    mean = F.col("avg_recent_rating")
    tick.write("user_mood", rows.groupBy("user_id").agg(F.avg("rating").alias("avg_recent_rating"), F.count("*").cast("int").alias("ratings_used")).select(
        "user_id", F.when(mean > good, "good").when(mean >= bad, "average").otherwise("bad").alias("mood"), "avg_recent_rating", "ratings_used"),
        "user_id", touched)


def top_genres(tick: Tick, landed: DataFrame, touched: Sequence[int], moved: DataFrame | None, n: int) -> None:
    """Each user's last ``n`` watches; genres are looked up in the items of the moment."""
    columns = ["user_id", "item_id", "session_ended_at"]
    newest = [F.desc("session_ended_at"), F.asc("item_id")]
    new = landed.select(*columns)
    known = tick.state("last_watches", touched)
    if known is None:
        rows = last_n(new, "user_id", newest, n)
    elif moved is None:
        rows = last_n(known.unionByName(new), "user_id", newest, n)
    else:
        kept = _alive(tick, known)
        left = known.groupBy("user_id").count().join(kept.groupBy("user_id").agg(F.count("*").alias("still")), "user_id", "left")
        short = tick.hold(left.filter("still is null or still < count").select("user_id"))
        again = watches_of(tick, short, landed).select(*columns)
        rows = last_n(kept.unionByName(new).join(short, "user_id", "left_anti").unionByName(again), "user_id", newest, n)
    rows = tick.store("last_watches", rows.select(*columns), "user_id", touched)
    votes = rows.join(tick.items.new.select("item_id", "genre_primary"), "item_id").filter(F.col("genre_primary").isNotNull())
    counted = votes.groupBy("user_id", "genre_primary").agg(F.count("*").alias("n"))
    tops = counted.groupBy("user_id").agg(mode_of("genre_primary", "n").alias("top"), F.sum("n").alias("watches_used"))
    tick.write("user_top_genre", tops.select(
        "user_id", F.col("top.value").alias("top_genre"), F.col("top.n").alias("genre_watch_count"), "watches_used"), "user_id", touched)


# Trends


def trends(tick: Tick, ratings: DataFrame, watches: DataFrame, as_of: Column, minutes: int, top_n: int) -> None:
    """Views and ratings by time and item inside the window; older ones expire.

    The state is as wide as the window. ``as_of`` never goes back.
    """
    start = as_of - F.make_dt_interval(mins=F.lit(minutes))

    def window(name: str, ts: str, deltas: DataFrame, sums: Sequence[str], count: str) -> DataFrame:
        known = tick.state(name)
        rows = add_sums(known, deltas.filter(F.col(ts) >= start), [ts, "item_id"], sums, count).filter(F.col(ts) >= start)
        tick.changes[name] = tick.hold(rows)
        return rows.groupBy("item_id").agg(*[_long(F.sum(s)).alias(s) for s in sums])

    views = window("trend_views", "session_ended_at", watches.filter(F.col(WEIGHT) != 0).withColumn("view_count", F.col(WEIGHT)), ["view_count"], "view_count")
    rated = ratings.withColumns({"rating_sum": _long(F.col("rating")) * F.col(WEIGHT), "rating_count": F.col(WEIGHT)})
    scores = window("trend_ratings", "rated_at", rated, ["rating_sum", "rating_count"], "rating_count")
    types = tick.items.new.select("item_id", "type")

    ranked = top_k_per_group(views.join(types, "item_id"), "type", [F.desc("view_count"), F.asc("item_id")], top_n)
    tick.changes["item_view_ranking"] = ranked.select("type", "rank", "item_id", "view_count")
    both = scores.withColumn("avg_rating", F.col("rating_sum").cast("double") / F.col("rating_count")).join(types, "item_id").join(views, "item_id", "left")
    best = [F.desc("avg_rating"), F.desc("rating_count"), F.desc(F.coalesce("view_count", F.lit(0))), F.asc("item_id")]
    tick.changes["item_rating_ranking"] = top_k_per_group(both, "type", best, top_n).select("type", "rank", "item_id", "avg_rating", "rating_count")


def advance(
    root: str,
    batch: int,
    items: DataFrame,
    users: DataFrame,
    ratings: DataFrame,
    watches: DataFrame,
    as_of: Column,
    writer: str = tables.DIRECT,
    parts: int = tables.PARTS,
    minutes: int = TRENDING_MINUTES,
    top_n: int = TRENDING_TOP,
    recent_ratings: int = RECENT_RATINGS,
    recent_watches: int = RECENT_WATCHES,
    share: Decimal = COMPLETION_SHARE,
    episode_seconds: int = EPISODE_SECONDS,
) -> None:
    """Bring the eleven reports under ``root`` up to date with what arrived since the last tick.

    ``items`` and ``users`` are all those of the moment, one row per key;
    ``ratings`` (with ``seq``, the order of arrival) and ``watches`` only the new
    ones. Facts of unknown items or users are left out, as dead letters are. The
    parameters belong to the root: they stay the same from tick to tick.
    """
    spark = items.sparkSession
    if tables.is_published(spark, root, batch, writer):
        return
    tick = Tick(spark, root, batch, items, users, writer, parts)
    try:
        note_gone(tick)

        def rate() -> tuple[DataFrame, DataFrame, Touched]:
            rated, latest = rating_deltas(tick, ratings)
            return rated, latest, tick.parts_by(rated, "user_id", "item_id")

        with ThreadPoolExecutor(1) as beside:
            rates = beside.submit(rate)
            landed, new = land_watches(tick, watches)
            watched, moved = watch_deltas(tick, new)
            of_watched = tick.parts_by(watched, "user_id", "item_id")
            rated, latest, of_rated = rates.result()
        reports = [
            (rating_averages, rated, of_rated), (completion_rates, watched, of_watched, share, episode_seconds),
            (type_ratios, watched, of_watched), (viewers, watched, of_watched),
            (favourites, watched, of_watched["user_id"], landed, moved),
            (moods, rated, of_rated["user_id"], latest, recent_ratings, GOOD_ABOVE, BAD_BELOW),
            (top_genres, landed, of_watched["user_id"], moved, recent_watches), (trends, rated, watched, as_of, minutes, top_n),
        ]
        with ThreadPoolExecutor(len(reports)) as pool:  # they share the deltas only
            for done in [pool.submit(build, tick, *rest) for build, *rest in reports]:
                done.result()
        tick.commit()
    finally:
        tick.release()


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A report's current rows, or None before the first tick."""
    return tables.latest(spark, root, name=name)
