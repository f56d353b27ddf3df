"""Repair of conversation structure: the cheapest edits that make the roles of a conversation alternate.

A conversation becomes a row of codes, one byte per turn, and the repair a
shortest path over the lattice of (turns read, what the roles so far allow).
The path is found by auction: a node's price is a lower bound of its way to the
end; a path is extended along the arc that pays the price, and contracted with a
raised price where no arc does. Starting points are taken from the last turn
backwards and keep the prices of those before, so a path ends at the first node
whose price is already exact, and the work is linear in the turns. At the end
every price is exact: an arc lies on some cheapest path exactly if it is tight,
that is costs the difference of its two prices. The edits are traced along tight
arcs, the least initial first.

Codes and texts travel apart: the auction sees a few bytes per turn, the texts
are shuffled once, for the repaired rows. Both go through a task row by row in
the order of the conversation, so no conversation is held as a whole but for its
codes.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.merkle import group_key
from marquee.llm.shared import Cached, arrays, filled, remainder, stored

DELETE, INSERT, KEEP, REROLE = "DIKR"  # in the order of ties
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1

# What the roles so far allow: nothing yet, after the system's turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
# The state that a role initial leads to; ends are START and ASSISTANT.
AFTER = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
# The state and role of a turn that is inserted or gets a new role.
MADE = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}

# Codes of a turn: its role initial if it may stay, in upper case where truncated; ``-`` where it must go.
MUST_GO, OTHER = "-", "o"

BLANK = r"[\x20\x09-\x0D]"


def arcs(code: str | None) -> list[list[tuple[int, str, int, int]]]:
    """By state: the arcs (cost, initial, turns read, next state), ordered by initial; ``None`` is the end of the conversation."""
    found = []
    for state in AFTER:
        made = MADE[state][0]
        out = [(COST[INSERT], INSERT, 0, made)]
        if code is not None:
            out.append((COST[DELETE], DELETE, 1, state))
        if code is not None and code != MUST_GO:
            more = TRUNCATED_COST if code.isupper() else 0
            if code.lower() in AFTER[state]:
                out.append((COST[KEEP] + more, KEEP, 1, AFTER[state][code.lower()]))
            out.append((COST[REROLE] + more, REROLE, 1, made))
        found.append(sorted(out, key=lambda arc: arc[1]))
    return found


ARCS = {code: arcs(code) for code in [*"suaoSUAO", MUST_GO]} | {None: arcs(None)}


def exact_prices(codes: str) -> array:
    """The cost from every node (turns still to read, state) to the end, by auction, as one flat array."""
    prices, below = array("q"), None
    for code in (None, *reversed(codes)):
        leaving = ARCS[code]
        # no arc of this turn pays less than the cheapest node after it: a feasible start
        price, exact = [min(below) if below else 0] * len(AFTER), [False] * len(AFTER)
        for origin in AFTER:
            path = [origin]
            while not exact[origin]:
                state = path[-1]
                best, nearest = None, None
                if code is None and state in (START, ASSISTANT):
                    best = 0  # the end itself
                for cost, _, read, to in leaving[state]:
                    offer = cost + (below if read else price)[to]
                    if best is None or offer < best:
                        best, nearest = offer, None if read else to
                if price[state] < best:
                    price[state] = best
                    if len(path) > 1:
                        path.pop()  # contraction
                elif nearest is None or exact[nearest]:
                    # the path has come to a node of exact price: so are all prices along it
                    for node in path:
                        exact[node] = True
                else:
                    path.append(nearest)  # extension
        prices.extend(price)
        below = price
    return prices


def cheapest_edits(codes: str) -> tuple[int, str]:
    """(cost, initials of the edits in order); of equally cheap ones the least in ASCII order."""
    prices, last, states = exact_prices(codes), len(codes), len(AFTER)
    k, state, edits = 0, START, []
    while k < last or state not in (START, ASSISTANT):
        here = prices[(last - k) * states + state]
        for cost, initial, read, to in ARCS[codes[k] if k < last else None][state]:
            if cost + prices[(last - k - read) * states + to] == here:
                break
        edits.append(initial)
        k, state = k + read, to
    return prices[last * states + START], "".join(edits)


# Short conversations are few different ones.
EDITS = Cached(cheapest_edits, most=20_000)
SHORT = 64


def in_order(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest): ``conversations`` with a null role or text as one space, and a key that is never null."""
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        group_key(F.col("conv_id")).alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
        F.md5(text.cast("binary")).alias("digest"))


def checked(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, n, blank, repeated, truncated): the faults of rows of ``in_order``, without their texts.

    Equal rows of one turn are adjacent and counted in ``n``; all but the first
    are repeated, and the first is too if an earlier turn says the same.
    """
    blank = ~F.col("text").rlike(rf"[^{BLANK[1:]}")
    cut = ~F.col("text").rlike(rf"[.!?]{BLANK}*\z")
    once = rows.select("conv", "turn", "role", "digest", blank.alias("blank"), cut.alias("truncated")).groupBy("conv", "turn", "role", "digest").agg(
        F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    earlier = F.row_number().over(Window.partitionBy("conv", "role", "digest").orderBy("turn")) > 1
    return once.withColumn("repeated", earlier)


def sorted_by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one task, in order; a task streams them and holds none."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


PLAN = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
LEGAL = {"su", "ua", "au"}


class _Plan:
    """Counts and codes of one conversation while its rows go by."""

    def __init__(self, conv: str):
        self.conv, self.codes, self.last = conv, [], None
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, n: int, blank: bool, repeated: bool, truncated: bool) -> None:
        if turn is not None and (turn != self.turn or not self.turns):
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        if initial + initial not in LEGAL:
            self.illegal += n - 1
        self.last = initial
        if blank:
            self.blank += n
            self.codes.append(MUST_GO * n)
            return
        copies = n if repeated else n - 1
        self.duplicate += copies
        if not repeated:
            self.truncated += truncated
            code = initial if initial in ("s", "u", "a") else OTHER
            self.codes.append(code.upper() if truncated else code)
        self.codes.append(MUST_GO * copies)

    def row(self) -> tuple:
        codes = "".join(self.codes)
        cost, audit = EDITS[codes] if len(codes) <= SHORT else cheapest_edits(codes)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


PLAN_NAMES = [part.split()[0] for part in PLAN.split(", ")]
PLAN_TYPES = [pa.string(), *[pa.int64()] * 6, pa.string()]


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in filled(batches):
        done = []
        for conv, *row in zip(*(arrays(batch, name) for name in ("conv", "turn", "role", "n", "blank", "repeated", "truncated"))):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Plan(conv)
            now.add(*row)
        yield _table(done, PLAN_NAMES, PLAN_TYPES)
    if now is not None:
        yield _table([now.row()], PLAN_NAMES, PLAN_TYPES)


def plan_repairs(conversations: DataFrame) -> DataFrame:
    """Faults, cost and edits of every conversation: rows of ``PLAN``.

    A turn's first fault counts: ``blank`` (only ASCII white space), duplicate
    (role and text were seen earlier in the conversation), ``truncated`` (the
    last character that is no white space is none of ``.!?``). Blank and
    duplicate turns must go. Keeping costs 0, a new role 2, deleting 3, an
    inserted empty turn 2, and 1 more for a truncated turn that stays. ``audit``
    has the initials of the cheapest edits after which the role initials read
    ``(s?(ua)+)?``; ties go to the least string. ``gaps`` counts the turn
    numbers missing between the least and the largest, nulls ignored, and
    ``illegal`` the adjacent turns whose initials are none of su, ua, au.

    Turns are ordered by number, nulls first, then by role and MD5 of the text.
    A null role or text is one space; turns without a conv_id are one
    conversation. An empty table gives no rows; other columns are ignored.
    """
    rows = checked(in_order(conversations))
    return sorted_by_conversation(rows, "turn", "role", "digest").mapInArrow(_plan, PLAN)


REPAIRED = "conv string, place bigint, edit string, turn bigint, role string, text string"
REPAIRED_NAMES = [part.split()[0] for part in REPAIRED.split(", ")]
REPAIRED_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
# Bytes of text after which a batch of repaired rows goes out.
BATCH_BYTES = 1 << 22


class _Repair:
    """The edits of one conversation, applied to its rows as they go by."""

    def __init__(self, conv: str, audit: str):
        self.conv, self.audit = conv, audit
        self.at, self.place, self.state = 0, 0, START

    def _row(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        self.place += 1
        return self.conv, self.place, edit, turn, role, text

    def inserted(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == INSERT:
            self.at += 1
            self.state, role = MADE[self.state]
            yield self._row(INSERT, None, role, "")

    def rows(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = AFTER[self.state][role[:1]]
        elif edit == REROLE:
            self.state, role = MADE[self.state]
        yield self._row(edit, turn, role, text)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out, size = None, [], 0
    for batch in filled(batches):
        for conv, is_turn, turn, role, text in zip(*(arrays(batch, name) for name in ("conv", "is_turn", "turn", "role", "text"))):
            if not is_turn:  # the edits come before the turns
                if now is not None:
                    out += now.inserted()
                now = _Repair(conv, text)
                continue
            out += now.rows(turn, role, text)
            size += len(text)
            if size > BATCH_BYTES:
                yield _table(out, REPAIRED_NAMES, REPAIRED_TYPES)
                out, size = [], 0
        yield _table(out, REPAIRED_NAMES, REPAIRED_TYPES)
        out, size = [], 0
    if now is not None:
        yield _table(list(now.inserted()), REPAIRED_NAMES, REPAIRED_TYPES)


def repair(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: rows of ``REPAIRED``, those with edit D being the deleted ones.

    ``plans`` is what ``plan_repairs`` found. The rows of a conversation follow
    one another in ``place`` order within a task.
    """
    turns = in_order(conversations).select("conv", F.lit(True).alias("is_turn"), "turn", "role", "digest", "text")
    none = F.lit(None)
    edits = plans.select("conv", F.lit(False).alias("is_turn"), none.cast("bigint").alias("turn"), none.cast("string").alias("role"),
                         none.cast("string").alias("digest"), F.col("audit").alias("text"))
    both = edits.unionByName(turns.withColumn("turn", F.col("turn").cast("bigint")))
    return sorted_by_conversation(both, "is_turn", "turn", "role", "digest").mapInArrow(_repair, REPAIRED)


DIGESTS = "conv string, repaired_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, whole, rows = None, None, 0
    for batch in filled(batches):
        done = []
        for conv, edit, role, text in zip(*(arrays(batch, name) for name in ("conv", "edit", "role", "text"))):
            if conv != now:
                if now is not None:
                    done.append((now, whole.hexdigest()))
                now, whole, rows = conv, hashlib.sha256(), 0
            if edit != DELETE:
                whole.update(f"{chr(10) if rows else ''}{role}:{text}".encode())
                rows += 1
        yield _table(done, ["conv", "repaired_sha256"], [pa.string()] * 2)
    if now is not None:
        yield _table([(now, whole.hexdigest())], ["conv", "repaired_sha256"], [pa.string()] * 2)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of every repaired conversation, as ``role:text`` joined by newlines.

    Reads the rows in the order in which ``repair`` gives them, in the same task.
    """
    return repaired.select("conv", "edit", "role", "text").mapInArrow(_digest, DIGESTS)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by the crc32 of ``conv_id:turn`` modulo 20, a null being one space.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes the user say it.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    fault = remainder(key, 20)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.filter("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The plan and the digest of the repair of every conversation after ``damage``; those without a row left have zeros and nothing."""
    rows = damage(conversations)
    plans = stored(plan_repairs(rows))
    digests = repaired_digests(repair(rows, plans))
    every = conversations.select("conv_id", group_key(F.col("conv_id")).alias("conv")).distinct()
    found = every.join(plans, "conv", "left").join(digests, "conv", "left")
    zeros = [F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
