"""Merkle manifest of a table: a tree of digests per group, a tree over the groups, and an inclusion proof per row.

Every node is labelled with the interval [lo, hi) of the leaf ranks it covers,
so ancestry is containment and needs no pointers. A node of level k covers up
to ``run`` ** k leaves; the bucket ``lo`` div ``run`` ** (k + 1) is the same for
a node and its parent, so the containment join is an equality join on the
bucket, level by level, with the intervals checked. What the parent's interval
leaves on either side of the node's own are its siblings.

Texts are read once, to hash them; after that rows are digests. A run has at
most ``run`` nodes, so no group of a step grows with a hot source, and ranks
come from a range partitioning on the whole order, not from a window over a
source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.shared import partitions, stored

# Nodes hashed into one parent.
RUN = 16
# Bits of a row's position within its task, in monotonically_increasing_id.
POSITION_BITS = 33


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and its text; ``-`` for null, so that no two rows look alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of ``parts``, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def row_digest(*values: Column) -> Column:
    return digest(*(field(value) for value in values))


def group_key(value: Column) -> Column:
    """A key that is never null and sorts like ``value``: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``lo``, the rank from 0 by ``order`` among those of the same ``grp``, and ``n``, their number.

    Rows are dealt to tasks by ranges of (grp, order), which splits a hot group;
    a task's rows of a group start where the tasks before it end. Only one row
    per group and task is summed up. Rows equal in all of ``order`` take any of
    their places.
    """
    rows = stored(rows.withColumn("_tie", F.monotonically_increasing_id()))
    by = ["grp", *order, "_tie"]
    placed = stored(
        rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", POSITION_BITS))
    )
    spans = placed.groupBy("grp", "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("grp")
    earlier = F.sum("_n").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    spans = stored(spans.select(
        "grp", "_task", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n")))
    return placed.join(spans, ["grp", "_task"]).withColumn("lo", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_tie", "_shift")


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def runs_by_level(leaves: DataFrame, run: int) -> list[DataFrame]:
    """Parents of level 1, 2, ... as rows (grp, n, lo, hi, children, digest), stored; ``children`` ascend by ``lo``.

    A tree grows until one node covers it, so level k holds the groups of more
    than ``run`` ** (k - 1) leaves. A lone leaf is a parent of level 1 with the
    leaf's own digest.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, levels, width = leaves, [], 1
    while not levels or width < most:
        if levels:
            nodes = levels[-1].filter(F.col("n") > width).select("grp", "n", "lo", "digest")
        width *= run
        rest = [c for c in nodes.columns if c not in ("grp", "n", "lo", "digest")]
        parents = nodes.groupBy("grp", "n", F.expr(f"lo div {width}").alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "digest", *rest))).alias("children"))
        hashed = F.sha2(_joined(F.col("children")), 256)
        lone = F.when(F.col("n") == 1, F.col("children")[0]["digest"])
        levels.append(stored(parents.select(
            "grp", "n", (F.col("bucket") * width).alias("lo"), F.least(F.col("bucket") * width + width, "n").alias("hi"),
            "children", F.coalesce(lone, hashed).alias("digest"),
        )))
    return levels


def _step(children: Column, lo: Column, hi: Column) -> Column:
    """One level of a proof: the digests that the parent's interval holds left and right of [lo, hi)."""
    return F.struct(
        _joined(F.filter(children, lambda c: c["lo"] < lo)).alias("left"),
        _joined(F.filter(children, lambda c: c["lo"] >= hi)).alias("right"),
    )


def attach_ancestors(levels: list[DataFrame], tops: DataFrame, run: int) -> DataFrame:
    """Parents of level 1 with the ``proof`` from them to the end of ``tops``, and the other columns of ``tops``.

    ``tops`` has for every ``grp`` the ``proof`` from its topmost node on.
    """
    above, width = None, run ** len(levels)
    for level in reversed(levels):
        whole = level.filter(F.col("n") <= width).join(tops, "grp")
        if above is None:
            above = whole
        else:
            p = above.select(
                F.col("grp").alias("p_grp"), F.expr(f"lo div {width * run}").alias("p_bucket"), F.col("lo").alias("p_lo"),
                F.col("hi").alias("p_hi"), F.col("children").alias("p_children"), F.col("proof").alias("p_proof"),
                *[c for c in tops.columns if c not in ("grp", "proof")],
            )
            inside = level.filter(F.col("n") > width).join(
                p, (F.col("grp") == F.col("p_grp")) & (F.expr(f"lo div {width * run}") == F.col("p_bucket"))
                & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))
            step = _step(F.col("p_children"), F.col("lo"), F.col("hi"))
            inside = inside.withColumn("proof", F.concat(F.array(step), "p_proof")).select(whole.columns)
            above = whole.unionByName(inside)
        width //= run
    return above


def _leaf_rows(parents: DataFrame) -> DataFrame:
    """One row per leaf of the parents of level 1, with its own step before their ``proof``."""
    each = parents.withColumn("leaf", F.explode("children"))
    step = _step(F.col("children"), F.col("leaf.lo"), F.col("leaf.lo") + 1)
    proof = F.when(F.col("n") == 1, F.col("proof")).otherwise(F.concat(F.array(step), "proof"))
    return each.withColumn("proof", proof)


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Sequence[Column], keep: dict[str, Column], run: int = RUN) -> DataFrame:
    """(the columns ``keep``, leaf, subroot, root, proof) per row of ``rows``.

    ``leaf`` is a row's digest. The leaves of a ``group``, ascending by
    ``order`` (nulls first, ties by digest), are hashed in runs of ``run`` up to
    one ``subroot``; the subroots, ordered by group (null first, then UTF-8
    bytes), likewise give ``root``. ``proof`` lists for every level from the
    leaf to the root the sibling digests ``left`` and ``right`` of the node,
    each a string of hex digests, for ``fold``. A group of one row has its leaf
    as subroot and no level of its own; a table of one group has the subroot as
    root. Repeated rows are leaves of their own. An empty table gives no rows.
    """
    keys = [f"o{i}" for i in range(len(order))]
    leaves = rows.select(
        group_key(group).alias("grp"), leaf.alias("digest"), *[c.alias(k) for k, c in zip(keys, order)],
        F.struct(*[c.alias(name) for name, c in keep.items()]).alias("kept"),
    )
    levels = runs_by_level(ranked(leaves, [*keys, "digest"]).drop(*keys), run)
    ends, width = None, 1
    for level in levels:
        width *= run
        done = level.filter(F.col("n") <= width).select("grp", "digest")
        ends = done if ends is None else ends.unionByName(done)

    # the tree over the subroots: one group, whose leaves are the groups
    subroots = ends.select(F.lit("").alias("grp"), "digest", F.col("grp").alias("of"))
    upper = runs_by_level(ranked(subroots, ["of"]), run)
    root = upper[-1].select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("proof"), F.col("digest").alias("root"))
    tops = stored(_leaf_rows(attach_ancestors(upper, root, run)).select(
        F.col("leaf.of").alias("grp"), F.col("leaf.digest").alias("subroot"), "root", "proof"))

    found = _leaf_rows(attach_ancestors(levels, tops, run))
    return found.select(*[F.col(f"leaf.kept.{name}").alias(name) for name in keep], F.col("leaf.digest").alias("leaf"), "subroot", "root", "proof")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its ``proof`` lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right; of the empty string if there are none."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` by source and id, checked against texts that were partly tampered with.

    Where 5 divides the crc32 of the decimal id, the text's A-Z are lower-cased
    before the check; a null text stays, as does a row without an id. Such a row
    is ``verified`` only if its text has no A-Z. Other columns of ``docs`` are
    not part of a leaf.
    """
    values = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    # null where the text stays, so that it is not hashed again
    altered = F.when(hit & F.col("text").rlike("[A-Z]"), row_digest(*values, ascii_lower(F.col("text"))))
    found = manifest(docs, row_digest(*values, F.col("text")), F.col("source"), [F.col("doc_id")], {"doc_id": F.col("doc_id"), "altered": altered})
    folded = found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
