"""N-gram Jaccard join by parity sketches.

Every shingle of a document toggles one bit of a sketch. Bits that two sketches
share cancel, so their Hamming distance is at most the symmetric difference of
the shingle sets, which a similarity threshold bounds by the sizes. The sketch
has 2^64 bits, of which only the toggled ones are kept, and is cut into more
segments than that bound (by size band, with some to spare): linked documents
agree in a segment that holds a bit. Agreeing segments give the candidates,
which are verified by their exact shingle sets.

A segment that many documents share is not expanded into pairs. Its smallest
member is compared with every other; links found so make components. Members
left outside the component of that member are compared with the others by
smaller sketches, in blocks of bounded size; of the pairs whose Hamming distance
allows a link those that span the block are verified first, and then what still
lies between two components.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import arrays, components, discard, filled, forget_shuffles, mixed, partitions, shingles, stored

# Members and bytes of sketches of a segment that are compared at once.
BLOCK, BLOCK_BYTES = 1024, 2 << 20
FILTER_BITS = 1 << 23
# Sets that a task remembers to sign each only once: at most 10 MB. Further ones are signed again, which changes nothing but time.
SETS_KNOWN = 100_000


def link_rule(similarity: float) -> tuple[int, int]:
    """Links are pairs with den * intersection >= num * union."""
    num = round(similarity * 100)
    return num, 100


@functools.cache
def bands(num: int, den: int) -> list[tuple[int, int, int, int]]:
    """(lowest, highest, bound, segments) of size bands, each half as wide again as the last.

    ``bound`` is the largest symmetric difference of linked sets in the band. A
    document also enters the next band if it may link with a larger one there.
    """
    found, low, high = [], 1, 4
    while low < 1 << 40:
        bound = 2 * high * (den - num) // (den + num)
        count = bound + 1
        for _ in range(4):  # room for segments without a bit
            count = bound + 1 + math.ceil(1.5 * count * math.exp(-low / count)) if bound else 0
        found.append((low, high, bound, count))
        low, high = high + 1, high * 3 // 2
    return found


def segment_keys(shingle_set: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the sketch segments of a sorted shingle set, in its band and maybe the next.

    Sets of a band whose bound is 0 link only when equal and need no keys.
    """
    n, keys = len(shingle_set), []
    for k, (low, high, bound, count) in enumerate(bands(num, den)):
        if den * n < num * low:
            break
        if n > high or not bound:
            continue
        # sorted hashes fall into segments in order
        at = ((shingle_set >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        parity = np.bitwise_xor.reduceat(mixed(shingle_set), starts)
        keys.append(mixed(mixed(parity + np.uint64(k)) ^ (at[starts] + np.uint64(1))))
        if len(starts) <= bound:  # so many empty segments that one with a bit is not sure to agree
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), at[starts])
            keys.append(mixed(np.uint64(k << 32) ^ mixed(empty + np.uint64(1))))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def signatures(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, node, keys, sketch): size of the set, its digest as the node of the graph (null if empty), segment keys, sketch.

    Of documents with the same set in one task only the first carries keys and a
    sketch. Two sets share a 64-bit digest with a chance of one in 10^19.
    """
    key = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: set[int] = set()
        for batch in filled(batches):
            n, nodes, keys, sketches = [], [], [], []
            for text in arrays(batch, "text"):
                found = shingles(text, words)
                node = _signed(xxhash.xxh3_64_intdigest(found.tobytes())) if len(found) else None
                n.append(len(found))
                nodes.append(node)
                new = len(found) and node not in before
                keys.append(segment_keys(found, num, den) if new else None)
                sketches.append(parity_sketch(found) if new else None)
                if len(before) < SETS_KNOWN:
                    before.add(node)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())], names=["id", "n", "node", "keys", "sketch"])

    return stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        sign, f"id {key}, n bigint, node bigint, keys array<bigint>, sketch binary"))


def shared_keys(entries: DataFrame) -> DataFrame:
    """(key, center, node): the members of every key that two or more nodes share.

    ``entries`` (key, node) are dealt out by ranges of key and node, so a key
    that many share spans several tasks, and each task reads its rows in order,
    holding one of them.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_node = center = None
        first_run = True
        for batch in filled(batches):
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.empty(len(key), bool)
            new[0] = last_key is None or key[0] != last_key
            new[1:] = key[1:] != key[:-1]
            repeat = np.empty(len(key), bool)
            repeat[0] = not new[0] and node[0] == last_node
            repeat[1:] = ~new[1:] & (node[1:] == node[:-1])
            run = np.cumsum(new)
            centers = np.concatenate([[node[0] if center is None else center], node[new]])[run]
            keep = ~new & ~repeat
            if first_run:  # the first and last key of a task may go on in another
                keep |= new & (run == 1)
                first_run = False
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, centers, node)], names=["key", "center", "node"])
            last_key, last_node, center = key[-1], node[-1], centers[-1]
        if last_key is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.array([x])) for x in (last_key, center, center)], names=["key", "center", "node"])

    spark = entries.sparkSession
    found = stored(entries.repartitionByRange(partitions(spark), "key", "node").sortWithinPartitions("key", "node")
                   .mapInArrow(read, "key bigint, center bigint, node bigint"))
    least = found.groupBy("key").agg(F.min("center").alias("least"))
    return stored(found.join(least, "key").filter("node != least").select("key", F.col("least").alias("center"), "node").distinct())


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit set for every id; a filter that lets some others pass."""
    at = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    parts = ids.select(F.floor(at / 32768).alias("part"), (at % 32768).alias("bit")).groupBy("part").agg(
        F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()
    bits = np.zeros(FILTER_BITS, bool)
    for r in parts:
        bits[r["part"] * 32768:(r["part"] + 1) * 32768] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
    return np.packbits(bits)


def node_texts(docs: DataFrame, signed: DataFrame, nodes: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of one document of each of ``nodes`` (node).

    A bitmap of fixed size keeps most other texts out of the shuffle.
    """
    chosen = stored(signed.select("node", "id").join(nodes, "node").groupBy("node").agg(F.min("id").alias("id")))
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(chosen.select("id")))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            at = batch.column(1).to_numpy()
            batch = batch.filter(pa.array((bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
            texts = arrays(batch, "text")
            found = [shingles(x, words) for x in texts]
            node = [_signed(xxhash.xxh3_64_intdigest(x.tobytes())) if len(x) else None for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), batch.column(0)], names=["node", "text"])

    texts = docs.select(F.col(text_col).alias("text"),
                        F.pmod(F.xxhash64(F.col(id_col)), F.lit(FILTER_BITS)).alias("at")).filter("text is not null")
    return (texts.mapInArrow(narrow, "node bigint, text string").join(chosen.select("node"), "node")
            .dropDuplicates(["node"]).select("node", "text"))


def _allowed(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sketches are close enough for a link; the others cannot link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            ok = []
            for n, m, x, y in zip(*(arrays(batch, c) for c in ("n", "m", "x", "y"))):
                x, y = _folded([x, y])
                ok.append(int(np.bitwise_count(x ^ y).sum()) <= (n + m) * (den - num) // (den + num))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(ok))

    both = (pairs.join(sketches.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b")
            .join(sketches.select(F.col("node").alias("a"), "n", F.col("sketch").alias("x")), "a"))
    return stored(both.select("a", "b", "n", "m", "x", "y").mapInArrow(compare, "a bigint, b bigint"))


def verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, inter, total) of ``pairs`` (a, b): sizes of the intersection and union of the exact sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None
        for batch in filled(batches):
            inter, total = [], []
            for a, first, second in zip(arrays(batch, "a"), arrays(batch, "first"), arrays(batch, "second")):
                if a != last:
                    last, of_last = a, shingles(first, words)
                other = shingles(second, words)
                common = len(np.intersect1d(of_last, other, assume_unique=True))
                inter.append(common)
                total.append(len(of_last) + len(other) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(inter, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "inter", "total"])

    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("second")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("first")), "a"))
    return stored(both.select("a", "b", "first", "second").mapInArrow(compare, "a bigint, b bigint, inter bigint, total bigint"))


def _standing(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label, apart) of the keys with a member outside its center's component and another member."""
    label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label"))
    rows = (members.join(label("node"), "node", "left").join(label("center"), "center", "left")
            .withColumn("label", F.coalesce("node_label", "node"))
            .withColumn("apart", F.col("label") != F.coalesce("center_label", "center")))
    counts = rows.groupBy("key").agg(F.max("apart").alias("any"), F.count("*").alias("n")).filter("any and n > 1")
    return rows.join(counts, "key").select("key", "node", "label", "apart")


def parity_sketch(shingle_set: np.ndarray) -> bytes:
    """The parity of the shingles at each of 2^k places, at least two places for each; folding halves gives the smaller sketches."""
    size = 1 << max(6, (2 * len(shingle_set) - 1).bit_length())
    places = (shingle_set & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=size) & 1).astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    least = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, least // 8), axis=0) for x in sketches])


def _forest(a: np.ndarray, b: np.ndarray, cost: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Places of the pairs (a, b) that span the components of labels, the cheapest first."""
    of = list(range(label.max() + 1))

    def root(k):
        while of[k] != k:
            of[k] = of[of[k]]
            k = of[k]
        return k

    found, at = [], np.argsort(cost, kind="stable")
    while True:
        roots = np.array([root(k) for k in range(len(of))])
        x, y = roots[label[a[at]]], roots[label[b[at]]]
        at, x, y = at[x != y], x[x != y], y[x != y]
        if not len(at):
            return np.array(found, np.int64)
        first = np.full(len(of), len(at))
        np.minimum.at(first, x, np.arange(len(at)))
        np.minimum.at(first, y, np.arange(len(at)))
        for k in np.unique(first[first < len(at)]):
            i, j = root(x[k]), root(y[k])
            if i != j:
                of[max(i, j)] = min(i, j)
                found.append(at[k])


def _close_pairs(nodes, sizes, labels, apart, side, sketches, num, den, spanning):
    """Pairs of one block that the sketches allow to link, of different components, one member outside the center's."""
    of = _folded(sketches)
    label = np.unique(labels, return_inverse=True)[1]
    out = np.flatnonzero(apart)
    found = []
    step = max(1, (4 << 20) // of.size)
    for at in range(0, len(out), step):
        i = out[at:at + step]
        apart_bits = np.bitwise_count(of[i, None, :] ^ of[None, :, :]).sum(axis=2, dtype=np.int64)
        ok = apart_bits <= (sizes[i, None] + sizes[None, :]) * (den - num) // (den + num)
        ok &= (label[i, None] != label[None, :]) & (~apart[None, :] | (i[:, None] < np.arange(len(nodes))[None, :]))
        if side is not None:
            ok &= side[i, None] != side[None, :]
        x, y = np.nonzero(ok)
        found.append((i[x], y, apart_bits[x, y]))
    a, b, cost = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    if spanning and len(a):
        kept = _forest(a, b, cost, label)
        a, b = a[kept], b[kept]
    return np.minimum(nodes[a], nodes[b]), np.maximum(nodes[a], nodes[b])


def _further(members: DataFrame, labels: DataFrame, sketches: DataFrame, num: int, den: int, spanning: bool) -> DataFrame:
    """Pairs (a, b) still to verify: members outside the component of the center, with the others of the key.

    The Hamming distance of their sketches rules out almost all pairs that do not
    link. Keys are compared in blocks of bounded size; with ``spanning`` a block
    gives only pairs that span what the sketches allow, else all.
    """
    rows = _standing(members, labels).join(sketches, "node")
    blocks = rows.groupBy("key").agg(F.ceil(F.greatest(F.sum(F.length("sketch")) / BLOCK_BYTES, F.count("*") / BLOCK)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (rows.join(blocks, "key").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "label", "apart", "sketch"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group, out = None, []

        def finish():
            if len(held) > 1 and any(x[3] for x in held):
                nodes, sizes, labels, apart, side, bits = zip(*held)
                out.append(_close_pairs(np.array(nodes), np.array(sizes), np.array(labels), np.array(apart),
                                        np.array(side) if group[1] != group[2] else None, bits, num, den, spanning))

        for batch in filled(batches):
            for key, i, j, own, *row, bits in zip(*(arrays(batch, c) for c in ("key", "i", "j", "own", "node", "n", "label", "apart", "sketch"))):
                if (key, i, j) != group:
                    finish()
                    held, group = [], (key, i, j)
                held.append((*row, own == j, bits))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b"])
                out = []
        finish()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b"])

    return (placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
            .mapInArrow(compare, "a bigint, b bigint").distinct())


def jaccard_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles and component_id per row.

    Rows link when the Jaccard similarity of their word shingle sets is at least
    ``similarity`` (in hundredths, compared in whole numbers). ``component_id`` is the smallest id reachable by
    links, itself included. Texts are lower-cased (A-Z) and cut at ASCII white
    space; with fewer words than a shingle the whole sequence is one. A null,
    empty or blank text has no shingle and links with nothing. A null id is
    kept, links like any other, and names no component. Repeated rows each get a
    row. Other columns are ignored, an empty table gives no rows.
    """
    num, den = link_rule(similarity)
    spark = docs.sparkSession
    keyed = signatures(docs, words, num, den, id_col, text_col)
    entries = keyed.select(F.explode("keys").alias("key"), "node")
    members = shared_keys(entries)
    # the keys take most of the disk and are needed no more
    sketches = stored(keyed.filter("keys is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    signed = stored(keyed.select("id", "n", "node"))
    discard(keyed)
    forget_shuffles(spark)
    is_link = F.col("inter") * den >= F.col("total") * num

    def check(pairs: DataFrame) -> DataFrame:
        texts = stored(node_texts(docs, signed, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), words, id_col, text_col))
        found = verified(pairs, texts, words)
        discard(texts)
        forget_shuffles(spark)
        return found

    checked = check(_allowed(members.select(F.col("center").alias("a"), F.col("node").alias("b")).distinct(), sketches, num, den))
    labels = components(checked.filter(is_link).select("a", "b"))
    for spanning in (True, False):
        more = stored(_further(members, labels, sketches, num, den, spanning).join(checked, ["a", "b"], "left_anti"))
        if more.isEmpty():
            continue
        found = check(more)
        checked = checked.unionByName(found)
        # the components so far stand for the links they came from
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = components(known.unionByName(found.filter(is_link).select("a", "b")))
    grouped = signed.select("id", "n", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.filter("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    return grouped.join(least, "component", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))
