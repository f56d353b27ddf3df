"""A class-based bigram language model: class transitions and word emissions.

Exchange clustering gives every word of the training texts a class. It starts
with the most frequent words, which are moved one by one to the class that
raises the likelihood of their bigrams most. Then every other word moves, all of
a round at once against the classes of the round before: a table keyed by word
holds how often each class stands beside the word, and the word goes to the
class under which these neighbours are likeliest. The number of classes grows
with the vocabulary. Counts, transitions and emissions cover all training
documents.

    P(word | word before) = P(class | class before) * (c + d) / (N_class + d * (V_class + 1))

Texts are cut into words twice: to count the words, and to write each text as
word numbers, of which all later passes are array operations. Numbers, counts and
classes of the most frequent words (a fixed number) are broadcast; those of all
other words are tables that meet the documents' words in a join, which so has
no hot key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import arrays, discard, filled, forget_shuffles, stored

# Bytes of texts or numbers that are handled at once, pairs that a task adds up before the shuffle, and rows it hands on at once.
BLOCK_BYTES, BLOCK_PAIRS, BLOCK_ROWS = 4 << 20, 4_000_000, 1 << 16
# Words whose neighbours are weighed at once.
WORD_BLOCK = 256


@dataclass(frozen=True)
class Sizes:
    """Bounds of what is broadcast, and how long the clustering goes on."""

    classes: int | None = None  # None: by the vocabulary
    first: int = 512  # words clustered one by one
    frequent: int = 131_072  # words whose counts and classes are broadcast
    rounds: int = 3  # at most, of exchange of all other words
    moved: float = 0.02  # fewer moves than this share of the frequent words end it

    def number(self, vocabulary: int) -> int:
        """Two classes per fourth root of the vocabulary; so many that a class fits in a byte."""
        return self.classes or max(8, min(200, round(2 * vocabulary ** 0.25)))


def _blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``most`` bytes in ``column`` each."""
    for batch in filled(batches):
        data = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False)
        of = np.cumsum(sizes, dtype=np.int64) // most
        starts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for at, to in zip(starts, starts[1:]):
            yield batch.slice(at, to - at)


def _words_of(block: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The ``words`` of all texts one after the other, and where those of each text end."""
    texts = pc.fill_null(block.column(block.schema.get_field_index("text")), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    filled_in = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(filled_in.to_numpy(zero_copy_only=False))])
    ends = before[np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
    return flat.filter(filled_in).cast(pa.binary()), ends


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all ``texts`` (text); a task adds up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "text"):
            counts = _words_of(block)[0].value_counts()
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])

    return stored(texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c")))


def frequent_words(vocabulary: DataFrame, most: int) -> dict[bytes, int]:
    """At most ``most`` words with their counts, from the most frequent on, ties by the word.

    A histogram of the counts on a log scale gives the count from which on so
    many words can be collected; all words at or above it are.
    """
    level = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["level"], r["count"]) for r in vocabulary.groupBy(level.alias("level")).count().collect()), reverse=True)
    lowest, total = None, 0
    for at, n in sizes:
        total += n
        if total > most:
            break
        lowest = at
    if lowest is None:
        return {}
    rows = vocabulary.filter(level >= lowest).collect()
    return {bytes(r["word"]): r["c"] for r in sorted(rows, key=lambda r: (-r["c"], bytes(r["word"])))}


# Groups of words by their last three bytes, and how many neighbours the classes of a word's ending weigh against.
ENDINGS, LEANING = 1 << 14, 3


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def rare_number(word: bytes) -> int:
    """The number of a word that is not broadcast: below zero, 49 bits of its hash before its ending."""
    return -((xxhash.xxh3_64_intdigest(word) >> 15 << 14) | ending(word)) - 1


def ending_of(number: np.ndarray) -> np.ndarray:
    return (-(number + 1)) & (ENDINGS - 1)


def numbered_words(vocabulary: DataFrame, ranks) -> DataFrame:
    """(number, c) of the words that are not broadcast."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks.value
        for batch in filled(batches):
            rows = [(rare_number(w), c) for w, c in zip(arrays(batch, "word"), arrays(batch, "c")) if w not in known]
            numbers, counts = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())], names=["number", "c"])

    return stored(vocabulary.mapInArrow(number, "number bigint, c bigint"))


def as_numbers(texts: DataFrame, ranks) -> DataFrame:
    """(uid, id, held_out, numbers): every text as the numbers of its words, eight bytes each: rank, or ``rare_number``."""
    key = texts.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rank = ranks.value.get
        uid = TaskContext.get().partitionId() << 40
        for block in _blocks(batches, "text"):
            flat, ends = _words_of(block)
            coded = flat.dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            of = np.fromiter(map(rank, distinct, repeat(-1)), np.int64, len(distinct))
            for k in np.flatnonzero(of < 0):
                of[k] = rare_number(distinct[k])
            numbers = of[coded.indices.to_numpy()]
            offsets = np.concatenate([[0], 8 * ends]).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(numbers)])
            uids = np.arange(uid, uid + block.num_rows)
            uid += block.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), block.column(0), block.column(1), coded], names=["uid", "id", "held_out", "numbers"])

    return stored(texts.select("id", "held_out", "text").mapInArrow(encode, f"uid bigint, id {key}, held_out boolean, numbers binary"))


def _joined(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column as one array, and where those of each row end."""
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2] if offsets[-1] > offsets[0] else b""
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind) if data else np.empty(0, kind), (offsets[1:] - offsets[0]) // size


def _neighbours(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each value and the next one stand in the same row."""
    same = np.ones(max(0, len(flat) - 1), bool)
    same[ends[(ends > 0) & (ends < len(flat))] - 1] = False
    return same


def _counted(texts: DataFrame, column: str, size: int, pairs, kind=np.int64) -> np.ndarray:
    """Matrix of how often ``pairs()(array, ends)`` gives (x, y), both below ``size``; a task adds up all its rows."""
    size = max(1, size)
    most = BLOCK_BYTES * np.dtype(kind).itemsize // 8  # counted with eight bytes a value

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = pairs(), np.zeros(size * size, np.int64)
        for block in _blocks(batches, column, most):
            x, y = of(*_joined(block.column(0), kind))
            sums += np.bincount(x * size + y, minlength=size * size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at // size), pa.array(at % size), pa.array(sums[at])], names=["x", "y", "n"])

    found = texts.select(column).mapInArrow(count, "x bigint, y bigint, n bigint").groupBy("x", "y").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    x, y, n = (table.column(name).to_numpy() for name in ("x", "y", "n"))
    counts = np.zeros((size, size), np.int64)
    counts[x, y] = n
    return counts


# One neighbour's class and how often it stands there.
ENTRY = np.dtype([("y", "<u2"), ("n", "<u4")])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _packed_pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """(x, found) of the pairs, added up. Sorts them where ``x`` lies, which is lost."""
    coded = pa.array(x).dictionary_encode()
    keys, words = x, coded.dictionary
    keys[:] = coded.indices.to_numpy()
    del coded
    keys <<= 16
    keys |= y
    keys.sort()
    starts = _runs(keys)
    entries = np.empty(len(starts), ENTRY)
    entries["n"] = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    entries["y"] = keys & 0xFFFF
    keys >>= 16
    first = _runs(keys)
    offsets = (ENTRY.itemsize * np.append(first, len(keys))).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(entries.view(np.uint8))])
    return pa.RecordBatch.from_arrays([words.take(pa.array(keys[first])), found], names=["x", "found"])


def _entries_of_words(numbers: DataFrame, pairs) -> DataFrame:
    """(x, found): per word the ``ENTRY`` rows of the classes that ``pairs()(array, ends)`` finds beside it.

    A task adds up before the shuffle; a word has a row from each of its blocks
    of pairs, each at most as long as there are classes on two sides. The rows
    lie in partitions by the word and are sorted by it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, x, y, size = pairs(), np.empty(BLOCK_PAIRS, np.int64), np.empty(BLOCK_PAIRS, np.uint16), 0

        def flushed():
            found = _packed_pairs(x[:size], y[:size])
            for at in range(0, found.num_rows, BLOCK_ROWS):
                yield found.slice(at, BLOCK_ROWS)

        for block in _blocks(batches, "numbers"):
            words, beside = of(*_joined(block.column(0), np.int64))
            at = 0
            while at < len(words):
                to = min(len(words), at + BLOCK_PAIRS - size)
                x[size:size + to - at], y[size:size + to - at] = words[at:to], beside[at:to]
                at, size = to, size + to - at
                if size == BLOCK_PAIRS:
                    yield from flushed()
                    size = 0
        if size:
            yield from flushed()

    return numbers.select("numbers").mapInArrow(count, "x bigint, found binary").repartition("x").sortWithinPartitions("x")


def _by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(words, starts and the end, y, n): the entries of each word added up, from rows (x, found) sorted by x."""

    def added(x, y, n):
        word = np.cumsum(np.concatenate([[0], x[1:] != x[:-1]])).astype(np.int64)
        keys = word << 16 | y
        order = np.argsort(keys, kind="stable")
        starts = _runs(keys[order])
        at = order[starts]
        return x[at], y[at], np.add.reduceat(n[order], starts)

    def packed(x, y, n):
        starts = _runs(x)
        return x[starts], np.append(starts, len(x)), y, n

    held = None
    for batch in filled(batches):
        entries, ends = _joined(batch.column(1), ENTRY)
        rows = (np.repeat(batch.column(0).to_numpy(), np.diff(ends, prepend=0)), entries["y"].astype(np.int64), entries["n"].astype(np.int64))
        x, y, n = added(*(rows if held is None else map(np.concatenate, zip(held, rows))))
        last = int(np.searchsorted(x, x[-1]))  # the next batch may go on with this word
        held = x[last:], y[last:], n[last:]
        if last:
            yield packed(x[:last], y[:last], n[:last])
    if held is not None:
        yield packed(*held)


def exchange(counts: np.ndarray, classes: int, rounds: int = 12) -> np.ndarray:
    """Class of each word from their bigram ``counts``, by single moves that raise the likelihood.

    Words are visited from the most frequent on; ties keep the smaller class.
    """
    size = len(counts)
    at = np.arange(size) % classes
    own = np.eye(classes)
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    counts = counts.astype(np.float64)
    for _ in range(rounds):
        moved = 0
        member = own[at]
        table = member.T @ counts @ member
        for w in range(size):
            old, twice = at[w], counts[w, w]
            after = counts[w] @ member - twice * member[w]  # of w before each class, without itself
            before = counts[:, w] @ member - twice * member[w]
            rest = table.copy()
            rest[old] -= after
            rest[:, old] -= before
            rest[old, old] -= twice
            left, right = rest.sum(axis=1) + before, rest.sum(axis=0) + after
            rows, columns = f(rest + after).sum(axis=1) - f(rest).sum(axis=1), f(rest.T + before).sum(axis=1) - f(rest.T).sum(axis=1)
            corner = np.diag(rest)
            both = (f(corner + after + before + twice) - f(corner)) - (f(corner + after) - f(corner)) - (f(corner + before) - f(corner))
            gain = rows + columns + both - (f(left + after.sum() + twice) - f(left)) - (f(right + before.sum() + twice) - f(right))
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table = rest
            table[new] += after
            table[:, new] += before
            table[new, new] += twice
            if new != old:
                at[w], member[w] = new, own[new]
                moved += 1
        if not moved:
            break
    return at

def _likelihoods(moves: np.ndarray) -> np.ndarray:
    """(2 * classes, classes): log likelihood of a class right after, and right before, a word of each class."""
    moves = moves + 0.5
    return np.concatenate([np.log(moves / moves.sum(axis=0)), np.log(moves / moves.sum(axis=1, keepdims=True)).T])


def _entries(batch: pa.RecordBatch, name: str, *fields: str) -> tuple[np.ndarray, ...]:
    """Starts (and the end) of the lists of structs in a column, and the structs' fields one after the other; null numbers are -1."""
    lists = batch.column(batch.schema.get_field_index(name))
    sizes = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.flatten()
    return (np.concatenate([[0], np.cumsum(sizes)]), *(flat.field(f).fill_null(-1).to_numpy(zero_copy_only=False) for f in fields))


def _leanings(of: np.ndarray, endings: np.ndarray, classes: int) -> np.ndarray:
    """(ENDINGS, classes): log share of the classes among the frequent words with an ending, smoothed by all of them."""
    known = of >= 0
    found = np.bincount(endings[known] * classes + of[known], minlength=ENDINGS * classes).reshape(ENDINGS, classes)
    share = (found.sum(axis=0) + 1) / (found.sum() + classes)
    return np.log((found + 2 * share) / (found.sum(axis=1, keepdims=True) + 2)).astype(np.float32)


def cluster(numbers: DataFrame, frequent: list[bytes], sizes: Sizes, classes: int) -> tuple[np.ndarray, DataFrame | None]:
    """Class of every frequent word, -1 if no classed word ever stands beside it, and (number, class) of all others.

    A word's neighbours are weighed together with the classes that frequent words
    of its ending have, which tells only where the neighbours are few.
    """
    spark = numbers.sparkSession.sparkContext
    endings = np.fromiter(map(ending, frequent), np.int64, len(frequent)) if frequent else np.zeros(1, np.int64)
    frequent = len(frequent)
    first = min(sizes.first, frequent)

    def bigrams():
        def pairs(flat, ends):
            both = (flat >= 0) & (flat < first)
            both = both[:-1] & both[1:] & _neighbours(flat, ends)
            return flat[:-1][both], flat[1:][both]
        return pairs

    counts = _counted(numbers, "numbers", first, bigrams)
    start = exchange(counts, classes)
    member = np.eye(classes)[start]
    moves = member.T @ counts @ member
    of = np.full(max(1, frequent), -1, np.int16)
    of[:first] = start[:first]
    best = None
    for turn in range(sizes.rounds):
        shared = spark.broadcast((of, _likelihoods(moves), _leanings(of, endings, classes), endings))

        def beside():
            known = shared.value[0]

            def pairs(flat, ends):
                same = _neighbours(flat, ends)
                klass = np.where(flat >= 0, known[np.maximum(flat, 0)], -1).astype(np.int64)
                asked = (flat < 0) | (flat >= first)  # the first words keep their classes
                left, right = same & (klass[:-1] >= 0) & asked[1:], same & (klass[1:] >= 0) & asked[:-1]
                return (np.concatenate([flat[1:][left], flat[:-1][right]]),
                        np.concatenate([klass[:-1][left], classes + klass[1:][right]]))
            return pairs

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, weights, leaning, tails = shared.value
            for number, starts, y, n in _by_word(batches):
                tail = np.where(number >= 0, tails[np.maximum(number, 0) % len(tails)], ending_of(number))
                found = []
                for at in range(0, len(number), WORD_BLOCK):
                    of_block = slice(starts[at], starts[min(at + WORD_BLOCK, len(number))])
                    gain = np.add.reduceat(n[of_block, None] * weights[y[of_block]], starts[at:at + WORD_BLOCK][:len(number) - at] - starts[at])
                    found.append(np.argmax(gain + LEANING * leaning[tail[at:at + WORD_BLOCK]], axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.concatenate(found).astype(np.int32))], names=["number", "class"])

        before, best = best, stored(_entries_of_words(numbers, beside).mapInArrow(choose, "number bigint, class int"))
        if before is not None:
            discard(before)
        forget_shuffles(numbers.sparkSession)
        table = best.filter("number >= 0").toArrow()  # at most ``frequent`` rows
        at, new = table.column("number").to_numpy(), table.column("class").to_numpy()
        later = at >= first
        now = of.copy()
        now[at[later]] = new[later]
        moved = int((now != of).sum())
        of = now
        if turn and moved <= sizes.moved * frequent:
            break
        if turn + 1 < sizes.rounds:
            again = spark.broadcast(of)

            def classed():
                known = again.value

                def pairs(flat, ends):
                    klass = np.where(flat >= 0, known[np.maximum(flat, 0)], -1).astype(np.int64)
                    both = (klass[:-1] >= 0) & (klass[1:] >= 0) & _neighbours(flat, ends)
                    return klass[:-1][both], klass[1:][both]
                return pairs

            moves = _counted(numbers, "numbers", classes, classed)
    return of, None if best is None else best.filter("number < 0")


def score_texts(docs: DataFrame, held_out: Column, sizes: Sizes = Sizes(), smoothing: float = 0.1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probabilities of all texts, by a model of those that are not ``held_out``.

    One row per row: ``id_col``, held_out, n_tokens (words and one end), n_known
    (seen in training), train_tokens, base_score (unigrams), score (classes) and
    perplexity. A null text counts as empty: the end alone. A null id is kept, repeated
    rows count and are scored each, other columns are ignored, an empty table
    gives no rows; without training texts every word is unknown. A word never
    seen in training, or never beside a classed word, has the class that most
    training words of its ending have.
    """
    key = docs.schema[id_col].dataType.simpleString()
    spark = docs.sparkSession.sparkContext
    all_texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    texts = all_texts.filter(~F.col("held_out")).select("text")
    vocabulary = word_counts(texts)
    seen = vocabulary.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = texts.count()
    total, distinct = (seen["n"] or 0) + ends, seen["v"] + (ends > 0)
    counts = frequent_words(vocabulary, sizes.frequent)
    frequent, classes = len(counts), sizes.number(seen["v"])
    ranks = spark.broadcast({w: k for k, w in enumerate(counts)})
    numbers = as_numbers(all_texts, ranks)
    of, others = cluster(numbers.filter(~F.col("held_out")), list(counts), sizes, classes)
    rare = numbered_words(vocabulary, ranks)
    if others is not None:
        rare = rare.join(others, "number", "left")
    else:
        rare = rare.withColumn("class", F.lit(None).cast("int"))
    rare = stored(rare)

    # a word without a class of its own takes the class that most words of its ending have, of all words if there are none
    by_ending = np.zeros((ENDINGS, classes), np.int64)
    tail = (-(F.col("number") + 1)).bitwiseAND(F.lit(ENDINGS - 1)).alias("ending")
    for r in rare.filter("class is not null").groupBy(tail, "class").count().collect():  # at most ENDINGS * classes rows
        by_ending[r["ending"], r["class"]] = r["count"]
    for w, c in zip(counts, of):
        if c >= 0:
            by_ending[ending(w), c] += 1
    default = np.where(by_ending.any(axis=1), by_ending.argmax(axis=1), by_ending.sum(axis=0).argmax()).astype(np.uint8)

    # distinct words of each class
    of = np.where(of < 0, default[[ending(w) for w in counts] or [0]], of).astype(np.uint8)
    members = np.bincount(of[:frequent], minlength=classes + 1)
    for r in rare.filter("class is not null").groupBy("class").count().collect():
        members[r["class"]] += r["count"]
    for r in rare.filter("class is null").groupBy(tail).count().collect():
        members[default[r["ending"]]] += r["count"]
    members[classes] = 1
    logs = np.log10(np.fromiter(counts.values(), np.float64, frequent) + smoothing) if frequent else np.zeros(1)
    shared = spark.broadcast((of, logs, default))

    # the words of each text that are not broadcast meet their counts and classes
    def rare_of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, "numbers"):
            found = [np.unique(x[x < 0]) for x in (np.frombuffer(b, np.int64) for b in arrays(batch, "numbers"))]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(np.concatenate(found))], names=["uid", "number"])

    asked = numbers.select("uid", "numbers").mapInArrow(rare_of_text, "uid bigint, number bigint")
    met = asked.join(rare, "number").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("number", "c", "class"))).alias("met"))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, log, default = shared.value
        for batch in _blocks(batches, "numbers"):
            rows = []
            starts, *fields = _entries(batch, "met", "number", "c", "class")
            for k, data in enumerate(arrays(batch, "numbers")):
                at = np.frombuffer(data, np.int64)
                common = at >= 0
                klass = default[ending_of(at)]
                klass[common] = known[at[common]]
                c = np.zeros(len(at))
                met_number, met_c, met_class = (f[starts[k]:starts[k + 1]] for f in fields)
                if len(met_number):
                    place = np.minimum(np.searchsorted(met_number, at), len(met_number) - 1)
                    hit = met_number[place] == at
                    c[hit] = met_c[place[hit]]
                    hit &= met_class[place] >= 0
                    klass[hit] = met_class[place[hit]]
                n_known = int(common.sum() + (c > 0).sum())
                score = float(log[at[common]].sum() + np.log10(c[~common] + smoothing).sum())
                rows.append((len(at) + 1, n_known, score, klass.tobytes()))
            n, k, s, b = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.float64()), pa.array(b, pa.binary())],
                names=["id", "held_out", "n_tokens", "n_words", "logs", "classes"])

    beside = numbers.join(met, "uid", "left").select("id", "held_out", "numbers", "met")
    classed = stored(beside.mapInArrow(
        classify, f"id {key}, held_out boolean, n_tokens bigint, n_words bigint, logs double, classes binary"))

    def framed(at: np.ndarray) -> np.ndarray:
        """Classes of a text between two ends; the class of the end also stands before a text."""
        return np.concatenate([[classes], at, [classes]]).astype(np.int64)

    def transitions():
        def pairs(flat, ends):
            at = np.insert(flat.astype(np.int64), np.concatenate([[0], ends]), classes)  # an end stands between two texts
            return at[:-1], at[1:]
        return pairs

    moves = _counted(classed.filter(~F.col("held_out")), "classes", classes + 1, transitions, np.uint8)
    of_class = moves.sum(axis=0)
    prior = (of_class + 1) / (of_class.sum() + classes + 1)
    step = np.log10((moves + 5 * prior) / (moves.sum(axis=1, keepdims=True) + 5)) - np.log10(of_class + smoothing * (members + 1))
    stepped = spark.broadcast(step)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = stepped.value
        for batch in filled(batches):
            sums = []
            for data in arrays(batch, "classes"):
                at = framed(np.frombuffer(data, np.uint8))
                sums.append(float(table[at[:-1], at[1:]].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(5)] + [pa.array(sums, pa.float64())], names=[*batch.schema.names[:5], "steps"])

    measured = classed.mapInArrow(measure, f"id {key}, held_out boolean, n_tokens bigint, n_words bigint, logs double, steps double")
    logs_of = F.col("logs") + F.lit(float(np.log10(ends + smoothing)))
    norm = float(np.log10(total + smoothing * (distinct + 1)))
    return measured.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_words") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), (logs_of - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (logs_of + F.col("steps")).alias("score"), F.pow(F.lit(10.0), -(logs_of + F.col("steps")) / F.col("n_tokens")).alias("perplexity"),
    )
