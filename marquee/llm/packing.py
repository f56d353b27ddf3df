"""Bounded-space packing of token ids into fixed windows.

Each partition keeps at most ``open_windows`` windows. Whole windows are cut off
a long document; the rest goes to the window that it fills best. When it fits
nowhere, the fullest window is topped up with the head of the piece and emitted
full. What is left in the open windows, at most ``open_windows`` windows per
partition, is merged by groups of partitions; the last window of a group is
emitted as windows of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import CACHE_WORDS, arrays, filled, stored

# Partitions whose open windows one task merges.
MERGED = 64
_CUT = re.compile(r"(?= \S)")
_UNSAFE = re.compile(r" (?:\s|\Z)")


# How byte-level tokenizers of this kind cut a text before the merges: fixed value.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_COMMON = re.compile(r"[\x00-\u024F]*\Z")


class Encoder:
    """Ids of texts by a byte-level tokenizer, as little-endian 32-bit bytes.

    The pattern of these tokenizers always starts a new piece at a space that a
    non-space follows, so a text may be cut there and each distinct part is
    encoded once. For the same reason many parts are encoded by one call, as one
    text, and their ids told apart by the bytes they stand for. Parts of common
    letters go through the same vocabulary held as ranks, which is three times
    faster; parts with other letters or with a special token go through the
    tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        before = settings["pre_tokenizer"]
        if settings["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("texts of this tokenizer cannot be cut before a space")
        self.special = [x["content"] for x in settings["added_tokens"]]
        ranks = {_raw(x): rank for x, rank in settings["model"]["vocab"].items() if x not in self.special}
        self.ranks = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(x) for x in ranks]
        self.parts: dict[str, bytes] = {}  # of texts as they are
        self.spaced: dict[str, bytes] = {}  # of a space and the key

    def _is_plain(self, part: str) -> bool:
        return bool(_COMMON.match(part)) and not any(x in part for x in self.special)

    def _ids(self, part: str) -> bytes:
        if self._is_plain(part):
            ids = self.ranks.encode_ordinary(part)
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _all_ids(self, parts: list[str]) -> list[bytes]:
        """``_ids`` of parts that each begin with a space and a non-space."""
        joined = "".join(parts)
        if not self._is_plain(joined):
            plain = [x for x in parts if self._is_plain(x)]
            if len(plain) == len(parts):  # only together they hold a special token
                return [self._ids(x) for x in parts]
            found = iter(self._all_ids(plain))
            kept = set(plain)
            return [next(found) if x in kept else self._ids(x) for x in parts]
        ids = np.array(self.ranks.encode_ordinary(joined), "<u4")
        sizes = map(len, parts) if joined.isascii() else (len(x.encode()) for x in parts)
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(parts)))
        at = [0, *(4 * np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 4).tolist()]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [_CUT.split(x) if _UNSAFE.search(x) else None for x in texts]
        split = [None if parts else x.split(" ") for x, parts in zip(texts, plain)]
        heads = {x[0] for x in split if x}
        new_spaced = set().union(*(x[1:] for x in split if x)).difference(self.spaced)
        new_parts = heads.union(*(x for x in plain if x)).difference(self.parts)
        spaced = list(new_spaced)
        self.spaced.update(zip(spaced, self._all_ids([f" {x}" for x in spaced])))
        cut = [x for x in new_parts if _CUT.match(x)]
        self.parts.update(zip(cut, self._all_ids(cut)))
        self.parts.update((x, self._ids(x)) for x in new_parts.difference(cut))
        found = [
            b"".join(map(self.parts.__getitem__, parts)) if parts
            else self.parts[x[0]] + b"".join(map(self.spaced.__getitem__, x[1:]))
            for parts, x in zip(plain, split)
        ]
        for cache, new in ((self.spaced, new_spaced), (self.parts, new_parts)):
            if len(cache) > CACHE_WORDS:
                for x in new:
                    del cache[x]
        return found


def _raw(piece: str) -> bytes:
    """The bytes of a byte-level piece: printable bytes stand for themselves, the others follow from 256 on."""
    return bytes(_BYTES[c] for c in piece)


_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


@functools.cache
def encoder(path: str) -> Encoder:
    """Kept by a Python worker from task to task."""
    return Encoder(path)


class Packer:
    """Open windows of one task. ``emit`` gets (window, offset, piece) for closed windows.

    A piece is (doc_id, start, ids as bytes, tokens of the document).
    """

    def __init__(self, size: int, open_windows: int, first: int):
        self.size, self.most, self.next = size, open_windows, first
        self.open: list[tuple[int, list]] = []  # (tokens, pieces)
        self.closed: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.closed.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        ids = memoryview(ids)
        while ids:
            n = len(ids) // 4
            if n >= self.size:
                self._close([(doc, start, ids[:4 * self.size], total)])
                ids, start = ids[4 * self.size:], start + self.size
                continue
            fits = [k for k, (used, _) in enumerate(self.open) if used + n <= self.size]
            if fits:
                k = max(fits, key=lambda i: self.open[i][0])
                used, pieces = self.open[k]
                pieces.append((doc, start, bytes(ids), total))
                if used + n == self.size:
                    self._close(self.open.pop(k)[1])
                else:
                    self.open[k] = (used + n, pieces)
                return
            if len(self.open) < self.most:
                self.open.append((n, [(doc, start, bytes(ids), total)]))
                return
            k = max(range(len(self.open)), key=lambda i: self.open[i][0])
            used, pieces = self.open.pop(k)
            room = self.size - used
            self._close([*pieces, (doc, start, ids[:4 * room], total)])
            ids, start = ids[4 * room:], start + room

    def finish(self) -> None:
        """Close what is open as windows whose lengths are powers of two."""
        rest = [x for _, pieces in self.open for x in pieces]
        self.open = []
        left = sum(len(x[2]) // 4 for x in rest)
        while left:
            room = min(self.size, 1 << (left.bit_length() - 1))
            left -= room
            taken = []
            while room:
                doc, start, ids, total = rest.pop(0)
                n = min(room, len(ids) // 4)
                taken.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    rest.insert(0, (doc, start + n, ids[4 * n:], total))
                room -= n
            self._close(taken)

    def take(self) -> list[tuple]:
        done, self.closed = self.closed, []
        return done


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, open_windows: int = 16,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and then ``end_id``; a null text counts as
    empty and gives the end alone. A null id is kept, repeated rows are documents
    of their own, other columns are ignored, an empty table gives no rows. A long
    document fills windows of its own; its last part is packed. Every window is
    full or a power of two long. Ties go to the window opened first.
    """
    key = docs.schema[id_col].dataType.simpleString()
    kind = pa.int64() if key == "bigint" else None
    end = np.array([end_id], "<u4").tobytes()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]
    schema = (f"`{id_col}` {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, ids binary, part int")

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7]),
             pa.array(columns[7], pa.binary()), pa.array(columns[8], pa.int32())], names=names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packer, encode = Packer(size, open_windows, part << 40), encoder(tokenizer_path).encode
        for batch in filled(batches):
            ids, texts = arrays(batch, id_col), arrays(batch, text_col)
            for at in range(0, len(ids), 128):
                for doc, found in zip(ids[at:at + 128], encode([x or "" for x in texts[at:at + 128]])):
                    packer.add(doc, 0, found + end, len(found) // 4 + 1)
                if done := packer.take():
                    yield rows([(*x, None, None) for x in done])
        if left := [x for _, pieces in packer.open for x in pieces]:
            yield rows([(doc, start, len(ids) // 4, None, total, None, None, ids, part // MERGED)
                        for doc, start, ids, total in left])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != group:
                    if packer:
                        packer.finish()
                        yield rows([(*x, None, None) for x in packer.take()])
                    group = row["part"]
                    packer = Packer(size, open_windows, 1 << 62 | group << 40)
                packer.add(row[id_col], row["start"], row["ids"], row["doc_tokens"])
        if packer:
            packer.finish()
            yield rows([(*x, None, None) for x in packer.take()])

    placed = stored(docs.select(id_col, text_col).mapInArrow(place, schema))
    left = placed.filter("part is not null")
    merged = left.repartition("part").sortWithinPartitions("part", F.desc("length"), id_col, "start").mapInArrow(merge, schema)
    return placed.filter("part is null").unionByName(merged).drop("ids", "part")
