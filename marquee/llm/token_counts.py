"""Token counts: batches in Arrow functions that return lengths only.

A merge never joins the end of a word to a following space, because no piece of
the vocabulary holds a space after another character (checked when the model is
loaded). So a text may be cut before every space that follows another character,
and its length is the sum of its parts' lengths. Distinct parts of a batch are
encoded once; a batch holds about ``BATCH_BYTES`` of text whatever the number of
rows, and a long text is cut into such batches too.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.shared import CACHE_WORDS, arrays, filled

BATCH_BYTES = 1 << 20
SPACE = "▁"
_AFTER = re.compile(f"(?<=[^ {SPACE}])(?= )")


@functools.cache
def load_pieces(path: str):
    """The sentencepiece model at ``path``, if its texts may be cut before a space, and its cache.

    Both are kept by a Python worker from task to task.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(re.search(f"[^{SPACE}]{SPACE}", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this vocabulary crosses the end of a word")
    if len(model.encode("")) or model.encode(" a", out_type=str)[:1] != [SPACE]:
        raise ValueError("this model trims spaces, so texts cannot be cut before them")
    return model, {}


def cut(text: str, size: int = BATCH_BYTES) -> Iterator[str]:
    """Parts of at least ``size`` characters (but the last), cut at safe boundaries.

    Each part but the first begins with its space. A text without a safe
    boundary stays whole.
    """
    start = 0
    while len(text) - start > size:
        found = _AFTER.search(text, start + size)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def units(part: str, first: bool) -> list[str]:
    """Words with the spaces before them, less the one space that the model puts before a text.

    The empty string stands for a single space at the end.
    """
    found = (part if first else part[1:]).split(" ")
    return [x[1:] for x in _AFTER.split(" " * first + part)] if "" in found or SPACE in part else found


def batches_of(texts: list[str], size: int = BATCH_BYTES) -> Iterator[list[tuple[int, str, bool]]]:
    """(row, part, is the row's first) in lists of about ``size`` bytes."""
    group, held = [], 0
    for row, text in enumerate(texts):
        for k, part in enumerate(cut(text, size) if text else ()):
            group.append((row, part, not k))
            held += len(part)
            if held >= size:
                yield group
                group, held = [], 0
    yield group


def count_tokens(texts: list[str], model, cache: dict[str, int]) -> np.ndarray:
    """Tokens of each text; ``cache`` maps a unit to its count."""
    counts = np.zeros(len(texts), np.int64)
    for group in batches_of(texts):
        split = [(row, units(part, first)) for row, part, first in group]
        seen = set().union(*(x for _, x in split))
        new = [x for x in seen if x and x not in cache]
        cache.update(zip(new, map(len, model.encode(new, num_threads=1))))
        cache[""] = len(model.encode("a ")) - len(model.encode("a"))
        for row, found in split:
            counts[row] += sum(map(cache.__getitem__, found))
        if len(cache) > CACHE_WORDS:
            for x in new:
                del cache[x]
    return counts


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per row.

    No begin, end or added tokens; strings of special tokens are ordinary text,
    which is the library's default. A null text counts as empty: 0 bytes, 0
    tokens. A null id is returned as it is, repeated rows each get a row, other
    columns are ignored. An empty table gives no rows.
    """
    key = docs.schema[id_col].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = load_pieces(model_path)
        for batch in filled(batches):
            texts = [x or "" for x in arrays(batch, text_col)]
            n = count_tokens(texts, model, cache)
            n_bytes = pa.array([len(x.encode()) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        lengths, f"`{id_col}` {key}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
