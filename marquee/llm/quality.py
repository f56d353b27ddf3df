"""Quality by nearest-neighbour voting among labelled documents in a latent space.

A document is a sparse vector of hashed words and of word shapes (letter case,
marks, repetition of the word before). The labelled sample gives the inverse
document frequencies and, by a singular value decomposition, the latent
directions. Labelled vectors and directions are broadcast; their size is bounded
by the parameters. Every document is projected and compared with every labelled
vector in blocked matrix products, and the nearest labels vote by similarity.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import Kept, arrays, filled, sample_ids

WORDS, SHAPES = 1536, 1024
TERMS = WORDS + SHAPES
AGAIN = WORDS  # the shape term of a word that repeats the word before
BLOCK = 512


_LETTERS = re.compile(r"[^\W\d_]+")
_ALIKE = re.compile(r"([^A-Za-z])\1{2,}")


def _run(letters: str) -> str:
    return "x" if letters.islower() else "X" if letters.isupper() else "Xx" if letters[1:].islower() else "xX"


def _shape(word: str) -> str:
    """Runs of letters by their case, marks and digits as they are, at most two alike in a row."""
    if word.isalpha():
        return _run(word)
    return _ALIKE.sub(r"\1\1", _LETTERS.sub(lambda m: _run(m[0]), word[:60]))


def _terms(word: str) -> int:
    """The word's term and its shape's term, packed into one number."""
    own = xxhash.xxh3_64_intdigest(word.lower()) % WORDS
    shape = WORDS + 1 + xxhash.xxh3_64_intdigest(_shape(word)) % (SHAPES - 1)
    return own << 16 | shape


_TERMS = Kept(_terms)


def features(text: str | None) -> np.ndarray:
    """Square roots of term shares; zeros for a text without words."""
    found = text.split() if text else []
    if not found:
        return np.zeros(TERMS, np.float32)
    packed = np.fromiter(map(_TERMS.__getitem__, found), np.int64, len(found))
    counts = np.bincount(packed >> 16, minlength=TERMS) + np.bincount(packed & 0xFFFF, minlength=TERMS)
    counts[AGAIN] = sum(map(str.__eq__, found, found[1:]))
    return np.sqrt(counts / len(found)).astype(np.float32)


@dataclass
class Neighbours:
    """What is broadcast: term weights, directions, labelled vectors with their votes."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray  # (labelled, 2): weight, weight of label 1
    prior: float
    k: int

    def project(self, x: np.ndarray) -> np.ndarray:
        y = (x * self.weights) @ self.directions
        norm = np.linalg.norm(y, axis=1, keepdims=True)
        return y / np.where(norm > 0, norm, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Share of label 1 among the votes of the ``k`` nearest; the prior has a small vote too."""
        if not len(self.vectors):
            return np.full(len(x), self.prior)
        near = self.project(x) @ self.vectors.T
        k = min(self.k, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        close = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** 4
        votes = (close[:, :, None] * self.votes[best]).sum(axis=1)
        return (votes[:, 1] + 0.01 * self.prior) / (votes[:, 0] + 0.01)


def _leading(z: np.ndarray, latent: int, steps: int = 16) -> np.ndarray:
    """The leading right singular vectors of ``z``, by subspace iteration: no square matrix of all terms is held."""
    size = min(latent + 16, *z.shape)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((z.shape[1], size), np.float32))[0]
    for _ in range(steps):
        q = np.linalg.qr(z.T @ (z @ q))[0]
    inner = np.linalg.svd(z @ q, full_matrices=False)[2]
    return (q @ inner.T)[:, :latent]


def fit(docs: DataFrame, labels: DataFrame, per_class: int, latent: int, k: int, folds: int,
        label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Neighbours:
    """Learn from at most ``per_class`` documents of each class outside fold 0."""
    taken = sample_ids(labels, label, per_class, folds, id_col)
    # at most 2 * per_class ids by construction
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(taken), "id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            data = [features(x).tobytes() for x in arrays(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(data, pa.binary())],
                                             names=["id", "label", "share", "x"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, label int, share double, x binary"
    # one row per id, however often a document is repeated
    rows = (sample.select("id", "label", "share", "text").mapInArrow(vectors, schema)
            .groupBy("id").agg(F.min_by(F.struct("label", "share", "x"), "x").alias("r")).orderBy("id").select("r.*").collect())
    if not rows:
        return Neighbours(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros((0, 2)), 0.5, k)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    y = np.array([r["label"] for r in rows], np.float64)
    weight = 1 / np.array([r["share"] for r in rows])
    del rows
    idf = np.log((len(x) + 1) / ((x > 0).sum(axis=0) + 0.5)).clip(0.05).astype(np.float32)
    z = x * idf
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    z /= np.where(norm > 0, norm, 1)
    directions = _leading(z, latent)
    model = Neighbours(idf, directions, np.zeros((0, 1)), np.stack([weight, weight * y], axis=1),
                       float((weight * y).sum() / weight.sum()), k)
    model.vectors = model.project(x).astype(np.float32)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1024, latent: int = 48, k: int = 15, threshold: float = 0.3,
                  folds: int = 5, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                  model: Neighbours | None = None, row_col: str | None = None) -> DataFrame:
    """``row_col`` (by default ``id_col``, by which labels are found), score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= ``threshold``) per row.

    Learns from a bounded sample, ``per_class`` labelled documents of each class.
    A null or empty text has no vector, so only the prior votes. A null id is
    kept, repeated rows each get a row, other columns are ignored, an empty table
    gives no rows; without labels every score is 0.5.
    """
    model = model or fit(docs, labels, per_class, latent, k, folds, label, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row_col = row_col or id_col
    key = docs.schema[row_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in filled(batches):
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                scores = known.score(np.stack([features(x) for x in arrays(batch, text_col)]))
                scores = np.clip(scores, 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))],
                    names=[row_col, "score", "predicted"])

    return docs.select(row_col, text_col).mapInArrow(score, f"`{row_col}` {key}, score double, predicted int")
