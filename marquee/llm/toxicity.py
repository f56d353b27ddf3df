"""Toxicity by class-conditional Kneser-Ney bigram models.

Toxic and ordinary labelled documents give a bigram model each. Pairs count by
the different words after them and words by the different words before them, so
copies of a document count once. An absolute discount moves the mass of rare
pairs to the class's unigrams, and that of rare words to counts shared by both
classes, so an expression seen too rarely in either class says nothing. A document is judged by the difference of
its two log-likelihoods per word, over the whole text and over its most toxic
windows; a logistic fit on labelled documents that the counts left out turns
these into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import HASHES, Cached, arrays, filled, sample_ids, stored, words

WINDOWS = (1, 4, 16, 64)
START = 0  # stands before the first word


@dataclass
class Ratios:
    """Log-likelihood ratios, toxic over ordinary; sorted tables bounded by the labelled sample."""

    vocabulary: np.ndarray  # hashes of the words with a ratio of their own
    unigram: np.ndarray  # ratio of a word backed off to unigrams
    context: np.ndarray  # ratio of the backoff weights after a word
    pairs: np.ndarray  # place of the first word * size + place of the second
    pair: np.ndarray  # ratio of the pair
    unknown: float  # ratio of any other word
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 + len(WINDOWS)))

    def place(self, word: bytes) -> int:
        h = HASHES[word]
        k = int(np.searchsorted(self.vocabulary, np.uint64(h)))
        return k if k < len(self.vocabulary) and int(self.vocabulary[k]) == h else -1

    def signs(self, text: str | None, places: Cached) -> np.ndarray:
        """One, the mean ratio and the highest window means; zeros after the one without words."""
        found = words(text)
        if not found:
            return np.eye(1, 2 + len(WINDOWS))[0]
        at = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
        # the place -1 is the last entry: unknown
        ratio = self.unigram[at]
        ratio[1:] += self.context[at[:-1]]
        both = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
        if len(both) and len(self.pairs):
            code = at[both] * len(self.vocabulary) + at[both + 1]
            k = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            hit = self.pairs[k] == code
            ratio[both[hit] + 1] = self.pair[k[hit]]
        total = np.concatenate([[0.0], np.cumsum(ratio)])
        signs = [1.0, total[-1] / len(ratio)]
        for size in WINDOWS:
            wide = min(size, len(ratio))
            signs.append((total[wide:] - total[:-wide]).max() / size)
        return np.array(signs)

    def score(self, signs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(signs @ self.weights, -30, 30)))


def _pairs(sample: DataFrame) -> DataFrame:
    """(v, w, n0, n1): by how many different words v w is followed in ordinary and toxic documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            for label, text in zip(arrays(batch, "label"), arrays(batch, "text")):
                found = words(text)
                if not found:
                    continue
                h = np.zeros(len(found) + 2, np.uint64)  # START on both sides
                h[1:-1] = np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))
                h = h.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:-2]), pa.array(h[1:-1]), pa.array(h[2:]), pa.array(np.full(len(found), label, np.int32))],
                    names=["v", "w", "x", "label"])

    found = sample.select("label", "text").mapInArrow(count, "v bigint, w bigint, x bigint, label int").distinct()
    return stored(found.groupBy("v", "w").agg(*(F.count(F.when(F.col("label") == k, 1)).alias(f"n{k}") for k in (0, 1))))


def _numbers(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def _share(part: np.ndarray, whole: np.ndarray, otherwise: float) -> np.ndarray:
    return np.where(whole > 0, part / np.where(whole > 0, whole, 1), otherwise)


def ratios(pairs: DataFrame, discount: float) -> Ratios:
    """Both models as one table of ratios; only counts above the discount are collected, and those of the second words of such pairs."""
    kept = f"n0 > {discount} or n1 > {discount}"
    small = [F.sum(F.least(f"n{k}", F.lit(discount))).alias(f"m{k}") for k in (0, 1)]
    large = [F.sum(f"n{k}").alias(f"n{k}") for k in (0, 1)]
    by_word = stored(pairs.groupBy("w").agg(*(F.count(F.when(F.col(f"n{k}") > 0, 1)).alias(f"n{k}") for k in (0, 1))))
    total = by_word.agg(*large, *small).first()
    second = pairs.filter(kept).select("w", F.lit(True).alias("second")).distinct()
    uni = _numbers(by_word.join(second, "w", "left").filter(f"{kept} or second").select("w", "n0", "n1"))
    ctx = _numbers(pairs.groupBy("v").agg(*large, *small).filter("n0 > m0 or n1 > m1"))
    bi = _numbers(pairs.filter(kept))

    vocabulary = np.unique(np.concatenate([uni["w"], ctx["v"]]).view(np.uint64))
    place = lambda h: np.searchsorted(vocabulary, h.view(np.uint64))
    size = len(vocabulary)
    held = np.isin(bi["v"].view(np.uint64), vocabulary) & np.isin(bi["w"].view(np.uint64), vocabulary)
    bi = {name: column[held] for name, column in bi.items()}  # a word without a place would take another's
    # what the discount takes from both classes is given back by these shared counts
    shared = (np.minimum(uni["n0"], discount) + np.minimum(uni["n1"], discount)) / (total["m0"] + total["m1"])
    logs, weight, probability = [], [], []
    for k in (0, 1):
        n = total[f"n{k}"]
        back = total[f"m{k}"] / n
        p = np.maximum(uni[f"n{k}"] - discount, 0) / n + back * shared
        of = np.full(size + 1, np.nan)
        of[place(uni["w"])] = p
        probability.append(of)
        logs.append((np.log(p), np.log(back)))
        of = np.ones(size + 1)
        of[place(ctx["v"])] = _share(ctx[f"m{k}"], ctx[f"n{k}"], 1.0)
        weight.append(of)
    count = [np.zeros(size + 1) for _ in (0, 1)]
    for k in (0, 1):
        count[k][place(ctx["v"])] = ctx[f"n{k}"]
    unknown = float(logs[1][1] - logs[0][1])
    unigram = np.full(size + 1, unknown)
    unigram[place(uni["w"])] = logs[1][0] - logs[0][0]
    v, w = place(bi["v"]), place(bi["w"])
    p = [_share(np.maximum(bi[f"n{k}"] - discount, 0), count[k][v], 0.0) + weight[k][v] * probability[k][w] for k in (0, 1)]
    code = v * size + w
    order = np.argsort(code)
    return Ratios(vocabulary, unigram, np.log(weight[1]) - np.log(weight[0]), code[order], np.log(p[1][order] / p[0][order]), unknown)


def _signs(df: DataFrame, model: Ratios) -> DataFrame:
    """(label, share, signs) of labelled documents."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Cached(shared.value.place)
        for batch in filled(batches):
            signs = [shared.value.signs(x, places) for x in arrays(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(signs, pa.list_(pa.float64()))], names=["label", "share", "signs"])

    return df.select("label", "share", "text").mapInArrow(measure, "label int, share double, signs array<double>")


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps of a weighted logistic regression."""
    b = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + keep, x.T @ (weight * (y - p)) - keep @ b)
        b += np.clip(step, -5, 5)
    return b


def fit(docs: DataFrame, labels: DataFrame, per_class: int, discount: float, folds: int,
        label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Ratios | None:
    """Learn from at most ``per_class`` documents of each class outside fold 0; None if a class has none."""
    taken = stored(sample_ids(labels, label, per_class, folds, id_col))
    if taken.select("label").distinct().count() < 2:
        return None
    # at most 2 * per_class ids by construction; one row per id, however often a document is repeated
    sample = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(taken), "id")
                    .groupBy("id", "label", "share").agg(F.max("text").alias("text")))
    left_out = F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(5)) == 0
    pairs = _pairs(sample.filter(~left_out))
    seen = pairs.agg(F.sum("n0"), F.sum("n1")).first()
    if not seen[0] or not seen[1]:
        return None
    model = ratios(pairs, discount)
    rows = _signs(sample.filter(left_out), model).collect()
    if len({r["label"] for r in rows}) < 2:
        return None
    x = np.array([r["signs"] for r in rows])
    weight = np.array([1 / r["share"] for r in rows])
    model.weights = _logistic(x, np.array([r["label"] for r in rows], float), weight / weight.mean())
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 4000, discount: float = 2.0, threshold: float = 0.5,
                   folds: int = 5, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= ``threshold``) per row.

    Learns from a bounded sample, ``per_class`` labelled documents of each class.
    A null or empty text gets the score of a text without evidence. A null id is
    kept, repeated rows each get a row, other columns are ignored, an empty table
    gives no rows. When a class has no labelled text every score is 0.
    """
    model = fit(docs, labels, per_class, discount, folds, label, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        places = Cached(known.place if known else None)
        for batch in filled(batches):
            scores = (known.score(np.stack([known.signs(x, places) for x in arrays(batch, text_col)]))
                      if known else np.zeros(batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(score, f"`{id_col}` {key}, score double, predicted int")
