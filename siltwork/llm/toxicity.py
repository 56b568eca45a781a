"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the hashed words of a text, and the words' first four to eight bytes, is trained in numpy from confirmed toxic documents (P) and
unlabelled text (U, drawn from all documents of the learning folds, whatever their label). With the class prior
pi, the risk is estimated as ``pi * E_P[l(+)] + max(0, E_U[l(-)] - pi * E_P[l(-)])``: U's loss as negatives less
the part that hidden positives must have in it. Where the corrected negative part falls below zero, the step goes against
it instead, so the model can't win by remembering U. Each step is over all drawn rows: in small batches the
correction's noise would hold the margins down. Only features that mostly toxic documents have, by their shares in
P and U and the prior, take part, so that a long text gathers no noise. With logistic loss the
model's probability is that of the true class, so 0.5 is the threshold.

The prior is the toxic share of the labelled rows of the learning folds, repeated ones included; without labels of both
kinds all scores are 0. A document teaches once for each of its rows, however often its label is repeated; which rows
teach is drawn by a hash of key and words, so it does not depend on the table's layout. A null or empty text has no
words and scores what the intercept says. A document counts each of its words once. Repeated rows are scored as often
as they occur; an empty table gives no rows. Other columns stay out, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.common import fold, unused
from siltwork.llm.langid import byte_columns

#: Rows that teach at most: confirmed toxic ones and unlabelled ones, drawn by a hash of their key.
POSITIVE_ROWS, UNLABELLED_ROWS = 3000, 9000
#: Words are hashed to so many places.
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)
STEPS, RATE, SHRINK = 400, 0.1, 2e-2
#: Positive rows (and their part) that must share a feature, standard errors by which its share must exceed that in U, and the least
#: share of toxic documents among those that have it, by the prior.
LEAST_ROWS, LEAST_PART, LEAST_Z, LEAST_SHARE = 3, 0.005, 6.0, 0.5
MEMORY_WORDS = 600_000
_NOT_WORD = re.compile(rb"[\x00-\x26\x28-\x40\x5b-\x60\x7b-\x7f]+")


class _Hashed(dict):
    """word -> the places of the word and of its beginnings."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > MEMORY_WORDS:
            self.clear()
        places = self[word] = tuple(crc32(x) % BUCKETS for x in (word, *(b"%d:%s" % (n, word[:n]) for n in BEGINNINGS if len(word) >= n)))
        return places


def word_places(text: bytes, hashed: _Hashed) -> np.ndarray:
    """The different places of the text's words: A-Z lower-cased, cut at what is neither a letter nor an apostrophe."""
    words = set(_NOT_WORD.sub(b" ", text.lower()).split())
    return np.unique(np.fromiter(chain.from_iterable(map(hashed.__getitem__, words)), np.int32))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = _Hashed()
    for batch in batches:
        data, offsets = byte_columns(batch.column(1))
        data = data.tobytes()
        found = [word_places(data[a:b], hashed) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.astype("<i4").tobytes() for f in found], pa.binary())], names=["toxic", "places"])


class Classifier:
    """sigmoid(intercept + sum of the weights of a text's words)."""

    def __init__(self, weights: np.ndarray, intercept: float):
        used = np.flatnonzero(weights)
        self.used, self.weights, self.intercept = used.astype(np.int32), weights[used].astype(np.float64), float(intercept)

    def table(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.used] = self.weights
        return out


def _margin(rows: tuple[np.ndarray, np.ndarray], w: np.ndarray, b: float) -> np.ndarray:
    places, ends = rows
    sums = np.concatenate([[0.0], w[places].cumsum()])
    return b + sums[ends[1:]] - sums[ends[:-1]]


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = STEPS) -> Classifier:
    """Adam on the non-negative risk."""
    packed = [(np.concatenate([*x, np.zeros(0, np.int32)]), np.concatenate([[0], np.cumsum([len(y) for y in x])]).astype(np.int64)) for x in (positive, unlabelled)]
    # Features no more frequent in P than in U tell nothing; their weights stay zero.
    rows, of = [max(len(x), 1) for x in (positive, unlabelled)], [np.bincount(x[0], minlength=BUCKETS) for x in packed]
    share = (of[1] + 1) / (rows[1] + 1)
    clear = of[0] / rows[0] - share >= LEAST_Z * np.sqrt(share * (1 - share) / rows[0])
    known = np.flatnonzero((of[0] >= np.maximum(LEAST_ROWS, LEAST_PART * rows[0])) & clear & (prior * of[0] / rows[0] >= LEAST_SHARE * share))
    index = np.full(BUCKETS, -1, np.int64)
    index[known] = np.arange(len(known))

    def narrowed(rows: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        places, ends = index[rows[0]], rows[1]
        keep = places >= 0
        return places[keep], np.concatenate([[0], keep.cumsum()])[ends]

    pos, unl = map(narrowed, packed)
    n, np_, nu = len(known), rows[0], rows[1]
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        rate = RATE * (1 - (step - 1) / steps)
        fp, fu = _margin(pos, w, b), _margin(unl, w, b)
        sp, su = (1 / (1 + np.exp(-np.clip(f, -30, 30))) for f in (fp, fu))
        negative = np.logaddexp(0, fu).sum() / nu - prior * np.logaddexp(0, fp).sum() / np_
        # Derivatives by the margin: l(+) has s - 1, l(-) has s.
        if negative >= 0:
            gp, gu = prior * (sp - 1) / np_ - prior * sp / np_, su / nu
        else:
            gp, gu = prior * sp / np_, -su / nu
        g = np.zeros(n + 1)
        for (places, ends), d in ((pos, gp), (unl, gu)):
            g[:n] += np.bincount(places, weights=np.repeat(d, np.diff(ends)), minlength=n)[:n]
            g[n] += d.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
        w -= move[:n]
        b -= move[n]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * SHRINK, 0)
    out = np.zeros(BUCKETS)
    out[known] = w
    return Classifier(out, b)


def train(docs: DataFrame, labels: DataFrame, *, positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Classifier | None:
    """A classifier from docs (doc_id, text) and labels (doc_id, toxic) of the learning folds; None without labels of both kinds."""
    counts = labels.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not counts[0] or not counts[1]:
        return None
    drawn = lambda df, salt, n: df.select("doc_id").where(F.col("doc_id").isNotNull()).orderBy(F.xxhash64(F.lit(salt), "doc_id"), "doc_id").limit(n)
    wanted = drawn(labels.where("toxic = 1").join(docs.select("doc_id"), "doc_id", "left_semi"), "toxic", positive_rows).withColumn("toxic", F.lit(1))
    wanted = wanted.union(drawn(docs, "unlabelled", unlabelled_rows).withColumn("toxic", F.lit(0)))
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted.distinct()), "doc_id").select("toxic", F.col("text").cast("binary").alias("text"))
    # Where a drawn key has many rows, a hash draws among them too.
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("places"), "places"))
    most = F.when(F.col("toxic") == 1, positive_rows).otherwise(unlabelled_rows)
    got = rows.mapInArrow(_places, "toxic int, places binary").withColumn("nth", nth).where((F.col("nth") <= max(positive_rows, unlabelled_rows)) & (F.col("nth") <= most)).drop("nth").toArrow()
    found = {0: [], 1: []}
    for toxic, places in sorted(zip(got.column("toxic").to_pylist(), got.column("places").to_pylist(), strict=True)):  # in an order that runs share
        found[toxic].append(np.frombuffer(places, "<i4"))
    return fit(found[1], found[0], counts[0] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """docs with score and predicted; a table that has columns of these names is refused."""
    if any(unused(docs.columns, x) != x for x in ("score", "predicted")):
        raise ValueError("the table has a column score or predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        hashed, table = _Hashed(), None if model is None else model.table()
        for batch in batches:
            n = batch.num_columns - 1
            data, offsets = byte_columns(batch.column(n))
            data, margins = data.tobytes(), np.full(len(batch), -np.inf)
            if model is not None:
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    margins[i] = model.intercept + table[word_places(data[a:b], hashed)].sum()
            p = np.zeros(len(batch)) if model is None else 1 / (1 + np.exp(-np.maximum(margins, -700)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*batch.schema.names[:n], "score", "predicted"])

    return docs.select("*", F.col("text").cast("binary").alias(unused(docs.columns, "_bytes"))).mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. A fifth of the keys teaches nothing."""
    learning = fold("doc_id", 5) != 0
    model = train(docs.where(learning), labels.where(learning))
    rows = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return score(rows, model).select("doc_id", "held_out", "score", "predicted")
