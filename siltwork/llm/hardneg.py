"""Hard negatives by angular triangle filtering.

Vectors become whole numbers, floor(256 * x) of each component, and a row's score with an anchor is the inner product
of these, exact. Some reference directions are drawn from a bounded sample, and every row stores its angles to them.
On the sphere angles obey the triangle inequality, so from an anchor's and a row's angles a, b to one reference
their own angle lies between |a - b| and min(a + b, 2 pi - a - b): the reference gives an interval of the cosine, all
references together the narrowest, and times both norms, widened by more than any rounding, it bounds the score. Rows
are stored in the order of their nearest reference and their angle to it, in tiles; a tile has the extremes of its rows'
angles and norms. Only tiles whose bounds overlap what an anchor still looks for are scored in whole numbers: for
positives scores above its k-th best so far, for negatives of a positive scores in the window below the positive's
and above the k-th best so far in it.

Rows stay in their tasks; blocks of anchors are broadcast to them (``scan``), and each task sends its best rows only.
On vectors without structure angles to any reference are near 90 degrees, the intervals are wide, and the search is a
scan in exact arithmetic.

Rows with a null id, label or vector, or a null or non-finite component take no part, nor do vectors without components
or of another length than the most frequent one (of the most frequent the shortest). A repeated row is a candidate as
often as it occurs, but rows of an anchor's own id never are its candidates; equal rows are one anchor, rows of one id
that differ are anchors of their own, which anchor_hash tells apart. A positive that occurs twice has two sets of
negatives (positive_rank tells them apart). Ties of scores go to the smaller id. Whole numbers beyond 64 bits are held
at that bound, scores too. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.common import stored
from siltwork.llm.scan import in_place, matrix

#: Reference directions, and vectors that they are drawn from at most.
REFERENCES, SAMPLE = 16, 4096
#: Rows of a tile, and rows that a task takes before it narrows its bounds.
TILE, STEP = 256, 4096
#: Scores that are held at once.
CELLS = 1 << 21
POSITIVES, NEGATIVES, EVERY = 5, 3, 50
#: A negative's score in hundredths of its positive's.
WINDOW = (50, 95)
#: More than angles, cosines and norms are off by rounding: angles are stored in 32 bits.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_EXACT = float(1 << 53)
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FOUND = "anchor_id long, anchor_hash long, part long, id long, score long"


def references(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Directions far from each other: the sample's mean, then each time the vector farthest from all so far."""
    norms = np.sqrt((sample * sample).sum(1))
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    mean = unit.mean(0)
    out = [mean / np.sqrt(mean @ mean) if mean @ mean > 1e-12 else unit[0]]
    nearest = unit @ out[0]
    while len(out) < n and nearest.min() < 1 - 1e-9:
        out.append(unit[nearest.argmin()])
        nearest = np.maximum(nearest, unit @ out[-1])
    return np.array(out)


def angles(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to the references) of rows; a row of zeros is at a right angle to all."""
    x = x.astype(np.float64)
    norms = np.sqrt((x * x).sum(1))
    return norms, np.arccos(np.clip(x @ refs.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))


def score_bounds(low: np.ndarray, high: np.ndarray, norm_low: np.ndarray, norm_high: np.ndarray, to: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) possible scores of tiles with anchors: the tiles' extreme angles and norms, the anchors' angles and norms."""
    near = np.maximum(np.maximum(low[:, None] - to[None], to[None] - high[:, None]).max(2) - ANGLE_SLACK, 0)
    far = np.minimum(np.minimum(high[:, None] + to[None], 2 * np.pi - low[:, None] - to[None]).min(2) + ANGLE_SLACK, np.pi)
    most, least = np.cos(np.minimum(near, np.pi)), np.cos(far)
    a, b = norm_low[:, None] * norm[None], norm_high[:, None] * norm[None]
    least, most = np.where(least < 0, least * b, least * a), np.where(most < 0, most * a, most * b)
    slack = SCORE_SLACK * b + 1e-6
    return least - slack, most + slack


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of rows of whole numbers, exact; in doubles where they hold every sum."""
    size = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0)) * x.shape[1]
    if size < _EXACT:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if size < _MOST / 2:
        return x @ y.T
    return np.clip(x.astype(object) @ y.astype(object).T, _LEAST, _MOST).astype(np.int64)


def first_of_each(group: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: by score, highest first, then by key."""
    order = np.lexsort((key, ~score, group))
    group = group[order]
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    nth = np.arange(len(group)) - np.repeat(start, np.diff(start, append=len(group)))
    return order[nth < k]


class Hunt:
    """What a block of anchors has found so far: of each anchor and each of its parts (low, high) the k first rows."""

    def __init__(self, block: pa.Table, same: bool, k: int, refs: np.ndarray):
        self.same, self.k, self.refs = same, k, refs
        self.ids, self.marks, self.labels = (block.column(c).to_numpy().astype(np.int64) for c in ("id", "mark", "label"))
        self.x = matrix(block.column("c"), "<i8")
        self.norms, self.to = angles(self.x, refs)
        self.low, self.high = (np.array(block.column(c).to_pylist() or np.zeros((0, 1)), np.int64) for c in ("low", "high"))
        self.least = self.low.copy()
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: Pairs of tiles and anchors, all and those that were scored.
        self.pairs = self.scored = 0

    def take(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, norms: np.ndarray, to: np.ndarray) -> None:
        edges = np.arange(0, len(ids), TILE)
        low, high = np.minimum.reduceat(to, edges), np.maximum.reduceat(to, edges)
        some = max(1, CELLS // max(1, len(edges) * len(self.refs)))
        found = [(self.group, self.score, self.id)]
        for a in range(0, len(self.ids), some):
            part = slice(a, a + some)
            least, most = score_bounds(low, high, np.minimum.reduceat(norms, edges), np.maximum.reduceat(norms, edges), self.to[part], self.norms[part])
            overlap = ((most[:, :, None] >= self.least[None, part]) & (least[:, :, None] <= self.high[None, part])).any(2)
            self.pairs += overlap.size
            self.scored += int(overlap.sum())
            for t, at in enumerate(edges.tolist()):
                rows = slice(at, at + TILE)
                chosen = np.flatnonzero(overlap[t]) + a
                for b in range(0, len(chosen), CELLS // TILE):
                    found += self._hits(ids[rows], labels[rows], x[rows], chosen[b : b + CELLS // TILE])
        group, score, key = (np.concatenate(c) for c in zip(*found, strict=True))
        first = first_of_each(group, score, key, self.k)
        self.group, self.score, self.id = group[first], score[first], key[first]
        full = np.flatnonzero(np.bincount(self.group, minlength=self.least.size) >= self.k)
        if len(full):  # rows are by group and score, so a full group's last has its k-th score
            last = np.searchsorted(self.group, full, "right") - 1
            self.least.reshape(-1)[full] = np.maximum(self.least.reshape(-1)[full], self.score[last])

    def _hits(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, anchors: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        score = products(self.x[anchors], x)
        fine = ((self.labels[anchors][:, None] == labels[None]) == self.same) & (self.ids[anchors][:, None] != ids[None])
        parts = self.low.shape[1]
        for w in range(parts):
            i, j = np.nonzero(fine & (score >= self.least[anchors, w][:, None]) & (score <= self.high[anchors, w][:, None]))
            if len(i):
                first = first_of_each(anchors[i] * parts + w, score[i, j], ids[j], self.k)
                i, j = i[first], j[first]
                yield anchors[i] * parts + w, score[i, j], ids[j]

    def batch(self) -> pa.RecordBatch:
        of, part = np.divmod(self.group, self.low.shape[1])
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (self.ids[of], self.marks[of], part, self.id, self.score)], names=["anchor_id", "anchor_hash", "part", "id", "score"])


def _search(refs: np.ndarray, same: bool, k: int):
    def run(block: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(block.value):
            return
        hunt = Hunt(block.value, same, k, refs)
        for whole in batches:
            for lo in range(0, len(whole), STEP):
                b = whole.slice(lo, STEP)
                ids, labels, norms = (b.column(c).to_numpy() for c in ("id", "label", "norm"))
                hunt.take(ids, labels, matrix(b.column("c"), "<i8"), norms, matrix(b.column("angles"), "<f4").astype(np.float64))
        yield hunt.batch()

    return run


def _measured(refs: np.ndarray):
    """Rows (id, label, c: array of longs) -> with c as bytes, norm, angles, the nearest reference and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), STEP):
                b = whole.slice(lo, STEP)
                x = b.column("c").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(b), -1)
                norms, to = angles(x, refs)
                near = to.argmin(1)
                data = [[r.tobytes() for r in part] for part in (x.astype("<i8"), to.astype("<f4"))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("label"), pa.array(data[0], pa.binary()), pa.array(norms), pa.array(data[1], pa.binary()), pa.array(near.astype(np.int32)), pa.array(to[np.arange(len(b)), near])],
                    names=["id", "label", "c", "norm", "angles", "near", "to"],
                )

    return run


def relabelled(vectors: DataFrame, *, seventh: int = 7, labels: int = 10) -> DataFrame:
    """Labels of every ``seventh`` id moved on by one: labels that are wrong on purpose."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % seventh == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))


def hard_negatives(
    vectors: DataFrame, *, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY, window: tuple[int, int] = WINDOW, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank, anchor_hash): of each anchor's
    first positives (highest scores of its label) the first negatives (of other labels) whose scores lie in the window."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(x) > 0))
    # A double beyond 64 bits is held at the bound by floor; times a scale it may be infinite, which is also held.
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c)).alias("c"))
    sizes = rows.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 1
    rows = rows.where(F.size("c") == d)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().column("c").combine_chunks()
    refs = references(sample.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d))
    shape = "id long, label long, c binary, norm double, angles binary, near int, to double"
    # Rows with like angles come together; a hot reference or vector is cut by the hash of the id.
    index = rows.mapInArrow(_measured(refs), shape).repartitionByRange("near", "to", F.xxhash64("id")).sortWithinPartitions("near", "to")
    index = stored(index.select("id", "label", "c", "norm", "angles"))
    mark = F.xxhash64("label", "c").alias("mark")
    asked = index.where(F.col("id") % every == 0).select("id", "label", "c", mark).dropDuplicates(["id", "label", "c"])
    size = 8 * d + 16 * positives + 24
    # One part from the least to the most score of all.
    found = in_place(index, asked.withColumns({"low": F.array(F.lit(_LEAST)), "high": F.array(F.lit(_MOST))}), _search(refs, True, positives), FOUND, row_bytes=size)
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    best = found.withColumn("positive_rank", nth("anchor_id", "anchor_hash")).where(F.col("positive_rank") <= positives)
    best = stored(best.select(F.col("anchor_id").alias("id"), F.col("anchor_hash").alias("mark"), "positive_rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # The windows in whole numbers: low <= score <= high; an anchor has up to five, those it lacks are empty.
    low, high = (F.expr(f"cast({f}(positive_score * {w}BD / 100) as long)") for f, w in (("ceil", window[0]), ("floor", window[1])))
    of = best.groupBy("id", "mark").agg(F.map_from_entries(F.collect_list(F.struct("positive_rank", F.struct(low.alias("low"), high.alias("high"))))).alias("w"))
    part = lambda end, none: F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.col("w")[i][end], F.lit(none)))
    asked = asked.join(of, ["id", "mark"]).select("id", "label", "c", "mark", part("low", _MOST).alias("low"), part("high", _LEAST).alias("high"))
    found = in_place(index, asked, _search(refs, False, negatives), FOUND, row_bytes=size)
    ranked = found.withColumn("rank", nth("anchor_id", "anchor_hash", "part")).where(F.col("rank") <= negatives)
    ranked = ranked.select(F.col("anchor_id"), "anchor_hash", (F.col("part") + 1).cast("int").alias("positive_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    best = best.select(F.col("id").alias("anchor_id"), F.col("mark").alias("anchor_hash"), "positive_rank", "positive_id", "positive_score")
    out = ranked.join(best, ["anchor_id", "anchor_hash", "positive_rank"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank", "anchor_hash")


HARD_NEGATIVES_SQL = f"""
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, CAST(list_inner_product(a.c, r.c) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % {EVERY} = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS positive_rank FROM scores WHERE same),
found AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scores s USING (anchor_id)
  WHERE positive_rank <= {POSITIVES} AND NOT s.same AND {WINDOW[0]} * positive_score <= 100 * s.score AND 100 * s.score <= {WINDOW[1]} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score, CAST(positive_rank AS INTEGER) AS positive_rank FROM found WHERE rank <= {NEGATIVES}
"""
