"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of tokens. A window takes from every queue its quantum, the window's length times the
queue's share of the target weights; the fraction that a window can't give is the queue's deficit, which the next
window pays. More sources than ``GROUP`` are dealt in levels: groups of sources are the queues of windows, and each
group's own stream is dealt to its sources in the same way, so every source keeps its target, to a token a level,
however many there are. Because documents may be cut anywhere, the tokens that queue q has been given after k windows have
the closed form ``F_q(k) - F_(q-1)(k)`` with ``F_j(k) = floor(length * k * (w_1 + ... + w_j) / sum(w))``: each
window is full, each queue is less than one token from its target at every window, and no task needs to wait for
another one's deficits. When a queue runs dry, one window is dealt by hand from what is left, then a new phase
begins with the queues that remain. The phases, at most a few for each queue, are all that the driver plans: some
two kilobytes a source, which executors get too.

A document's place in its queue is the sum of the tokens before it: in its own partition, counted while the
tokens are written, plus those of the partitions before. So texts are never shuffled and a hot source is no
hot task. Only the last sequence can be short.

Nulls: a null text is empty (its end id alone); a null source is a queue of its own. Repeated rows are packed
as often as they occur. An empty table gives no rows. Only doc_id, source and text are read, whatever else is there.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.common import stored
from siltwork.llm.langid import byte_columns

WINDOW = 2048
END_ID = 1
#: Queues that one level of the deal has at most; with more, groups of so many are the queues of the level above.
GROUP = 64
#: A level's targets are whole numbers that sum to about this at most, and a phase has so many windows at most: products stay within 63 bits.
UNITS, PHASE = 1 << 30, 1 << 21
#: Words whose ids a Python worker remembers before it starts anew.
MEMORY_WORDS = 400_000

_STOP = re.compile(rb"(?<=[a-z0-9])([.,])(?=[ \n])")
_PLAIN = re.compile(r"[!-~\xa1-\xff]+")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
_TOKENIZERS: dict[str, WordIds] = {}


class WordIds(dict):
    """The ids of a text by a vocabulary file, word by word: word -> its ids as bytes, of two bytes each or four.

    The vocabulary lower-cases, drops white space and never joins what white space parts, so a text's ids are
    those of its words one after another, and a word's ids are looked up once. Words of letters up to U+00FF go
    straight to the BPE model, all others through the whole tokenizer. For a vocabulary file of another
    make-up ``by_word`` is False, and whole texts go through its tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.special = [x["content"] for x in spec["added_tokens"]]
        plain = steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in cuts] == ["Split", "ByteLevel"] and not cuts[1]["add_prefix_space"]
        self.by_word = plain and not any(x.isalpha() for x in self.special)
        self.cut = regex.compile(cuts[0]["pattern"]["Regex"]) if self.by_word else None
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special_start = os.path.commonprefix(self.special)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = iter(range(256, 512))
        #: The letter of each byte that the model has no letter of the same number for.
        self.letter = {b: next(others) for b in range(256) if b not in shown}
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self._ids(word)
        return ids

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes() if self.kind.itemsize > 2 else array("H", ids).tobytes()

    def _ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        low = text.lower()
        if not _PLAIN.fullmatch(low) or (self.special_start in text and any(x in text for x in self.special)):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        lowered = low.encode()
        if lowered != word:
            return self[lowered]
        if not low.isalpha():
            pieces = (low[:-1], low[-1]) if low[-1] in ".," and low[:-1].isalpha() else self.cut.findall(low)
            if pieces != [low]:
                return b"".join([self[x.encode()] for x in pieces])
        return self._packed([t.id for t in self.model.tokenize(low if low.isascii() else lowered.decode("latin-1").translate(self.letter))])

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        for text in texts:
            if not self.by_word:
                yield self._packed(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
                continue
            if len(self) > MEMORY_WORDS:
                self.clear()
            if self.special_start.encode() not in text:
                # Fewer different words: no capitals, and no full stop or comma after a letter or digit.
                text = _STOP.sub(rb" \1", text.lower())
            yield b"".join(map(self.__getitem__, text.split()))


def word_ids(path: str) -> WordIds:
    """This Python worker's tokenizer of that file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


def in_file_order(docs: DataFrame) -> DataFrame:
    """docs with each row's place in the Parquet files that they are read from: ``_file`` (the number that Spark's writer gave the file) and ``_row``.

    What is not read from files is written to some first.
    """
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = stored(docs)
    at = docs.metadataColumn("_metadata")
    number = F.regexp_extract(at["file_name"], r"part-(\d+)", 1)
    return docs.select("doc_id", "source", "text", F.coalesce(number.try_cast("long"), F.lit(0)).alias("_file"), at["row_index"].alias("_row"))


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, source, part, place (tokens of its source before it in its part), n, ids (two bytes each, or four for a large vocabulary).

    A part is what a task reads; with ``in_file_order`` it is a run of rows of one file, and parts are in the files' order.
    """
    ordered = "_row" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, coder, last = TaskContext.get().partitionId(), {}, word_ids(path), None
        end = end_id.to_bytes(coder.kind.itemsize, "little")
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                data, offsets = byte_columns(batch.column(2))
                data = data.tobytes()
                sources, place, n, ids, parts = batch.column(1).to_pylist(), [], [], [], []
                rows = zip(*(batch.column(k).to_pylist() for k in (3, 4)), strict=True) if ordered else repeat(None)
                for source, row, found in zip(sources, rows, coder.encode([data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]), strict=False):
                    if row is not None:
                        if last != (row[0], row[1] - 1):
                            part, before = row[0] << 40 | row[1], {}
                        last = row
                    parts.append(part)
                    ids.append(found + end)
                    n.append(len(ids[-1]) // len(end))
                    place.append(before.get(source, 0))
                    before[source] = place[-1] + n[-1]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.int64()), pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "source", "part", "place", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"), F.col("text").cast("binary").alias("text"), *(["_file", "_row"] if ordered else []))
    return rows.mapInArrow(run, "doc_id long, source string, part long, place long, n long, ids binary")


def tempered(totals: list[int]) -> list[int]:
    """Default targets: in proportion to the root of a source's tokens, to six binary digits behind the point."""
    return [max(1, math.isqrt(t << 12)) for t in totals]


def whole_weights(weights: dict[str, float], names: list[str]) -> list[int]:
    """Given weights as whole numbers, the largest of them of 2^40; others count as 1. The least is one unit."""
    given = [weights.get(x, 1) for x in names]
    if any(not w >= 0 for w in given):
        raise ValueError("weights are numbers of zero or more")
    if all(isinstance(w, int) for w in given):
        return [max(1, w) for w in given]
    unit = (1 << 40) / max([*given, 1e-300])
    return [max(1, round(w * unit)) for w in given]


def plan(totals: list[int], weights: list[int], window: int = WINDOW) -> list[dict]:
    """The phases: from window ``first`` on, ``windows`` of them, in which F_j(k) = num * k * cum[j] // den; taken: tokens of each queue before."""
    taken, phases, first = [0] * len(totals), [], 0
    live = [q for q, t in enumerate(totals) if t]

    def phase(shares: dict[int, int], num: int, den: int, k: int) -> None:
        nonlocal first
        cum = [0, *accumulate(shares.get(q, 0) for q in range(len(totals)))]
        phases.append({"first": first, "windows": k, "num": num, "den": den, "cum": cum, "taken": list(taken)})
        for q in shares:
            taken[q] += num * k * cum[q + 1] // den - num * k * cum[q] // den
        first += k

    while live:
        shares = {q: weights[q] for q in live}
        den, cum = sum(shares.values()), [0, *accumulate(shares.values())]
        given = lambda i, k: window * k * cum[i + 1] // den - window * k * cum[i] // den  # noqa: B023, E731
        left = [totals[q] - taken[q] for q in live]
        k = min(PHASE, *((r + 1) * den // (window * weights[q]) for q, r in zip(live, left, strict=True)))
        while k and any(given(i, k) > r for i, r in enumerate(left)):
            k -= 1
        if k:
            phase(shares, window, den, k)
            live = [q for q in live if taken[q] < totals[q]]
            continue
        # A queue is about to run dry: one window by hand. What it can't give, the others do in rounds.
        quantum = [max(1, given(i, 1)) for i in range(len(live))]
        give, room = [0] * len(live), window
        while room and any(g < r for g, r in zip(give, left, strict=True)):
            for i, r in enumerate(left):
                more = min(quantum[i], r - give[i], room)
                give[i] += more
                room -= more
        phase(dict(zip(live, give, strict=True)), 1, 1, 1)
        live = [q for q in live if taken[q] < totals[q]]
    return phases


def _runs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place): sizes[i] rows of i, numbered from 0."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(sizes.cumsum() - sizes, sizes)


class Dealer:
    """Where the tokens of a queue go."""

    def __init__(self, phases: list[dict]):
        self.first, self.num, self.den = (np.array([p[k] for p in phases], np.int64) for k in ("first", "num", "den"))
        self.cum, self.taken = np.array([p["cum"] for p in phases], np.int64), np.array([p["taken"] for p in phases], np.int64)

    def _below(self, p: np.ndarray, q: np.ndarray, k: np.ndarray) -> np.ndarray:
        return self.num[p] * k * self.cum[p, q] // self.den[p]

    def _given(self, p: np.ndarray, q: np.ndarray, k: np.ndarray) -> np.ndarray:
        return self._below(p, q + 1, k) - self._below(p, q, k)

    def _window(self, p: np.ndarray, q: np.ndarray, t: np.ndarray) -> np.ndarray:
        """k with given(k) <= t < given(k + 1)."""
        k = t * self.den[p] // (self.num[p] * (self.cum[p, q + 1] - self.cum[p, q]))
        while (high := self._given(p, q, k) > t).any():
            k = k - high
        while (low := self._given(p, q, k + 1) <= t).any():
            k = k + low
        return k

    def pieces(self, q: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, sequence, offset) of the pieces of documents at ``start`` of queue q."""
        a = np.empty(len(q), np.int64)
        b = np.empty(len(q), np.int64)
        for x in np.unique(q):
            of = q == x
            a[of] = np.searchsorted(self.taken[:, x], start[of], "right") - 1
            b[of] = np.searchsorted(self.taken[:, x], start[of] + n[of] - 1, "right") - 1
        doc, step = _runs(b - a + 1)
        p, qd = a[doc] + step, q[doc]
        until = np.vstack([self.taken[1:], np.full((1, self.taken.shape[1]), np.iinfo(np.int64).max)])[p, qd]
        lo, hi = np.maximum(start[doc], self.taken[p, qd]), np.minimum(start[doc] + n[doc], until)
        there = hi > lo
        doc, p, qd, lo, hi = (x[there] for x in (doc, p, qd, lo, hi))
        base = self.taken[p, qd]
        k0, k1 = self._window(p, qd, lo - base), self._window(p, qd, hi - 1 - base)
        of, step = _runs(k1 - k0 + 1)
        doc, p, qd, lo, hi, base, k = doc[of], p[of], qd[of], lo[of], hi[of], base[of], k0[of] + step
        here = base + self._given(p, qd, k)
        lo, hi = np.maximum(lo, here), np.minimum(hi, base + self._given(p, qd, k + 1))
        offset = self._below(p, qd, k + 1) - self._below(p, qd, k) + lo - here
        there = hi > lo
        return tuple(x[there] for x in (doc, lo - start[doc], hi - lo, self.first[p] + k, offset))


class Deal:
    """Where the tokens of any number of queues go: a Dealer for each group of each level, the last level's one for all."""

    def __init__(self, totals: list[int], weights: list[int], window: int = WINDOW):
        self.window, self.levels = window, []
        while not self.levels or len(self.levels[-1]) > 1:
            scale = max(1, -(-sum(weights) // UNITS))
            weights = [max(1, w // scale) for w in weights]
            groups = [slice(at, at + GROUP) for at in range(0, len(totals), GROUP)]
            self.levels.append([Dealer(plan(totals[g], weights[g], window)) if sum(totals[g]) else None for g in groups])
            totals, weights = [sum(totals[g]) for g in groups], [sum(weights[g]) for g in groups]

    def pieces(self, q: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, sequence, offset) of the pieces of documents at ``start`` of queue q."""
        doc, inside, length = np.arange(len(q)), np.zeros(len(q), np.int64), n
        for level, dealers in enumerate(self.levels):
            parts = []
            for g in np.unique(q // GROUP):
                of = np.flatnonzero(q // GROUP == g)
                piece, at, size, sequence, offset = dealers[g].pieces(q[of] % GROUP, start[of], length[of])
                parts.append((doc[of][piece], inside[of][piece] + at, size, sequence, offset, np.full(len(piece), g)))
            doc, inside, length, sequence, offset, q = (np.concatenate(c) for c in zip(*parts, strict=True))
            start = sequence * self.window + offset
        return doc, inside, length, sequence, offset


def pack(docs: DataFrame, path: str, *, weights: dict[str, float] | None = None, by_files: bool = False, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document. weights: a source's target share of each window's tokens; others get 1.

    by_files: docs are read from Parquet files, and each source's documents queue in the order of the files and of the rows
    in each, as what wrote them had them; no shuffle is needed for it. Without it they queue as tasks read them.
    """
    if by_files:
        docs = in_file_order(docs)
    tokens = stored(tokenized(docs, path, end_id))
    parts = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    # A row for each source goes to the driver, and comes back with its queue's number.
    names, totals = [], []
    for r in parts.groupBy("source").agg(F.sum("n").alias("n")).orderBy("source").toLocalIterator():
        names.append(r["source"])
        totals.append(r["n"])
    target = tempered(totals) if weights is None else whole_weights(weights, names)
    deal = Deal(totals, target, window) if names else None
    queues = docs.sparkSession.createDataFrame(list(zip(names, range(len(names)), strict=True)), "source string, queue long")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(queues, "source")
    # Written first: Spark then knows its size, and moves the tokens only if it is too large to broadcast.
    bases = stored(bases)
    rows = tokens.join(bases, ["source", "part"]).select("doc_id", "source", "queue", (F.col("base") + F.col("place")).alias("start"), "n", "ids")
    shared = docs.sparkSession.sparkContext.broadcast(deal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = shared.value
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                n = batch.column(4).to_numpy()
                doc, start, length, sequence, offset = deal.pieces(batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy(), n)
                data, offsets = byte_columns(batch.column(5))
                size = len(data) // int(n.sum())
                view = memoryview(data.view(f"<u{size}").astype("<u4")).cast("B")
                begin = 4 * (offsets[doc] // size + start)
                crc = [zlib.crc32(view[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(sequence), pa.array(offset), batch.column(1).take(pa.array(doc))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    return rows.mapInArrow(run, PIECES).withColumn("source", F.nullif("source", F.lit("\0")))
