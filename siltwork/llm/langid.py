"""Language ID by prediction by partial matching.

Each language has a variable-order byte context tree: counts of the byte that follows each context of three,
two, one and no bytes. A byte that a context has not seen escapes to the next shorter context (escape method C:
q/(n+q) for q distinct successors among n), at last to the uniform distribution over 256 bytes. After training
the statistics are frozen, so a text's code length is the exact sum of its bytes' code lengths, and a byte's
code length depends on three bytes before it only. That lets numpy price whole Arrow batches by table lookups.

Texts are priced as UTF-8 with A-Z lower-cased; three newlines stand before each text. A tree holds what its
language's texts have shown and no more, so neither contexts nor languages have a limit: the model grows with the
distinct four-byte strings of the documents that teach, some 600 a language.

Nulls: a null text, or one with no letter, is ``und`` with score 0. Rows without lang teach nothing. Repeated
rows teach as often as they occur, if they do. An empty table gives no rows; with nothing to learn from, all is
``und``. Other columns stay, whatever their names; ``identify`` refuses a table that has a name it is to add.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.common import fold, unused

UNDETERMINED = "und"
#: Documents per language from which the trees are counted, on average: a hash of doc_id draws them.
TRAIN_DOCS = 600
_CHUNK = 1 << 18
_EMPTY = np.uint32(0xFFFFFFFF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_columns(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after another, offsets) of a binary or string column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _before(data: np.ndarray, starts: np.ndarray, lo: int, hi: int, back: int, pad: int) -> np.ndarray:
    """The symbol ``back`` places before each of data[lo:hi]; ``pad`` before the start of a text."""
    out = np.full(hi - lo, pad, data.dtype)
    first = max(lo, back)
    if first < hi:
        out[first - lo :] = data[first - back : hi - back]
    for ahead in range(back):
        near = starts + ahead
        out[near[(near >= lo) & (near < hi)] - lo] = pad
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            data, offsets = byte_columns(batch.column(1).filter(pa.array(langs == lang)))
            if not len(data):
                continue
            data, starts = _LOWER[data], offsets[:-1]
            # A start that is also the next text's start belongs to an empty text, which has no bytes to mark.
            codes = data.astype(np.uint32)
            for back in (1, 2, 3):
                codes |= _before(data, starts, 0, len(data), back, 10).astype(np.uint32) << np.uint32(8 * back)
            codes, counts = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


class Lookup:
    """Values of whole numbers below 2 ** 32, open addressing in numpy; NaN for a number that has none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.astype(np.uint32)
        some = keys != _EMPTY  # four bytes 255 are in no UTF-8 text
        keys, values = keys[some], values[some]
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift, self.mask = np.uint32(32 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _EMPTY, np.uint32), np.full(1 << bits, np.nan, np.float32)
        at, rest = self._places(keys), np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[at[rest]] == _EMPTY]
            places, first = np.unique(at[free], return_index=True)
            self.keys[places], self.values[places] = keys[free[first]], values[free[first]]
            rest = rest[self.keys[at[rest]] != keys[rest]]
            at[rest] = at[rest] + 1 & self.mask

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435769) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._places(keys)
        there = self.keys[at]
        out = self.values[at]
        rest = np.flatnonzero(there != keys)
        out[rest] = np.nan
        rest = rest[there[rest] != _EMPTY]
        at = at[rest]
        while len(rest):
            at = at + 1 & self.mask
            there = self.keys[at]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            more = ~hit & (there != _EMPTY)
            rest, at = rest[more], at[more]
        return out


class ContextTree:
    """Frozen statistics of one language. Its size is that of what was seen: strings of four and three bytes and their contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        n, g = counts.astype(np.float64), grams.astype(np.int64)
        symbol, first = g & 255, g & 0xFFFF
        c0 = np.bincount(symbol, weights=n, minlength=256)
        p0 = self._mixed(c0[None], np.full(256, 1 / 256))
        #: Bits of the next byte after one byte: one and no bytes of context are mixed in a full table.
        self.one = -np.log2(self._mixed(np.bincount(first, weights=n, minlength=1 << 16).reshape(256, 256), p0)).ravel().astype(np.float32)
        third, at = np.unique(g & 0xFFFFFF, return_inverse=True)
        c, context = np.bincount(at, weights=n), third >> 8
        total, kinds = np.bincount(context, weights=c, minlength=1 << 16), np.bincount(context, minlength=1 << 16)
        self.three = Lookup(third, -np.log2(c / (total + kinds)[context]))
        self.escape_two = -np.log2(np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)).astype(np.float32)
        contexts, at = np.unique(g >> 8, return_inverse=True)
        total, kinds = np.bincount(at, weights=n), np.bincount(at)
        self.four = Lookup(g, -np.log2(n / (total + kinds)[at]))
        self.escape_three = Lookup(contexts, -np.log2(kinds / (total + kinds)))

    @staticmethod
    def _mixed(c: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Probabilities of each context's next byte, by escape from the shorter context's."""
        total, kinds = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True)
        escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
        return np.where(c > 0, c / np.maximum(total + kinds, 1), escape * shorter)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each four bytes after the three before it."""
        out = self.four(codes)
        rest = np.flatnonzero(np.isnan(out))
        if len(rest):
            c = codes[rest]
            short, escape = self.three(c & np.uint32(0xFFFFFF)), self.escape_three(c >> np.uint32(8))
            new = np.flatnonzero(np.isnan(short))
            short[new] = self.escape_two[c[new] >> np.uint32(8) & np.uint32(0xFFFF)] + self.one[c[new] & np.uint32(0xFFFF)]
            out[rest] = short + np.where(np.isnan(escape), 0, escape)
        return out


class ContextTrees:
    """The trees of all languages."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], counts: list[np.ndarray]):
        self.langs, self.trees = langs, [ContextTree(g, n) for g, n in zip(grams, counts, strict=True)]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language (columns); bounded memory whatever the texts' lengths."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(data):
            return out
        starts = offsets[:-1]
        full = np.flatnonzero(offsets[1:] > starts)
        for lo in range(0, len(data), _CHUNK):
            hi = min(lo + _CHUNK, len(data))
            part = _LOWER[data[max(lo - 3, 0) : hi]]
            a, b = np.searchsorted(starts, [lo - 3, hi])
            near, shift = starts[max(a - 1, 0) : b], max(lo - 3, 0)
            codes = part[lo - shift :].astype(np.uint32)
            for back in (1, 2, 3):
                codes |= _before(part, near - shift, lo - shift, hi - shift, back, 10).astype(np.uint32) << np.uint32(8 * back)
            here = full[(offsets[full + 1] > lo) & (starts[full] < hi)]
            cuts = np.maximum(starts[here] - lo, 0)
            for k, tree in enumerate(self.trees):
                out[here, k] += np.add.reduceat(tree.bits(codes), cuts, dtype=np.float64)
        return out


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS) -> ContextTrees | None:
    """Context trees from the rows of docs that have text and lang; None if there are none.

    Of each language about ``train_docs`` documents teach, drawn by a hash of their key and text, with their whole
    texts. Executors count; the driver gets a row for each language, and the counts of distinct four-byte strings.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = [(r[0], r[1]) for r in rows.groupBy(F.col(lang).alias("lang")).count().orderBy("lang").collect()]
    if not sizes:
        return None
    unit = 1 << 30
    share = F.create_map(*[F.lit(x) for name, n in sizes for x in (name, min(unit, -(-unit * train_docs // n)))])
    draw = F.pmod(F.xxhash64(F.lit("langid"), F.col(key), F.col(text)), F.lit(unit))
    sample = rows.where(draw < share[F.col(lang)])
    grams = sample.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")).mapInArrow(_count, "lang string, gram long, n long")
    got = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(got.column("lang").to_pylist(), dtype=object)
    gram, n = got.column("gram").to_numpy(), got.column("n").to_numpy()
    langs = sorted(set(names))
    return ContextTrees(langs, [gram[names == x] for x in langs], [n[names == x] for x in langs]) if langs else None


#: Columns that identify() adds.
FOUND = ("lang_pred", "score", "bits_per_byte")


def identify(docs: DataFrame, model: ContextTrees | None, *, text: str = "text", names: tuple[str, str, str] = FOUND) -> DataFrame:
    """docs with lang_pred, score (the share of the best language, from the code lengths) and bits_per_byte, by these ``names``."""
    if any(unused(docs.columns, x) != x for x in names):
        raise ValueError(f"the table has a column of the names {', '.join(names)}: pass others")
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    frame, at = docs.select("*", letters.alias(unused(docs.columns, "_letters"))), docs.columns.index(text)
    schema = docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(0.0).alias(names[2])).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            n = batch.num_columns - 1
            ok = np.array(batch.column(n).to_pylist(), dtype=bool)
            pred, score, rate = np.full(len(ok), UNDETERMINED, dtype=object), np.zeros(len(ok)), np.zeros(len(ok))
            if trees is not None and ok.any():
                data, offsets = byte_columns(batch.column(at))
                bits = trees.code_lengths(data, offsets)
                best, least = bits.argmin(1), bits.min(1)
                pred[ok] = np.array(trees.langs, dtype=object)[best[ok]]
                score[ok] = (1 / np.exp2(np.minimum(least[:, None] - bits, 0)).sum(1))[ok]
                rate[ok] = (least / np.maximum(np.diff(offsets), 1))[ok]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(pred, pa.string()), pa.array(score), pa.array(rate)], names=[*batch.schema.names[:n], *names])

    return frame.mapInArrow(run, schema)


def predict_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, bits_per_byte. A third of the keys teaches nothing."""
    model = train(docs.where(fold("doc_id", 3) != 1))
    rows = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    return identify(rows, model).drop("text")


def keep_known_language(docs: DataFrame) -> DataFrame:
    """The documents with text in a language that the trees know; a document without a letter goes.

    A text that no tree can shorten, at 8 bits a byte or more, is in none of the languages and goes too.
    """
    names = tuple(unused(docs.columns, x) for x in FOUND)
    found = identify(docs, train(docs), names=names)
    return found.where((F.col(names[0]) != UNDETERMINED) & (F.col(names[2]) < 8)).select(*docs.columns)
