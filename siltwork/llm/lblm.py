"""Language-model scoring by a log-bilinear neural model.

The model predicts a token from the two before it: ``s(w | u, v) = (c1 * r_u + c2 * r_v) . q_w + b_w``, with vectors
for context and target words and a weight vector for each place. Its symbols are the most frequent words of the
corpus, the end of a text, and classes of all other words by a hash of their endings: any word, however rare or new,
has its class's vectors as context and target, and in its class its add-one share of the class's tokens.

It is trained in numpy by noise-contrastive estimation: each true token against words drawn from the corpus'
unigrams, a batch sharing its noise words, so that a step is a few matrix products. Each partition trains on windows
of all its texts from common parameters; the parameters are then averaged by rows of the matrices, weighted with the
windows, and the next round starts from the mean. So each document of the learning folds teaches, and what is
gathered grows with the corpus.

Scores are normalised exactly, over the symbols and in each class: as the score is a sum over the two places, the normaliser of all pairs of context
words is one product of two matrices of exponentials, and a token's log-probability is three table look-ups.

Counts are exact and cover all learning texts. The most frequent words' counts, a bounded number, go to the
executors; the others meet the texts' rarer words in a join, once for each different one of a text.

A null text is empty, its end the only token. Repeated rows count and are scored as often as they occur; a null
doc_id falls into the fold of the empty text. Without learning texts each token has base probability 1. Only doc_id
and text are read, whatever other columns are called; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.common import fold, stored
from siltwork.llm.langid import byte_columns

#: Words of the model with vectors of their own, besides the end; the classes of all other words, and the bytes of a word's ending that tell its class.
MODEL_WORDS, CLASSES, ENDING = 1022, 1024, 3
#: Words whose counts every executor has.
FREQUENT_WORDS = 60_000
DIMENSIONS = 24
#: Round r trains on the windows at places r, r + ROUNDS, ... of each text: over the rounds each window teaches once.
ROUNDS = 2
BATCH, NOISE, RATE = 2048, 128, 0.08
#: Windows that a partition holds before it takes steps, about.
HELD = 1 << 16
#: Rows of the matrices that are averaged together, and the groups of partitions whose means are taken first.
ROWS, GROUPS = 64, 256
#: Texts whose words are found at once.
TEXTS = 500
_SPILL_WORDS = 400_000
END = b"\n"
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_CRC = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], np.uint32)


def words_of(text: bytes) -> list[bytes]:
    """The words, A-Z lower-cased."""
    return text.lower().split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = byte_columns(column)
    data = data.tobytes()
    return (data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in _texts(batch.column(0)):
            counts.update(words_of(text))
            if len(counts) > _SPILL_WORDS:
                yield out()
                counts.clear()
        counts[END] += len(batch)
    if counts:
        yield out()


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end of a text is the word END."""
    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_counted, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Parameters:
    """context, target: a row of each word; place: a row of each place; bias: log unigram to begin with."""

    context: np.ndarray
    target: np.ndarray
    place: np.ndarray
    bias: np.ndarray

    @classmethod
    def initial(cls, unigram: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 11) -> Parameters:
        rng = np.random.default_rng(seed)
        n = len(unigram)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(draw(n, dimensions), draw(n, dimensions), np.ones((2, dimensions), np.float32), np.log(np.maximum(unigram, 1e-12)).astype(np.float32))

    def rows(self) -> np.ndarray:
        """All parameters as one matrix: for each word its vectors and bias, then the places."""
        top = np.concatenate([self.context, self.target, self.bias[:, None]], 1)
        end = np.zeros((2, top.shape[1]), np.float32)
        end[:, : self.place.shape[1]] = self.place
        return np.concatenate([top, end])

    @classmethod
    def of_rows(cls, rows: np.ndarray) -> Parameters:
        d = (rows.shape[1] - 1) // 2
        rows = rows.astype(np.float32)
        return cls(rows[:-2, :d].copy(), rows[:-2, d : 2 * d].copy(), rows[-2:, :d].copy(), rows[:-2, 2 * d].copy())

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(by the word before, by the one before that with the bias, log normaliser of each pair)."""
        one = (self.context * self.place[0]) @ self.target.T
        two = (self.context * self.place[1]) @ self.target.T + self.bias
        top1, top2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
        z = np.exp(one - top1) @ np.exp(two - top2).T
        return one, two, np.log(np.maximum(z, 1e-30)) + top1 + top2.T


def _sums(index: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, the gradients of each summed); by sorting, which is many times faster than np.add.at."""
    # Numbers of 16 bits are sorted by their digits, in a fifth of the time.
    order = np.argsort(index.astype(np.uint16) if index.max(initial=0) < 1 << 16 else index, kind="stable")
    rows = index.take(order)
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(grad.take(order, 0), first, axis=0)


def _add(p: Parameters, square: Parameters, name: str, rows: np.ndarray, full: np.ndarray, rate: float) -> None:
    of = getattr(square, name)
    total = of.take(rows, 0) + full * full
    of[rows] = total
    np.sqrt(total, out=total)
    total += 1e-6
    getattr(p, name)[rows] -= rate * full / total


def nce_step(p: Parameters, square: Parameters, before: np.ndarray, before2: np.ndarray, token: np.ndarray, noise: np.ndarray, log_kq: np.ndarray, rate: float = RATE) -> None:
    """One AdaGrad step on a batch; noise: words drawn from the unigrams, log_kq: log of their number times their probability."""
    size, d = len(token), p.context.shape[1]
    u, v = p.context.take(before, 0), p.context.take(before2, 0)
    q = u * p.place[0] + v * p.place[1]
    t, n = p.target.take(token, 0), p.target.take(noise, 0)
    # Each token against its share of the batch's noise words: their weight is that of len(noise) draws.
    true = (q * t).sum(1) + p.bias[token] - log_kq[token]
    g_true = 1 / (1 + np.exp(-np.clip(true, -30, 30))) - 1
    # The large matrix is made once and changed where it is.
    false = q @ -n.T
    false -= p.bias[noise] - log_kq[noise]
    np.clip(false, -30, 30, out=false)
    np.exp(false, out=false)
    false += 1
    g_false = np.reciprocal(false, out=false)
    g_q = g_true[:, None] * t
    g_q += g_false @ n
    # Target and bias have the same rows; so have the two places' words in context.
    grad = np.empty((size + len(noise), d + 1), np.float32)
    np.multiply(g_true[:, None], q, out=grad[:size, :d])
    grad[size:, :d] = g_false.T @ q
    grad[:size, d], grad[size:, d] = g_true, g_false.sum(0)
    grad /= size
    of_token, full = _sums(np.concatenate([token, noise]), grad)
    grad = np.empty((2 * size, d), np.float32)
    np.multiply(g_q, p.place[0], out=grad[:size])
    np.multiply(g_q, p.place[1], out=grad[size:])
    grad /= size
    of_before, around = _sums(np.concatenate([before, before2]), grad)
    place = np.stack([np.einsum("ij,ij->j", g_q, u), np.einsum("ij,ij->j", g_q, v)]).astype(np.float32) / size
    _add(p, square, "target", of_token, full[:, :d], rate)
    _add(p, square, "bias", of_token, full[:, d], rate)
    _add(p, square, "context", of_before, around, rate)
    square.place += place * place
    p.place -= rate * place / (np.sqrt(square.place) + 1e-6)


def word_class(word: bytes, classes: int) -> int:
    return crc32(word[-ENDING:]) % classes


@dataclass
class Vocabulary:
    """The model's words by number (END the last), the counts of the frequent words, and of each class the tokens and different words."""

    words: dict[bytes, int]
    counts: dict[bytes, int]
    unigram: np.ndarray
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray

    def symbol(self, word: bytes) -> int:
        found = self.words.get(word)
        return len(self.words) + word_class(word, len(self.class_tokens)) if found is None else found

    def class_logs(self) -> np.ndarray:
        """For each symbol: log10 of what counts are divided by in it, 0 for a word of the model."""
        return np.concatenate([np.zeros(len(self.words)), np.log10(self.class_tokens + self.class_distinct + 1.0)])


def word_classes(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray, classes: int) -> np.ndarray:
    """word_class of the words that end before these bytes."""
    crc = np.full(len(ends), 0xFFFFFFFF, np.uint32)
    for back in range(ENDING, 0, -1):
        at = np.flatnonzero(sizes >= back)
        crc[at] = _CRC[(crc[at] ^ data[ends[at] - back]) & 255] ^ (crc[at] >> 8)
    return ((crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(classes)).astype(np.int64)


def symbols_of(column: pa.Array, words: pa.Array, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts' words, the number of words of each text); words: those of the model, by number."""
    data, offsets = byte_columns(column)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    inside = ~_SPACE[data]
    # A word ends at a space and with its text.
    before = np.concatenate([[False], inside])
    before[offsets] = False
    after = np.concatenate([inside, [False]])
    after[offsets] = False
    start, stop = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1
    sizes = stop - start
    ends, data = sizes.cumsum(), data[inside]
    kind, width = (pa.binary(), np.int32) if len(data) < 1 << 31 else (pa.large_binary(), np.int64)
    found = pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(width)), pa.py_buffer(data)])
    ids = pc.index_in(found, value_set=words.cast(kind)).fill_null(-1).to_numpy().astype(np.int64)
    new = np.flatnonzero(ids < 0)
    ids[new] = len(words) + word_classes(data, ends[new], sizes[new], classes)
    return ids, np.diff(np.searchsorted(start, offsets))


def windows_of(ids: np.ndarray, sizes: np.ndarray, end: int, first: int, step: int) -> np.ndarray:
    """(word before that, word before, token) at places first, first + step, ... of each text, whose tokens are its words and its end."""
    base = np.concatenate([[0], (sizes + 3).cumsum()])
    path = np.full(base[-1], end, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    path[np.arange(len(ids)) + 3 * text + 2] = ids
    place = np.arange(len(path)) - np.repeat(base[:-1], sizes + 3)
    at = np.flatnonzero((place % step == first % step) & (place >= first) & (place <= np.repeat(sizes, sizes + 3)))
    return np.stack([path[at], path[at + 1], path[at + 2]], 1)


def vocabulary(counts: DataFrame, model_words: int = MODEL_WORDS, frequent_words: int = FREQUENT_WORDS, classes: int = CLASSES) -> Vocabulary:
    """counts: (word, n), read twice. The driver gets the frequent words only, a bounded number, and a row for each class."""
    of = F.pmod(F.crc32(F.substring("word", -ENDING, ENDING)), F.lit(classes)).cast("int")
    sums = counts.groupBy(of.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).toArrow()
    top = counts.orderBy(F.desc("n"), "word").limit(frequent_words).toArrow()
    frequent = dict(zip(top.column("word").to_pylist(), top.column("n").to_pylist(), strict=True))
    chosen = [w for w in frequent if w != END][:model_words] + [END]
    n = np.array([frequent.get(w, 0) for w in chosen], np.float64)
    tokens, kinds = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    at = sums.column("class").to_numpy()
    tokens[at], kinds[at] = sums.column("n").to_numpy(), sums.column("k").to_numpy()
    total, distinct = int(tokens.sum()), int(kinds.sum())
    for w in chosen:
        if w in frequent:
            tokens[word_class(w, classes)] -= frequent[w]
            kinds[word_class(w, classes)] -= 1
    unigram = np.concatenate([n, tokens]) + 0.5
    return Vocabulary({w: i for i, w in enumerate(chosen)}, frequent, unigram / unigram.sum(), total, distinct, tokens, kinds)


MODELS = "part long, group long, n long, rows binary"


def _mean(table: pa.Table) -> pa.Table:
    """The mean of one part's slices, weighted with the windows that they learned from."""
    total, n = 0.0, 0
    for batch in table.to_batches():
        for k, rows in zip(batch.column("n").to_pylist(), batch.column("rows").to_pylist(), strict=True):
            total = total + np.frombuffer(rows, "<f8") * k
            n += k
    one = table.slice(0, 1)
    return pa.table({"part": one.column("part"), "group": one.column("group"), "n": pa.array([n], pa.int64()), "rows": pa.array([(total / n).tobytes()], pa.binary())})


def train(docs: DataFrame, vocab: Vocabulary, *, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> Parameters:
    """Rounds of training in every partition and averaging of the parameters' rows; each window of each text teaches in one round."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    words = spark.sparkContext.broadcast(vocab)
    p = Parameters.initial(vocab.unigram, dimensions)
    for round_ in range(rounds):
        start = spark.sparkContext.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch], start=start, round_=round_) -> Iterator[pa.RecordBatch]:
            known, classes = pa.array(words.value.words, pa.binary()), len(words.value.class_tokens)
            end, top = words.value.words[END], len(words.value.unigram) - 1
            model = Parameters.of_rows(start.value.rows())
            square = Parameters.of_rows(np.full_like(model.rows(), 1e-3))
            rng = np.random.default_rng([round_, TaskContext.get().partitionId()])
            log_kq, draw = np.log(NOISE * words.value.unigram).astype(np.float32), words.value.unigram.cumsum()
            held, waiting, seen = [], 0, 0

            def steps(last: bool) -> None:
                nonlocal held, waiting
                rows = np.concatenate(held) if held else np.zeros((0, 3), np.int64)
                n = len(rows) if last else len(rows) - len(rows) % BATCH
                for lo in range(0, n, BATCH):
                    some = rows[lo : min(lo + BATCH, n)]
                    noise = np.minimum(np.searchsorted(draw, rng.random(NOISE)), top)
                    nce_step(model, square, some[:, 1], some[:, 0], some[:, 2], noise, log_kq)
                held, waiting = [rows[n:]], len(rows) - n

            for batch in batches:
                for lo in range(0, len(batch), TEXTS):
                    some = windows_of(*symbols_of(batch.column(0).slice(lo, TEXTS), known, classes), end, round_, rounds)
                    held.append(some)
                    seen += len(some)
                    waiting += len(some)
                    if waiting >= HELD:
                        steps(False)
            steps(True)
            if seen:
                out = model.rows()
                parts, group = range(0, len(out), ROWS), TaskContext.get().partitionId() % GROUPS
                columns = [list(parts), [group] * len(parts), [seen] * len(parts), [out[k : k + ROWS].astype("<f8").tobytes() for k in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["part", "group", "n", "rows"])

        # Means of groups of partitions first, then of the groups: however many partitions, no task gathers the slices of all.
        models = texts.mapInArrow(run, MODELS)
        means = models.groupBy("part", "group").applyInArrow(_mean, MODELS).groupBy("part").applyInArrow(_mean, MODELS).toArrow()
        if means.num_rows:
            rows = b"".join(r for _, r in sorted(zip(means.column("part").to_pylist(), means.column("rows").to_pylist(), strict=True)))
            p = Parameters.of_rows(np.frombuffer(rows, "<f8").reshape(-1, p.rows().shape[1]))
    return p


_TABLES: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Parameters) -> DataFrame:
    """Scores of docs (doc_id, held_out, text); counts: (word, n) of the learning texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocab, model))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = shared.value
        if name not in _TABLES:  # once for each Python worker
            _TABLES.clear()
            _TABLES[name] = model.tables()
        one, two, norm = _TABLES[name]
        index = {w: i for i, w in enumerate(vocab.counts)}
        number, classes = np.array([*map(vocab.symbol, index), 0]), len(vocab.class_tokens)
        divided, few = vocab.class_logs(), len(vocab.words)
        log1 = np.log10(np.array([*vocab.counts.values(), 0], np.float64) + 1)
        end = vocab.words[END]
        key = TaskContext.get().partitionId() << 40
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                texts, rare = [], []
                for text in _texts(batch.column(2)):
                    words = words_of(text)
                    words.append(END)
                    at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                    ids, new = number[at], np.flatnonzero(at < 0)
                    strange = [words[k] for k in new.tolist()]
                    ids[new] = [few + word_class(w, classes) for w in strange]
                    path = np.concatenate([[end, end], ids])
                    a, b = path[1:-1], path[:-2]
                    lm = float((one[a, ids] + two[b, ids] - norm[a, b]).sum(dtype=np.float64)) / np.log(10)
                    logs, unknown = log1[at], Counter(strange)
                    texts.append((key, len(words), len(words) - len(strange), float(logs.sum()), lm + float((logs[ids >= few]).sum() - divided[ids].sum())))
                    rare += [(key, w, n) for w, n in unknown.items()]
                    key += 1
                n, m = len(texts), len(rare)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                columns = [pa.array(c, k) for c, k in zip(zip(*texts, strict=True), kinds, strict=True)]
                keys, words, times = zip(*rare, strict=True) if rare else ((), (), ())
                both = [
                    pa.concat_arrays([columns[0], pa.array(keys, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(words, pa.binary())]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(times, pa.int64())]),
                    *(pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in (batch.column(0), batch.column(1), *columns[1:])),
                ]
                yield pa.RecordBatch.from_arrays(both, names=["key", "word", "times", "doc_id", "held_out", "tokens", "known", "base", "lm"])

    kinds = "key long, word binary, times long, doc_id long, held_out boolean, tokens long, known long, base double, lm double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").cast("binary").alias("text")).mapInArrow(run, kinds)
    # A row for each text, and one for each of its rarer words; written, as both are read apart and the keys must stay.
    rows = stored(rows)
    rare = rows.where(F.col("word").isNotNull()).select("key", "word", "times").join(counts, "word")
    rare = rare.groupBy("key").agg(F.sum(F.log10(F.col("n") + 1) * F.col("times")).alias("rare"), F.sum("times").alias("rare_known"))
    each = rows.where(F.col("word").isNull()).drop("word", "times").join(rare, "key", "left").fillna(0, ["rare", "rare_known"])
    base = F.col("base") + F.col("rare") - F.col("tokens") * float(np.log10(vocab.tokens + vocab.distinct + 1))
    return each.select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("lm") + F.col("rare")).alias("score"))


def language_model_scores(docs: DataFrame) -> DataFrame:
    """One row per document; a seventh of the keys teaches nothing."""
    learning = docs.where(fold("doc_id", 7) != 2)
    counts = stored(token_counts(learning))
    vocab = vocabulary(counts)
    model = train(learning, vocab)
    return score(docs.select("doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "text"), counts, vocab, model)
