"""Phrase collocations by SON partitioning.

Texts, A-Z lower-cased, are cut at punctuation and line ends into pieces, and those at spaces and tabs into words. A
phrase is a run of words of one piece; f counts all its occurrences, per language. Candidates are phrases of two to four
words that occur often enough.

The documents are dealt into a few shards, each a set of tasks; the fewer, the nearer the lowered support is to the whole
one, and the fewer phrases pass that are not frequent. If a phrase occurs ``support`` times in all, then
``support / shards`` times in one of them at least, so each shard is mined completely at this lowered support, level by
level: of the phrases of k words only those are counted whose two parts of k - 1 words are frequent in some shard. The
locally frequent phrases of all shards are united where the shards' counts meet: a candidate's parts are candidates, so
every shard has counted all its occurrences, and the sum of the shards' counts is exact. A shard is as
large as its share of the corpus and is never held in one task: its tasks count what they read, and a shuffle adds the
counts of a shard up. A task sends its counts sorted and in blocks, by the first bits of the hash; where the blocks meet,
those of the same bits are merged, one after another. There are more blocks the more tasks there are, so a block's counts
from all tasks stay about a sixteenth of what one task counts. What is frequent goes to the tasks as a bitmap of two bits a phrase whose size is bounded
(``MOST_BITS``). It can let a phrase pass that is not frequent, which costs a row, but holds back none that is. When a
corpus has more frequent phrases than the bitmap tells apart, the passes shuffle more and find the same.

While mining, a phrase is 96 bits of two hashes of its words and language. A last pass over the texts gives the frequent
ones their words: of the tasks that met a phrase one names it, told by a bitmap too, so a phrase is written about once
and not by each task.

Null texts are empty and have no words; a null lang is ``und``. Repeated rows count as often as they occur. Very long
texts are read in parts, cut between pieces. Ties are broken by the phrase. An empty table gives no rows. Only text and
lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from siltwork.llm.common import stored
from siltwork.llm.langid import byte_columns

LONGEST, SUPPORT, SHARDS, TOP = 4, 30, 2, 2000
#: Hundredths of a phrase's occurrences that a longer one must have to stand for it, and what scores are scaled by.
STANDS_FOR, SCALE = 80, 2_000_000
#: Bytes of text that are cut into words at once, and phrases whose counts a task holds before it sends them.
CHUNK, HELD = 1 << 19, 1 << 20
#: Bits of a bitmap: so many a phrase, between these bounds (logarithms).
BITS_A_PHRASE, LEAST_BITS, MOST_BITS = 16, 20, 28
_BLOCK_BITS = 19
#: Bits for the number of a task; beyond that, phrases are named by any.
_TASK_BITS = 20
#: Blocks of counts for each task, and at least (logarithms), and bytes of counts that are sent on at once, about.
_BLOCKS_A_TASK, _LEAST_BLOCKS, _SENT = 4, 8, 1 << 22
NO_LANG = "und"

_BREAK = re.compile(rb"[.,;:!?\n-\r]")
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = bytes(range(256)).lower()
_FACTORS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


@lru_cache(maxsize=2)
def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2^64."""
    return tuple(np.concatenate([np.ones(1, np.uint64), np.full(n, f, np.uint64)]).cumprod(dtype=np.uint64) for f in (factor, pow(factor, -1, 1 << 64)))


def mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some text: where they begin and end, the piece of each, and hashes of the phrases that begin with each."""

    def __init__(self, data: bytes, salt: int):
        self.data, self.salt = data.translate(_LOWER), np.uint64(salt)
        self.bytes = np.frombuffer(self.data, np.uint8)
        kind = _KIND[self.bytes]
        inside = np.concatenate([[False], kind == 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.start)
        self.levels: dict[int, list[np.ndarray]] = {}

    def hashes(self, factor: int) -> np.ndarray:
        """A hash of each word: a polynomial of its bytes."""
        size = max(CHUNK, 1 << (len(self.data)).bit_length())
        up, down = _powers(factor, size)
        sums = np.concatenate([np.zeros(1, np.uint64), ((self.bytes + np.uint64(1)) * up[: len(self.bytes)]).cumsum(dtype=np.uint64)])
        return mixed((sums[self.end] - sums[self.start]) * down[self.start] + self.salt)

    def phrases(self, k: int, which: int = 0) -> np.ndarray:
        """Hashes of the k words from each on; those that leave the piece (see within) mean nothing."""
        of = self.levels.setdefault(which, [])
        if not of:
            of += [self.hashes(_FACTORS[which])]
        while len(of) < k:
            before, words = of[-1], of[0]
            of.append(mixed(before[: len(words) - len(of)] * np.uint64(0xA24BAED4963EE407) + words[len(of) :]) if len(words) > len(of) else words[:0])
        return of[k - 1]

    def within(self, k: int) -> np.ndarray:
        return self.piece[: max(len(self.piece) - k + 1, 0)] == self.piece[k - 1 :]

    def text(self, i: int, k: int) -> str:
        return b" ".join(self.data[self.start[i] : self.end[i + k - 1]].split()).decode()


def chunks(data: bytes, offsets: np.ndarray, limit: int = CHUNK) -> Iterator[bytes]:
    """The texts joined by line ends, some at a time; a longer text is cut after a break between pieces, if it has one."""
    held, size = [], 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        while b - a > limit:
            cut = max((m.end() for m in _BREAK.finditer(data, a + limit - min(limit, 1 << 16), a + limit)), default=0)
            if not cut:
                found = _BREAK.search(data, a + limit, b)
                cut = found.end() if found else b
            yield data[a:cut]
            a = cut
        held.append(data[a:b])
        size += b - a
        if size > limit:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """(lang, words) of batches of (lang, text)."""
    for whole in batches:
        for lo in range(0, len(whole), 2000):
            batch = whole.slice(lo, 2000)
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                data, offsets = byte_columns(batch.column(1).filter(pa.array(langs == lang)))
                for part in chunks(data.tobytes(), offsets - offsets[0]):
                    yield lang, Words(part, xxh64_intdigest(lang.encode()))


def allowed(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of each key are set."""
    bits = np.uint64(len(bitmap).bit_length() + 2)
    out = np.ones(len(keys), bool)
    for at in (keys >> (np.uint64(64) - bits), keys & ((np.uint64(1) << bits) - np.uint64(1))):
        out &= (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def summed(keys: list[np.ndarray], checks: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of key and check and their counts; of two checks of one key a pair may come more than once."""
    key, check, n = np.concatenate(keys), np.concatenate(checks), np.concatenate(counts)
    order = np.argsort(key)
    key, check, n = key[order], check[order], n[order]
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])])) if len(key) else np.zeros(0, np.int64)
    return key[start], check[start], np.add.reduceat(n, start) if len(start) else n


def frequent(words: Words, k: int, parts: np.ndarray | None) -> np.ndarray:
    """Where phrases of k words begin whose two parts of k - 1 words are in a bitmap."""
    fine = words.within(k)
    if parts is not None and len(fine):
        at = np.flatnonzero(fine)
        known = allowed(parts, words.phrases(k - 1))
        return at[known[at] & known[at + 1]]
    return np.flatnonzero(fine)


def checks(words: Words, k: int, at: np.ndarray) -> np.ndarray:
    """32 bits of a second hash of the phrases that begin there."""
    return (words.phrases(k, 1)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)


COUNTS = "block int, task int, keys binary, checks binary, counts binary"
FOUND = "key long, check int, f long, task int"


def blocks(key: np.ndarray, check: np.ndarray, n: np.ndarray, task: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted counts as COUNTS: a row holds those whose keys have the same first bits."""
    block = (key >> np.uint64(64 - bits)).astype(np.int32)
    start = np.concatenate([np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))[: len(key)], [len(key)]])
    some = max(_SENT * (len(start) - 1) // max(20 * len(key), 1), 1)
    for lo in range(0, len(start) - 1, some):
        of = start[lo : lo + some + 1]
        part = slice(of[0], of[-1])
        rows = [pa.array(block[of[:-1]]), pa.array(np.full(len(of) - 1, task, np.int32))]
        for x in (key[part], check[part], n[part]):
            offsets = ((of - of[0]) * x.itemsize).astype(np.int32)
            rows.append(pa.Array.from_buffers(pa.binary(), len(of) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))]))
        yield pa.RecordBatch.from_arrays(rows, names=["block", "task", "keys", "checks", "counts"])


def _mine(k: int, parts: Broadcast | None, bits: int):
    """Batches of (lang, text) -> COUNTS: a task's counts of phrases of k words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        bitmap = None if parts is None else np.frombuffer(parts.value, np.uint8)
        none = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        (keys, seconds, counts), held = map(list, none), 0
        for _, words in by_language(batches):
            at = frequent(words, k, bitmap)
            key, check, n = summed([words.phrases(k)[at]], [checks(words, k, at)], [np.ones(len(at), np.int64)])
            keys.append(key)
            seconds.append(check)
            counts.append(n)
            held += len(key)
            if held > HELD:
                key, check, n = summed(keys, seconds, counts)
                keys, seconds, counts, held = [key], [check], [n], len(key)
                if held > HELD // 2:
                    yield from blocks(key, check, n, task, bits)
                    (keys, seconds, counts), held = map(list, none), 0
        yield from blocks(*summed(keys, seconds, counts), task, bits)

    return run


def merged(rows: list[tuple[int, bytes, bytes, bytes]], shards: int, local: int, support: int, task_bits: int) -> tuple[np.ndarray, ...]:
    """(key, check, f, task) of some blocks' (task, keys, checks, counts): what is frequent in a shard and in all, and a task that met it, drawn by a hash."""
    key, check, n = (np.frombuffer(b"".join(r[i] for r in rows), kind) for i, kind in ((1, np.uint64), (2, np.int32), (3, np.int64)))
    task = np.repeat(np.array([r[0] for r in rows], np.int32), [len(r[1]) // 8 for r in rows])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    if (check[order][1:] != check[order][:-1])[same].any():
        order = np.lexsort((check, key))
    key, check, n, task = key[order], check[order], n[order], task[order]
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
    f = np.add.reduceat(n, start)
    # As all shards' counts of a phrase meet here, those below the support in all are not frequent, whatever a shard has.
    fine = f >= support
    some = np.repeat(fine, np.diff(start, append=len(key)))
    key, check, n, task, f = key[some], check[some], n[some], task[some], f[fine]
    if not len(f):
        return key, check, f, task
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
    most = reduce(np.maximum, [np.add.reduceat(np.where(task % shards == i, n, 0), start) for i in range(shards)])
    bits, mask = np.uint64(task_bits), np.uint64((1 << task_bits) - 1)
    owner = np.minimum.reduceat(owned(key, task) >> bits << bits | task.astype(np.uint64) & mask, start) & mask
    fine = most >= local
    start = start[fine]
    return key[start], check[start], f[fine], owner[fine].astype(np.int32)


def _merge(shards: int, local: int, support: int, task_bits: int):
    """Batches of COUNTS in the order of the blocks -> FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, rows, size, found, held = None, [], 0, [], 0

        def out() -> pa.RecordBatch:
            key, check, f, task = map(np.concatenate, zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(check), pa.array(f), pa.array(task)], names=["key", "check", "f", "task"])

        for whole in batches:
            for block, *row in zip(*(c.to_pylist() for c in whole.columns), strict=True):
                # Small blocks are merged together.
                if block != of and size > HELD // 16:
                    found.append(merged(rows, shards, local, support, task_bits))
                    rows, size, held = [], 0, held + len(found[-1][0])
                    if held > HELD // 8:
                        yield out()
                        found, held = [], 0
                of = block
                rows.append(row)
                size += len(row[1]) // 8
        if rows:
            found.append(merged(rows, shards, local, support, task_bits))
        if found:
            yield out()

    return run


def _bits(batch: pa.Table) -> pa.Table:
    bitmap = np.zeros(1 << _BLOCK_BITS, bool)
    bitmap[batch.column("at").to_numpy() & ((1 << _BLOCK_BITS) - 1)] = True
    return pa.table({"block": batch.column("block").slice(0, 1), "bits": pa.array([np.packbits(bitmap, bitorder="little").tobytes()])})


def bitmap_of(keys: DataFrame) -> bytes:
    """Two bits for each key, in a bitmap whose size follows their number up to a bound: made in blocks, which alone come to the driver."""
    size = min(max((BITS_A_PHRASE * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
    at = keys.select(F.explode(F.array(F.shiftrightunsigned("key", 64 - size), F.col("key").bitwiseAND((1 << size) - 1))).alias("at")).distinct()
    blocks = at.withColumn("block", F.shiftright("at", _BLOCK_BITS)).groupBy("block").applyInArrow(_bits, "block long, bits binary")
    out = bytearray(1 << (size - 3))
    step = 1 << (_BLOCK_BITS - 3)
    for r in blocks.toLocalIterator():
        out[r["block"] * step : (r["block"] + 1) * step] = r["bits"]
    return bytes(out)


def owned(keys: np.ndarray, task: np.ndarray) -> np.ndarray:
    """What stands in a bitmap for phrases that a task names."""
    return mixed(keys ^ (task.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTORS[0]))


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, task = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(owned(key, task).view(np.int64))], names=["key"])


def _named(longest: int, parts: list[Broadcast], by_owner: bool):
    """Batches of (lang, text) -> (lang, phrase, words, key, check, n): the phrases in bitmaps, each once a task; as phrase of no words, n of all words.

    by_owner: the bitmaps tell which task names a phrase, so others stay silent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, task = [np.frombuffer(p.value, np.uint8) for p in parts], TaskContext.get().partitionId()
        seen: list[set[tuple[int, int]]] = [set() for _ in range(longest)]
        total: dict[str, int] = {}

        def batch(lang: list, phrase: list, size: list, key: list, check: list, n: list) -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip((lang, phrase, size, key, check, n), kinds, strict=True)], names=["lang", "phrase", "words", "key", "check", "n"])

        for lang, words in by_language(batches):
            total[lang] = total.get(lang, 0) + len(words.start)
            for k in range(1, longest + 1):
                at = frequent(words, k, None)
                key = words.phrases(k)[at]
                fine = allowed(bitmaps[k - 1], owned(key, np.array([task])) if by_owner else key)
                at, key = at[fine], key[fine].view(np.int64)
                check = checks(words, k, at)
                new = [x for x in dict(zip(zip(key.tolist(), check.tolist(), strict=True), at.tolist(), strict=True)).items() if x[0] not in seen[k - 1]]
                if sum(map(len, seen)) > HELD // 2:
                    seen = [set() for _ in range(longest)]
                seen[k - 1].update(x for x, _ in new)
                if new:
                    m = len(new)
                    yield batch([lang] * m, [words.text(i, k) for _, i in new], [k] * m, [x for (x, _), _ in new], [y for (_, y), _ in new], [None] * m)
        total = {lang: n for lang, n in total.items() if n}
        m = len(total)
        yield batch(list(total), [""] * m, [0] * m, [None] * m, [None] * m, list(total.values()))

    return run


NAMED = "lang string, phrase string, words int, key long, check int, n long"


def phrase_counts(docs: DataFrame, *, longest: int = LONGEST, support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of one to ``longest`` words that occur ``support`` times, and (lang, '', 0, all words)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    local, parts, levels = -(-support // shards), None, []
    bits = max(rows.rdd.getNumPartitions().bit_length() + _BLOCKS_A_TASK, _LEAST_BLOCKS)
    for k in range(1, longest + 1):
        counts = rows.mapInArrow(_mine(k, parts, bits), COUNTS).repartition("block").sortWithinPartitions("block")
        levels.append(stored(counts.mapInArrow(_merge(shards, local, support, _TASK_BITS), FOUND)))
        if k < longest:
            parts = spark.sparkContext.broadcast(bitmap_of(levels[-1].select("key")))
    known = reduce(DataFrame.union, [level.select("key", "check", F.lit(k).alias("words"), "f") for k, level in enumerate(levels, 1)])

    def with_names(known: DataFrame, keys: list[DataFrame], by_owner: bool) -> tuple[DataFrame, DataFrame]:
        named = stored(rows.mapInArrow(_named(longest, [spark.sparkContext.broadcast(bitmap_of(x)) for x in keys], by_owner), NAMED))
        one = named.where("words > 0").groupBy("key", "check", "words").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))
        return stored(known.join(one, ["key", "check", "words"], "left")), named.where("words = 0")

    found, total = with_names(known, [level.select("key", "task").mapInArrow(_owners, "key long") for level in levels], True)
    # Should the texts have come in other partitions than before, what its task did not name is named by any.
    missing = found.where("phrase IS NULL").select("key", "check", "words", "f")
    if missing.limit(1).count():
        more, _ = with_names(missing, [missing.where(F.col("words") == k).select("key") for k in range(1, longest + 1)], False)
        found = found.where("phrase IS NOT NULL").unionByName(more)
    total = total.groupBy("lang").agg(F.sum("n").alias("f")).select("lang", F.lit("").alias("phrase"), F.lit(0).alias("words"), "f")
    return found.select("lang", "phrase", "words", "f").union(total)


def collocations(docs: DataFrame, *, longest: int = LONGEST, support: int = SUPPORT, shards: int = SHARDS, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's highest-scoring candidates that no longer one stands for."""
    counts = stored(phrase_counts(docs, longest=longest, support=support, shards=shards))
    candidates = counts.where("words >= 2").withColumnRenamed("f", "a")
    known = counts.where("words >= 1")
    # Every part of a candidate occurs as often as it, so it is counted too.
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)")).withColumn("right", F.expr("substring(phrase, char_length(left) + 2)"))
    for side, to in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(to)), ["lang", side])
    score = F.expr(f"(cast(a AS decimal(20,0)) * {SCALE}) div cast(cast(l AS decimal(20,0)) + r AS decimal(21,0))")
    least = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x"))
    inner = candidates.where("words >= 3").select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inner = inner.select("lang", "a", "phrase", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    inner = inner.select("lang", "a", F.expr("concat_ws(' ', slice(split(phrase, ' '), at, size))").alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = least.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR cast(longer AS decimal(20,0)) * 100 < cast(a AS decimal(20,0)) * {STANDS_FOR}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase"))
    first = left.withColumn("rank", rank).where(F.col("rank") <= top)
    # A row for each language.
    words = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "x.l", "x.r", "n", "x.score")


COLLOCATIONS_SQL = rf"""
WITH docs AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
phrases AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM placed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL),
words AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= {SUPPORT}),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p, array_to_string(w[cut + 1:], ' ') AS q FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (
  SELECT x.lang, x.phrase, x.a, x.cut, p.f AS l, q.f AS r, CAST(CAST({SCALE} AS HUGEINT) * x.a // (p.f + q.f) AS BIGINT) AS score
  FROM cuts x JOIN f p ON x.lang = p.lang AND x.p = p.phrase JOIN f q ON x.lang = q.lang AND x.q = q.phrase),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k >= 3)) GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {STANDS_FOR} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN words USING (lang) WHERE rank <= {TOP}
"""
