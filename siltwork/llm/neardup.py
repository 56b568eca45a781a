"""Near copies by the similarity of their word shingles, found by Golay-code fuzzy hashing of a long SimHash.

Texts are alike if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more. Two such texts differ
in some 15 % of the bits of a SimHash of those sets, far more than segments of a short fingerprint bear. So the
fingerprint is long: eight segments of two 23-bit words, each word read in the binary Golay code as in ``simhash``, and
a sketch of 64 bits more. The numbers of the codewords within four bits of a segment's two words are its keys, some 28
of 24 bits. A pair at similarity 0.8 shares a key of a given segment in 37 of 100 cases, and of one of the eight in 97;
at 0.9 in all but one of 2000.

The keys are used in two rounds. The first takes the first segments' keys: of the texts of a key, each is a candidate with
the one whose sketch is nearest, looked for among a few hundred in the order of sketches, and candidates are verified on
the shingles themselves. This joins up most of a large group of near copies at some comparisons a text. The second round
takes all keys, each with the component that its text has so far, and verifies all pairs of near sketches of one key but
those within one component, which can't change the outcome. A group of many texts around the bound has many such pairs
that don't link, so pairs are not written one by one: what the first round's candidates join, verified or not, is a loose
group, which is cut into blocks of a bounded number of texts and bytes, and a text with near sketches in a block is sent
there once, whatever their number. There all its pairs with the block's texts are counted in one go. Texts with equal sketches are verified against the one of
them with the smallest hash, which stands for all in the pairs: their sets are alike but for a few shingles.

A null text is empty; texts without a word are equal. A text of fewer than five words is one shingle. Repeated rows and
equal texts are one class. What stays is told by id and text: different texts of one id, or without one, are documents of
their own. A null id counts as the smallest. Columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from siltwork.llm.collocation import allowed, bitmap_of
from siltwork.llm.common import stored, unused
from siltwork.llm.components import smallest_reachable
from siltwork.llm.langid import byte_columns
from siltwork.llm.simhash import KEYED_ROWS, NO_NUMBER, SMALL_BUCKET, codewords, link_batch, whole_keys

SHINGLE, SEED = 5, 42
#: Least similarity of a link, as a fraction.
SIMILARITY = (4, 5)
#: Segments of the fingerprint and bits of a word; a segment has two words.
SEGMENTS, WORD = 8, 23
#: Bits that the sketches of two texts of similarity 0.8 differ in at most: 9.7 on average, 2.9 the deviation.
SKETCH_BITS = 19
MEMORY_WORDS = 500_000
_SLICE = 1 << 14
#: Pairs of sketches that are compared at once.
BLOCK = 1 << 20
#: Sketches of a key among which the first round looks for the nearest, and the segments whose keys it takes.
BLOCK_ROWS = 256
FIRST_SEGMENTS = 1
#: Texts and bytes of shingles of a block of a loose group, about.
BLOCK_SETS, BLOCK_BYTES = 256, 1 << 22
#: Blocks that a row names at once, as a logarithm: a bit for each in a long.
BLOCK_SET = 6
_HASHES = -(-2 * WORD * SEGMENTS // 64)


class _Hashes(dict):
    """word -> its 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY_WORDS:
            self.clear()
        n = self[word] = xxh64_intdigest(word, SEED)
        return n


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A hash of 64-bit numbers, for each salt another one."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, hashes: _Hashes, shingle: int = SHINGLE) -> np.ndarray:
    """The different hashes of the text's shingles of words, A-Z lower-cased, in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - shingle + 1, 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(shingle, len(words))):
        out = (out ^ h[k : k + n]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def long_simhash(hashes: np.ndarray) -> np.ndarray:
    """The sketch, then each segment's two words, as numbers."""
    ones = np.zeros(64 * (_HASHES + 1), np.int64)
    for lo in range(0, len(hashes), _SLICE):
        part = np.stack([_mixed(hashes[lo : lo + _SLICE], salt) for salt in range(_HASHES + 1)], 1)
        ones += np.unpackbits(part.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    bits = 2 * ones > len(hashes)
    words = bits[64 : 64 + 2 * WORD * SEGMENTS].reshape(SEGMENTS, 2 * WORD)
    return np.concatenate([np.packbits(bits[:64], bitorder="little").view("<u8"), words @ (np.uint64(1) << np.arange(2 * WORD, dtype=np.uint64))])


ROWS = "id long, text_hash long, same long, sketch long, words binary, shingles binary"


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> (id, text_hash, same: a hash of the set of shingles, sketch, words, shingles: 32 bits of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                data, offsets = byte_columns(batch.column(2))
                data, same, sketch, words, sets = data.tobytes(), [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    found = shingles(data[a:b], hashes)
                    fp = long_simhash(found)
                    same.append(xxh64_intdigest(found.tobytes(), SEED))
                    sketch.append(fp[0])
                    words.append(fp[1:].astype("<u8").tobytes())
                    sets.append(np.unique((found >> np.uint64(32)).astype("<u4")).tobytes())
                both = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (same, sketch)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *both, pa.array(words, pa.binary()), pa.array(sets, pa.binary())], names=["id", "text_hash", "same", "sketch", "words", "shingles"])

    return docs.select("id", text_hash().alias("text_hash"), F.col("text").cast("binary").alias("text")).mapInArrow(run, ROWS)


def segment_keys(words: np.ndarray, segments: int = SEGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the first segments of rows of segments' words."""
    keys, at = [], []
    for k in range(segments):
        (one, ok1), (two, ok2) = (codewords((words[:, k] >> np.uint64(s) & np.uint64((1 << WORD) - 1)).astype(np.int64)) for s in (0, WORD))
        valid = ok1[:, :, None] & ok2[:, None, :]
        keys.append((k << 24 | one[:, :, None] << 12 | two[:, None, :])[valid])
        at.append(np.nonzero(valid)[0])
    return np.concatenate(keys), np.concatenate(at)


def keyed(classes: DataFrame, segments: int) -> DataFrame:
    """classes (sketch, words, and what more there is) -> a row of key and all but words for each key of the first segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.slice(lo, 2048)
                words = np.frombuffer(b"".join(part.column("words").to_pylist()), "<u8").reshape(len(part), SEGMENTS)
                keys, at = segment_keys(words, segments)
                rest = part.drop_columns(["words"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *rest.columns], names=["key", *rest.schema.names])

    # A sketch becomes up to some two hundred rows, so the few megabytes of a usual partition are dealt out further first.
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-classes.count() // KEYED_ROWS))
    names = [c for c in classes.columns if c != "words"]
    return classes.repartition(parts, "sketch").mapInArrow(run, ", ".join(f"{c} long" for c in ["key", *names]))


def nearest(keys: np.ndarray, sketches: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each sketch with the nearest of its key, within bits; keys are sorted. Of more than BLOCK_ROWS of a key, the nearest of a block of neighbours in order."""
    order = np.lexsort((sketches, keys))
    keys, sketches = keys[order], sketches[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    blocks = [np.arange(lo, hi, BLOCK_ROWS) for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    start = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
    size = np.diff(start, append=len(keys))
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for n in np.unique(size[size > 1]).tolist():
        at = start[size == n]
        some = max(1, BLOCK // (n * n))
        for lo in range(0, len(at), some):
            of = sketches[at[lo : lo + some, None] + np.arange(n)]
            apart = np.bitwise_count(of[:, :, None] ^ of[:, None, :])
            apart[:, np.arange(n), np.arange(n)] = 255
            best = apart.argmin(2)
            hit = np.take_along_axis(apart, best[:, :, None], 2)[:, :, 0] <= bits
            a.append(of[hit])
            b.append(np.take_along_axis(of, best, 1)[hit])
    return np.concatenate(a), np.concatenate(b)


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, sketches in whole_keys(batches):
        yield link_batch(*nearest(keys, sketches.view(np.uint64), SKETCH_BITS))


def pairs_between(keys: np.ndarray, sketches: np.ndarray, roots: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of sketches of one key within bits of each other, but those of one root; keys are sorted, and a row without a root is alone.

    Pairs within a component are not even compared: in a bucket the components come by size, the largest last, and each
    is compared with those after it, some rows at a time.
    """
    alone = roots == NO_NUMBER
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    size = np.diff(edge)
    for n in range(2, SMALL_BUCKET + 1):
        at = edge[:-1][size == n][:, None] + np.arange(n)
        i, j = np.triu_indices(n, 1)
        x, y = at[:, i].ravel(), at[:, j].ravel()
        hit = (np.bitwise_count(sketches[x] ^ sketches[y]) <= bits) & (alone[x] | (roots[x] != roots[y]))
        yield sketches[x[hit]], sketches[y[hit]]
    for k in np.flatnonzero(size > SMALL_BUCKET):
        part = slice(edge[k], edge[k + 1])
        of = np.unique(roots[part], return_inverse=True)[1]
        single = alone[part]
        of[single] = len(of) + np.arange(single.sum())
        held = np.bincount(of)[of]
        order = np.lexsort((of, held))
        row, of = sketches[part][order], of[order]
        end = np.flatnonzero(np.concatenate([of[1:] != of[:-1], [True]])) + 1
        ends = np.repeat(end, np.diff(end, prepend=0))
        lo = 0
        while lo < len(row) and ends[lo] < len(row):
            hi = min(lo + max(1, BLOCK // (len(row) - ends[lo])), len(row))
            after = np.arange(ends[lo], len(row))
            near = (np.bitwise_count(row[lo:hi, None] ^ row[None, ends[lo] :]) <= bits) & (after[None, :] >= ends[lo:hi, None])
            x, y = np.nonzero(near)
            yield row[lo:hi][x], row[ends[lo] :][y]
            lo = hi


def block_of(group: Column, part: Column) -> Column:
    """The number of a group's block: a hash of the group and of the set of 64 parts, then the part in the set."""
    return F.shiftleft(F.xxhash64(group, F.expr("part div 64")), BLOCK_SET).bitwiseOR(part % (1 << BLOCK_SET))


def _sent_to(come: list[np.ndarray], blocks: list[np.ndarray]) -> pa.RecordBatch:
    """(a, blocks, bits): each sketch once for each set of 64 blocks, a bit for each of these that it goes to."""
    a, to = np.concatenate(come).view(np.int64), np.concatenate(blocks)
    of, bits = to >> BLOCK_SET, np.uint64(1) << (to & ((1 << BLOCK_SET) - 1)).astype(np.uint64)
    order = np.lexsort((of, a))
    a, of, bits = a[order], of[order], bits[order]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (of[1:] != of[:-1])])) if len(a) else np.zeros(0, np.int64)
    bits = np.bitwise_or.reduceat(bits, start) if len(a) else bits
    return pa.RecordBatch.from_arrays([pa.array(a[start]), pa.array(of[start]), pa.array(bits.view(np.int64))], names=["a", "blocks", "bits"])


def _near_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets (key, sketch, root, block) -> (a, blocks, bits): a sketch with the blocks of near ones, of another root or alone.

    A text without a root goes to one that has one, else the smaller to the larger.
    """
    come, to, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for keys, sketches, roots, blocks in whole_keys(batches):
        sketches = sketches.view(np.uint64)
        order = np.argsort(sketches, kind="stable")
        known, at, alone = sketches[order], blocks[order], roots[order] == NO_NUMBER
        for a, b in pairs_between(keys, sketches, roots, SKETCH_BITS):
            i, j = np.searchsorted(known, a), np.searchsorted(known, b)
            goes = np.where(alone[i] == alone[j], a < b, alone[i])
            come.append(np.where(goes, a, b))
            to.append(at[np.where(goes, j, i)])
            held += len(a)
            if held > BLOCK:
                yield _sent_to(come, to)
                come, to, held = come[:1], to[:1], 0
    yield _sent_to(come, to)


def _alike_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, comes, same, root, shingles) by block, its own texts first -> (a, b): links of those that come with the block's, one for each root."""
    num, den = SIMILARITY
    held: list[tuple[int, int, np.ndarray]] = []
    block, index = None, None
    for batch in batches:
        a, b = [], []
        for of, comes, same, root, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = np.frombuffer(data, "<u4")
            if of != block:
                block, held, index = of, [], None
            if not comes:
                held.append((same, root, x))
                continue
            if not held:
                continue
            if index is None:
                owner = np.repeat(np.arange(len(held)), [len(y) for _, _, y in held])
                tokens = np.concatenate([y for _, _, y in held])
                order = np.argsort(tokens, kind="stable")
                index = tokens[order], owner[order], np.array([len(y) for _, _, y in held])
            tokens, owner, sizes = index
            lo, hi = np.searchsorted(tokens, x, "left"), np.searchsorted(tokens, x, "right")
            n = hi - lo
            at = np.repeat(lo - (n.cumsum() - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(held))
            found: dict[int | None, int] = {}
            for i in np.flatnonzero(den * both >= num * (len(x) + sizes - both)).tolist():
                other, its = held[i][:2]
                if other != same and (root is None or its != root):
                    found.setdefault(other if its is None else its, other)
            a += [same] * len(found)
            b += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def in_blocks(classes: DataFrame, rows: DataFrame, root: DataFrame, loose: DataFrame) -> DataFrame:
    """(a, b): verified links between texts with near sketches of one key that root (node, root) does not join; loose (node, root): the loose groups."""
    sizes = rows.groupBy("same").agg(F.max(F.length("shingles")).alias("bytes"))
    of = classes.join(root.withColumnRenamed("node", "same"), "same", "left").join(loose.select(F.col("node").alias("same"), F.col("root").alias("loose")), "same", "left").join(sizes, "same")
    of = of.withColumn("loose", F.coalesce("loose", "same"))
    need = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("bytes") / BLOCK_BYTES))
    # Only groups of more than one block have a row here.
    cut = of.groupBy("loose").agg(need.alias("blocks")).where("blocks > 1")
    labelled = of.join(cut, "loose", "left").withColumn("part", F.pmod(F.xxhash64("sketch"), F.coalesce("blocks", F.lit(1)))).withColumn("block", block_of(F.col("loose"), F.col("part")))
    labelled = stored(labelled.select("sketch", "same", "words", "root", "block"))
    # A text meets the same near ones under many keys: sets of blocks are added up as bits before they are told apart.
    near = in_buckets(keyed(labelled.select("sketch", "words", "root", "block"), SEGMENTS), _near_blocks, "a long, blocks long, bits long")
    near = near.groupBy("a", "blocks").agg(F.bit_or("bits").alias("bits"))
    one = F.explode(F.expr(f"filter(sequence(0, {(1 << BLOCK_SET) - 1}), i -> shiftright(bits, i) & 1 = 1)"))
    sent = stored(near.select("a", "blocks", one.alias("part")).select("a", F.shiftleft("blocks", BLOCK_SET).bitwiseOR(F.col("part").cast("long")).alias("block")))
    there = labelled.join(sent.select("block").distinct().hint("shuffle_hash"), "block", "left_semi")
    come = sent.join(labelled.select(F.col("sketch").alias("a"), "same", "root"), "a")
    need = stored(there.select("block", F.lit(False).alias("comes"), "same", "root").union(come.select("block", F.lit(True), "same", "root")))
    sets = wanted_sets(rows, need).hint("merge")
    return need.join(sets, "same").select("block", "comes", "same", "root", "shingles").repartition("block").sortWithinPartitions("block", "comes").mapInArrow(_alike_in_blocks, "a long, b long")


def in_buckets(keys: DataFrame, near: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str = "a long, b long") -> DataFrame:
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(near, schema)


def of_sketches(near: DataFrame, classes: DataFrame) -> DataFrame:
    """Different pairs (a, b) of the sets of shingles that stand for the sketches of near (a, b)."""
    of = classes.select("sketch", "same")
    near = near.distinct().join(of.select(F.col("sketch").alias("a"), F.col("same").alias("x")), "a").join(of.select(F.col("sketch").alias("b"), F.col("same").alias("y")), "b")
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    num, den = SIMILARITY
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(den * both >= num * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])


def wanted_sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(same, shingles) of the sets that nodes (same) name, each different set once.

    Few sets are candidates, so a bitmap of bounded size, two bits a set, holds back most of the others where they are
    read; what it lets pass is hashed together and joined exactly.
    """
    nodes = stored(nodes.select("same").distinct())
    shared = rows.sparkSession.sparkContext.broadcast(bitmap_of(nodes.select(F.col("same").alias("key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(allowed(bitmap, batch.column(0).to_numpy().view(np.uint64))))

    some = rows.select("same", "shingles").mapInArrow(run, "same long, shingles binary")
    return some.dropDuplicates(["same"]).join(nodes.hint("shuffle_hash"), "same", "left_semi")


def sets_of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(same, shingles) of all that pairs (a, b) name."""
    return wanted_sets(rows, pairs.select(F.explode(F.array("a", "b")).alias("same")))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets of shingles are alike. What is joined grows with the corpus: by shuffles at any size."""
    sides = [sets.select(F.col("same").alias(end), F.col("shingles").alias(to)).hint("merge") for end, to in (("a", "x"), ("b", "y"))]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", "x", "y").mapInArrow(_alike, "a long, b long")


def links(rows: DataFrame) -> DataFrame:
    """(a, b): verified links that join up all sets of shingles that are joined by links."""
    classes = rows.groupBy("sketch").agg(F.min(F.struct("same", "words")).alias("least"), F.max("same").alias("high"))
    classes = stored(classes.select("sketch", "least.same", "least.words", "high"))
    several = classes.where("same <> high").select("sketch", F.col("same").alias("a"))
    twins = rows.join(several, "sketch").where(F.col("same") != F.col("a")).select("a", F.col("same").alias("b")).distinct()
    close = in_buckets(keyed(classes.select("sketch", "words"), FIRST_SEGMENTS), _nearest)
    first = stored(of_sketches(close, classes).union(twins))
    known = stored(verified(first, sets_of(first, rows)))
    root = stored(smallest_reachable(known))
    # The verified pairs are among the first ones, so both further searches start from the stars that they make.
    stars = root.select(F.col("node").alias("a"), F.col("root").alias("b"))
    loose = stored(smallest_reachable(stars.union(first)))
    return stars.union(in_blocks(classes, rows, root, loose))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Of each component of alike texts the document with the smallest doc_id, of several texts under that id one; of repeated rows of it, one. A null id is the smallest."""
    smallest = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long")
    rows = stored(fingerprints(docs.select(smallest.alias("id"), "text")))
    roots = smallest_reachable(links(rows))
    classes = rows.groupBy("same").agg(F.min(F.struct("id", "text_hash")).alias("least"))
    of = classes.join(roots.withColumnRenamed("node", "same"), "same", "left").select(F.coalesce("root", "same").alias("root"), "least")
    stay = of.groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    # What stays grows with the corpus: it is hashed in the partitions of a shuffle, never broadcast.
    copies = rows.groupBy("id", "text_hash").agg(F.count("*").alias("copies")).join(stay, ["id", "text_hash"], "left_semi")
    key, of, n = (unused(docs.columns, c) for c in ("_stays", "_text_hash", "_copies"))
    found = docs.join(stored(copies.select(F.col("id").alias(key), F.col("text_hash").alias(of), F.col("copies").alias(n))).hint("shuffle_hash"), (smallest == F.col(key)) & (text_hash() == F.col(of)))
    once = found.where(F.col(n) == 1).select(*docs.columns)
    return once.union(found.where(F.col(n) > 1).dropDuplicates([key, of]).select(*docs.columns))
