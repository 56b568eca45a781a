"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits, each read as a word of the perfect binary Golay
code (23, 12): the errors of a word's syndrome lead to its one codeword within three bits. Any two words that
differ in two bits at most have a codeword within four bits of both (the codeword nearest to a word midway is),
so the numbers of all codewords within four bits of a segment, one to six of them, are its keys. Pigeonhole: four
errors over three segments leave two segments with two errors in all at most, so two fingerprints that link share
a key made of two segments' keys, for one of the three pairs of segments.

The keys, some 85 for each different fingerprint, are shuffled and sorted; the fingerprints of one key are linked
by a breadth-first walk that compares what it has reached with what it has not, so a bucket of near copies costs
about its size, gives a tree of verified links rather than all pairs, and loses no link. A hot group's rows are
spread over its many keys. Components are then joined up in rounds.

A null text is empty; texts without a word have fingerprint zero. Repeated rows link through their equal
fingerprints. A null doc_id gets its component's smallest id and never is one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from siltwork.llm.common import stored
from siltwork.llm.components import smallest_reachable
from siltwork.llm.langid import byte_columns

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: (lowest bit, bits) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Bytes of shingle bits that are summed at once.
_SLICE = 1 << 15
#: Fingerprints that one task makes keys of, at most on average.
KEYED_ROWS = 50_000
#: Pairs that are compared at once.
_BLOCK = 1 << 20
#: What stands for a null number in numpy.
NO_NUMBER = -(1 << 63)
#: Buckets up to so many fingerprints are compared at once, all of one size together.
SMALL_BUCKET = 6


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the text's shingles of words, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = (np.fromiter(map(len, words), np.int64, len(words)) + 1).cumsum() - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    cuts = map(slice, starts[:n].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _SLICE):
        ones += np.unpackbits(hashes[lo : lo + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) of each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_columns(batch.column(1))
            data = data.tobytes()
            fps = [fingerprint(data[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=[key, "fp"])

    rows = docs.select(key, F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, rows.select(key, F.lit(0).cast("long").alias("fp")).schema)


def _golay() -> tuple[np.ndarray, np.ndarray]:
    """(check bits of each 12-bit message, error patterns of up to four bits for each syndrome, -1 for none)."""
    checks = np.zeros(4096, np.int64)
    for bit in range(12):
        rest = 1 << (bit + 11)
        for high in range(bit + 11, 10, -1):
            if rest >> high & 1:
                rest ^= GENERATOR << (high - 11)
        checks[(np.arange(4096) >> bit & 1) == 1] ^= rest
    errors = np.full((2048, 6), -1, np.int64)
    used = np.zeros(2048, np.int64)
    for weight in range(5):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            syndrome = (e & 2047) ^ int(checks[e >> 11])
            errors[syndrome, used[syndrome]] = e
            used[syndrome] += 1
    return checks, errors


_CHECKS, _ERRORS = _golay()


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, valid) of the codewords within four bits of each 23-bit word, six places a word."""
    errors = _ERRORS[(words & 2047) ^ _CHECKS[words >> 11]]
    return (words[:, None] ^ errors) >> 11 & 4095, errors >= 0


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, index into fps): two fingerprints within four bits of each other share a key at least."""
    bits = fps.view(np.uint64)
    near = [codewords((bits >> np.uint64(low) & np.uint64((1 << n) - 1)).astype(np.int64)) for low, n in SEGMENTS]
    keys, at = [], []
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        valid = near[i][1][:, :, None] & near[j][1][:, None, :]
        keys.append((pair << 24 | near[i][0][:, :, None] << 12 | near[j][0][:, None, :])[valid])
        at.append(np.nonzero(valid)[0])
    return np.concatenate(keys), np.concatenate(at)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for lo in range(0, len(fps), 4096):
            keys, at = golay_keys(np.ascontiguousarray(fps[lo : lo + 4096]))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[lo : lo + 4096][at])], names=["key", "fp"])


def _tree(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join up all fingerprints of one bucket that are joined by links within it, each to the nearest that was reached.

    What is reached is taken out of the rest, so near copies of one another cost their number, not its square.
    """
    rest = fps
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached, lo = [], 0
            while lo < len(front) and len(rest):
                some = front[lo : lo + max(1, _BLOCK // len(rest))]
                lo += len(some)
                apart = np.bitwise_count(some[:, None] ^ rest)
                hit = apart.min(0) <= bits
                if hit.any():
                    reached.append(rest[hit])
                    yield some[apart.argmin(0)[hit]], reached[-1]
                    rest = rest[~hit]
            front = np.concatenate(reached) if reached else front[:0]


def links_of_sorted(keys: np.ndarray, fps: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Verified links among fingerprints of equal keys; keys are sorted, each key's fingerprints are all there."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    size = np.diff(edge)
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for n in range(2, SMALL_BUCKET + 1):
        of = fps[edge[:-1][size == n][:, None] + np.arange(n)]
        i, j = np.triu_indices(n, 1)
        apart = np.bitwise_count(of[:, i] ^ of[:, j]).astype(np.int64)
        # A link that is the longest of a triangle of links leads nowhere that the two others don't; ties go by place.
        far = np.full((len(of), n, n), 1 << 20)
        far[:, i, j] = far[:, j, i] = np.where(apart <= bits, apart * 64 + i * 8 + j, 1 << 20)
        keep = apart <= bits
        for k in range(n):
            other = (i != k) & (j != k)
            keep[:, other] &= np.maximum(far[:, i[other], k], far[:, j[other], k]) > far[:, i[other], j[other]]
        row, pair = np.nonzero(keep)
        a.append(of[row, i[pair]])
        b.append(of[row, j[pair]])
    for k in np.flatnonzero(size > SMALL_BUCKET):
        # In order, so that the groups of near copies in many buckets gather around the same few fingerprints.
        for x, y in _tree(np.sort(fps[edge[k] : edge[k + 1]]), bits):
            a.append(x)
            b.append(y)
    return np.concatenate(a), np.concatenate(b)


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns, key first, of batches sorted by key, cut so that each key's rows come together; a null is the smallest number."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.fill_null(NO_NUMBER).to_numpy() for c in batch.columns]
        k = columns[0]
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1]))
        if cut or (held and held[-1][0][-1] != k[0]):
            done = [*held, [c[:cut] for c in columns]]
            held = []
            if sum(len(x[0]) for x in done):
                yield [np.concatenate(c) for c in zip(*done, strict=True)]
        held.append([c[cut:] for c in columns])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def link_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Different links (a, b), the smaller end first."""
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k]).view(np.int64)) for k in (0, 1)], names=["a", "b"])


def _linked(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, fps in whole_keys(batches):
            yield link_batch(*links_of_sorted(keys, fps.view(np.uint64), bits))

    return run


def fingerprint_links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between different fingerprints that join up all within ``bits`` (up to 4) of each other."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys find links of {MAX_BITS} bits at most")
    # A fingerprint becomes some 85 rows, so the few megabytes of a usual partition are dealt out further first.
    parts = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-fps.count() // KEYED_ROWS))
    return links_in_buckets(fps.select("fp").distinct().repartition(parts, "fp").mapInArrow(_keyed, "key long, fp long"), bits)


def links_in_buckets(keys: DataFrame, bits: int) -> DataFrame:
    """(a, b): of keys (key, fp), links within ``bits`` that join up what such links join in each bucket; a link may come from several."""
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(_linked(bits), "a long, b long")


def with_components(rows: DataFrame, *, key: str = "doc_id", bits: int = MAX_BITS) -> DataFrame:
    """rows (key, fp) with component_id: the smallest key that links lead to."""
    roots = smallest_reachable(fingerprint_links(rows, bits))
    classes = rows.groupBy("fp").agg(F.min(key).alias("least"))
    of = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(of.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs))
    return with_components(rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
