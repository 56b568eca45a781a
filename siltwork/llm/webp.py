"""Lossless WebP: a decoder of the whole format in numpy and Python, and an encoder for columns of bytes.

The decoder reads RIFF containers with a VP8L stream: prefix codes (simple and normal, meta-coded), literal pixels,
LZ77 back-references with the two-dimensional distance map, the colour cache, and the inverse predictor (14 modes),
cross-colour, subtract-green and palette transforms (with pixel bundling). It gives pixels as height x width x 4
arrays of 8-bit samples (red, green, blue, alpha).

A stream whose pixels take one prefix code each (all codes but green's have a single symbol, no cache, no meta
codes) is decoded through a table that maps the next bits to all symbols that they complete; every other stream
takes the general loop. Both read each symbol by its code.

The encoder stores bytes as grey pixels: subtract-green leaves one prefix code a pixel, a line that has occurred
before becomes a back-reference, a predictor (left or above) goes before that where differences take fewer bits, and
at most 16 different values become a bundled palette image. For the tests it also writes all predictors, cross-colour
and colour-cache streams.

A null or empty text is one row of padding. Repeated rows give equal media; a null doc_id stays. An empty table gives
no rows. The digest reads doc_id and text only; ``with_media`` and ``with_pixels`` keep all columns and refuse a table
that has the column they add.

A payload longer than one image's rows is stored as several images, one container after another.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.common import unused
from siltwork.llm.langid import byte_columns

#: Bytes of one row of samples; payloads are padded to a multiple of it.
ROW = 576
#: Rows of one image at most: the format allows 16384, its back-references reach 2 ** 20 pixels, and this bounds memory.
MAX_ROWS = 1800
PAD = 255
#: Fixed values of the format: the order of code-length codes, and the near distances (x, y) of distance codes 1 to 120.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
#: Longest code of a literal that the encoder writes: short ones keep the decoder's table small.
GREEN_BITS = 11
#: Bytes of a stream whose windows are looked up together.
_BLOCK = 1 << 14
#: Bits of a predictor tile's side.
TILE = 9
#: Shortest line that a back-reference replaces.
_MATCH = 24


def near_distances() -> list[tuple[int, int]]:
    """(x, y) of the 120 near distances: pixels above within seven rows, or left in the row, the closest first."""
    near = [(x, 0) for x in range(1, 9)] + [(x, y) for y in range(1, 8) for x in range(-7, 9)]
    # Ties of the distance: the smaller |x| first, the right of a mirrored pair before the left.
    return sorted(near, key=lambda p: (p[0] * p[0] + p[1] * p[1], abs(p[0]), -p[0]))


# --- prefix codes -----------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = 15) -> np.ndarray:
    """Huffman code lengths of at most ``limit`` bits; a lone symbol gets 1."""
    lengths, used = np.zeros(len(counts), np.int64), np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    weights = counts[used].tolist()
    while True:
        heap = [(w, i) for i, w in enumerate(weights)]
        heapq.heapify(heap)
        parent, n = [0] * (2 * len(used) - 1), len(used)
        while len(heap) > 1:
            a, i = heapq.heappop(heap)
            b, j = heapq.heappop(heap)
            parent[i] = parent[j] = n
            heapq.heappush(heap, (a + b, n))
            n += 1
        depth = [0] * n
        for i in range(n - 2, -1, -1):
            depth[i] = depth[parent[i]] + 1
        if max(depth[: len(used)]) <= limit:
            lengths[used] = depth[: len(used)]
            return lengths
        weights = [w // 2 + 1 for w in weights]


def _reversed_bits() -> np.ndarray:
    out = np.zeros(1 << 15, np.int64)
    for bit in range(15):
        out |= (np.arange(1 << 15) >> bit & 1) << (14 - bit)
    return out


_REVERSED = _reversed_bits()


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol, its first bit lowest."""
    n = np.bincount(lengths, minlength=16)
    n[0] = 0
    first, code = [0] * 16, 0
    for size in range(1, 16):
        code = (code + int(n[size - 1])) << 1
        first[size] = code
    order = np.argsort(lengths, kind="stable")[len(lengths) - int(n.sum()) :]
    size = lengths[order]
    codes = np.zeros(len(lengths), np.int64)
    codes[order] = _REVERSED[np.array(first)[size] + np.arange(len(order)) - (n.cumsum() - n)[size]] >> (15 - size)
    return codes


class Prefix:
    """A decoding table: the next ``width`` bits give (symbol, length)."""

    @classmethod
    def lone(cls, symbol: int) -> Prefix:
        """The code of one symbol, which takes no bits."""
        out = cls.__new__(cls)
        out.single, out.width = symbol, 0
        return out

    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        self.single = int(used[0]) if len(used) == 1 else (0 if not len(used) else -1)
        self.width = int(lengths.max()) if len(used) > 1 else 0
        if self.single < 0:
            if (1 << self.width) != int((1 << (self.width - lengths[used])).sum()):
                raise ValueError("the prefix code isn't complete")
            # In the order of lengths, codes read from their first bit fill the table from its start; each place's bits are then turned around.
            order = used[np.argsort(lengths[used], kind="stable")]
            n = lengths[order]
            place = _REVERSED[: 1 << self.width] >> (15 - self.width)
            symbol, length = (np.repeat(x, 1 << (self.width - n))[place] for x in (order, n))
            size = 1 << self.width
            self.array = symbol, length
            self.symbol, self.length, self.mask = symbol.tolist(), length.tolist(), size - 1

    def read(self, bits: Bits) -> int:
        if self.single >= 0:
            return self.single
        at = bits.peek() & self.mask
        bits.at += self.length[at]
        return self.symbol[at]


class Bits:
    """A bit reader, lowest bits first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data + bytes(16), 8 * at

    def peek(self) -> int:
        byte = self.at >> 3
        return int.from_bytes(self.data[byte : byte + 5], "little") >> (self.at & 7)

    def take(self, n: int) -> int:
        out = self.peek() & ((1 << n) - 1)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the stream is cut off")
        return out


def _read_prefix(bits: Bits, size: int) -> Prefix:
    lengths = np.zeros(size, np.int64)
    if bits.take(1):  # simple: one or two symbols
        n = bits.take(1) + 1
        first = bits.take(8 if bits.take(1) else 1)
        if n == 1:
            return Prefix.lone(first)
        lengths[[first, bits.take(8)]] = 1
        return Prefix(lengths)
    order = np.zeros(19, np.int64)
    for k in range(4 + bits.take(4)):
        order[LENGTH_ORDER[k]] = bits.take(3)
    inner = Prefix(order)
    left = 2 + bits.take(2 + 2 * bits.take(3)) if bits.take(1) else size
    at, before = 0, 8
    while at < size and left > 0:
        left -= 1
        s = inner.read(bits)
        if s < 16:
            lengths[at] = s
            before = s or before
            at += 1
            continue
        n, value = (3 + bits.take(2), before) if s == 16 else (3 + bits.take(3), 0) if s == 17 else (11 + bits.take(7), 0)
        if at + n > size:
            raise ValueError("code lengths run over")
        lengths[at : at + n] = value
        at += n
    return Prefix(lengths)


def _extra(symbol: int, bits: Bits) -> int:
    """A length or distance from its prefix symbol."""
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.take(n) + 1


@lru_cache(maxsize=1)
def _near() -> tuple[tuple[int, int], ...]:
    return tuple(near_distances())


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    x, y = _near()[code - 1]
    return max(1, x + y * width)


def _symbols_of(prefix: Prefix, peek: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``peek`` bits: the literals that it completes, up to the first symbol that is none, their number and their bits."""
    symbol, length = prefix.array
    window = np.arange(1 << peek)
    used, count, open_ = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64), np.ones(len(window), bool)
    steps = []
    while open_.any():
        at = (window >> used) & prefix.mask
        n, s = length[at], symbol[at]
        open_ = open_ & (used + n <= peek) & (s < 256)
        steps.append(s.astype(np.uint8))
        used += n * open_
        count += open_
    return np.stack(steps, 1), count, used.astype(np.uint8)


def _decode_single(bits: Bits, green: Prefix, distance: Prefix, width: int, total: int) -> np.ndarray:
    """Green samples of the stream's last image, of which only green takes bits.

    The windows at all bits of a block are looked up at once; those that follow one another are walked to the stream's
    end, with back-references noted, then the literals of all of them are taken out together and the copies made.
    """
    data = np.frombuffer(bits.data, np.uint8)
    peek = 11 if total >= 20_000 else 10 if total >= 2_000 else 8
    table, count, used = _symbols_of(green, peek)
    at, last = bits.at, 8 * (len(data) - 16)
    passed, found, copies = 0, [], []  # windows, and (windows before it, length, distance; or a literal of a long code and 0)
    while at < last:
        base = at & ~7
        part = data[base >> 3 : min((base >> 3) + _BLOCK, last >> 3) + 2].astype(np.uint32)
        part = part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)
        windows = ((part[:, None] >> np.arange(8, dtype=np.uint32)) & np.uint32((1 << peek) - 1)).ravel()
        steps, limit, walked = used[windows].tobytes(), len(windows), []
        walk = walked.append
        at -= base
        while at < limit:
            if step := steps[at]:
                walk(at)
                at += step
                continue
            bits.at = base + at
            s = green.read(bits)
            copies.append((passed + len(walked), s, 0) if s < 256 else (passed + len(walked), _extra(s - 256, bits), _distance(_extra(distance.read(bits), bits), width)))
            at = bits.at - base
        found.append(windows[walked])
        passed += len(walked)
        at += base
    windows = np.concatenate(found) if found else np.zeros(0, np.int64)
    n = count[windows]
    ends = memoryview(np.concatenate([[0], n.cumsum()]))
    literals = table[windows][np.arange(table.shape[1]) < n[:, None]].tobytes()
    out, done = bytearray(), 0
    for upto, n, d in copies:
        out += literals[ends[done] : ends[upto]]
        done, have = upto, len(out)
        if have >= total:
            break
        if not d:
            out.append(n)
            continue
        if d > have or have + n > total:
            raise ValueError("a back-reference leaves the image")
        out += out[have - d : have - d + n] if d >= n else (bytes(out[have - d :]) * (n // d + 1))[:n]
    out += literals[ends[done] :]
    if len(out) < total:
        raise ValueError("the stream is cut off")
    return np.frombuffer(bytes(out[:total]), np.uint8)


def _decode_pixels(bits: Bits, width: int, height: int, top: bool) -> np.ndarray:
    """ARGB pixels (uint32) of one entropy-coded image; only the top one may have meta prefix codes."""
    cache_bits = bits.take(4) if bits.take(1) else 0
    if cache_bits > 11:
        raise ValueError("colour cache of too many bits")
    meta, shift, groups = None, 0, 1
    if top and bits.take(1):
        shift = bits.take(3) + 2
        across = (width + (1 << shift) - 1) >> shift
        down = (height + (1 << shift) - 1) >> shift
        meta = (_decode_pixels(bits, across, down, False) >> np.uint32(8) & np.uint32(0xFFFF)).tolist()
        groups = max(meta) + 1
    codes = [[_read_prefix(bits, n) for n in (256 + 24 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)] for _ in range(groups)]
    total = width * height
    if top and meta is None and not cache_bits and codes[0][0].single < 0 and all(c.single >= 0 for c in codes[0][1:4]):
        green, red, blue, alpha, distance = codes[0]
        base = np.uint32(alpha.single << 24 | red.single << 16 | blue.single)
        return base | _decode_single(bits, green, distance, width, total).astype(np.uint32) << np.uint32(8)
    out, cache, have = [0] * total, [0] * (1 << cache_bits), 0
    cached = 0
    while have < total:
        y, x = divmod(have, width)
        green, red, blue, alpha, distance = codes[meta[(y >> shift) * across + (x >> shift)] if meta else 0]
        s = green.read(bits)
        if s < 256:
            r, b = red.read(bits), blue.read(bits)
            out[have] = alpha.read(bits) << 24 | r << 16 | s << 8 | b
            have += 1
        elif s < 280:
            n = _extra(s - 256, bits)
            d = _distance(_extra(distance.read(bits), bits), width)
            if d > have or have + n > total:
                raise ValueError("a back-reference leaves the image")
            for k in range(have, have + n):
                out[k] = out[k - d]
            have += n
        else:
            while cached < have:
                cache[(0x1E35A7BD * out[cached] & 0xFFFFFFFF) >> (32 - cache_bits)] = out[cached]
                cached += 1
            out[have] = cache[s - 280]
            have += 1
        if bits.at > 8 * len(bits.data):
            raise ValueError("the stream is cut off")
    return np.array(out, np.uint32)


# --- transforms -------------------------------------------------------------------------------------------------


def _channels(argb: np.ndarray) -> np.ndarray:
    """... x 4 samples (alpha, red, green, blue)."""
    return np.stack([(argb >> np.uint32(s) & np.uint32(255)).astype(np.int16) for s in (24, 16, 8, 0)], -1)


def _argb(samples: np.ndarray) -> np.ndarray:
    s = (samples & 255).astype(np.uint32)
    return s[..., 0] << np.uint32(24) | s[..., 1] << np.uint32(16) | s[..., 2] << np.uint32(8) | s[..., 3]


def predict(mode: int, left: np.ndarray, top: np.ndarray, top_right: np.ndarray, top_left: np.ndarray) -> np.ndarray:
    """The prediction of pixels (samples as int16, alpha first) from their neighbours."""
    half = lambda a, b: (a + b) >> 1
    if mode in (0, 14, 15):  # the last two are in no use, and decoders take them for the first
        out = np.zeros_like(left)
        out[..., 0] = 255
        return out
    if mode == 11:
        by_left, by_top = np.abs(top - top_left).sum(-1, keepdims=True), np.abs(left - top_left).sum(-1, keepdims=True)
        return np.where(by_left < by_top, left, top)
    if mode == 12:
        return np.clip(left + top - top_left, 0, 255)
    if mode == 13:
        mean = half(left, top)
        off = mean - top_left
        return np.clip(mean + np.where(off < 0, -(-off >> 1), off >> 1), 0, 255)
    simple = {1: lambda: left, 2: lambda: top, 3: lambda: top_right, 4: lambda: top_left, 5: lambda: half(half(left, top_right), top), 6: lambda: half(left, top_left), 7: lambda: half(left, top), 8: lambda: half(top_left, top), 9: lambda: half(top, top_right), 10: lambda: half(half(left, top_left), half(top, top_right))}
    return simple[mode]()


def _neighbours(p: np.ndarray, y: int, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    above = p[y - 1]
    return p[y, x - 1], above[x], above[x + 1] if x + 1 < p.shape[1] else p[y, 0], above[x - 1]


def _mode_at(y: int, x: int, modes: np.ndarray, shift: int) -> int:
    if y == 0:
        return 1 if x else 0
    return int(modes[y >> shift, x >> shift]) if x else 2


def _unpredict(argb: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    """Adds predictions to residuals. A row is predicted from the row above at once where no mode looks left."""
    p = _channels(argb)
    h, w = argb.shape
    p[0, 0, 0] = (p[0, 0, 0] + 255) & 255
    p[0] = p[0].cumsum(0, dtype=np.int64) & 255
    free = frozenset((2, 3, 4, 8, 9))
    for y in range(1, h):
        p[y, 0] = (p[y, 0] + p[y - 1, 0]) & 255
        x = 1
        while x < w:
            end = min(((x >> shift) + 1) << shift, w)
            mode = int(modes[y >> shift, x >> shift])
            if mode in free or mode in (0, 14, 15):
                top, top_left = p[y - 1, x:end], p[y - 1, x - 1 : end - 1]
                right = np.concatenate([p[y - 1, x + 1 : end + 1], p[y, :1]])[: end - x]
                p[y, x:end] = (p[y, x:end] + predict(mode, top, top, right, top_left)) & 255
            elif mode == 1:
                p[y, x:end] = (p[y, x:end].cumsum(0, dtype=np.int64) + p[y, x - 1]) & 255
            else:
                for k in range(x, end):
                    p[y, k] = (p[y, k] + predict(mode, *_neighbours(p, y, k))) & 255
            x = end
    return _argb(p)


def _signed(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int16) ^ 128) - 128


def _cross(argb: np.ndarray, elements: np.ndarray, shift: int, sign: int) -> np.ndarray:
    """Adds (sign 1) or takes away (-1) what green, and red for blue, tell of red and blue."""
    h, w = argb.shape
    e = _channels(elements)[np.arange(h)[:, None] >> shift, np.arange(w)[None] >> shift]
    p = _channels(argb)
    delta = lambda t, c: (_signed(t) * _signed(c)) >> 5
    green, red = p[..., 2], p[..., 1]
    new_red = (red + sign * delta(e[..., 3] & 255, green)) & 255
    source = new_red if sign > 0 else red
    blue = (p[..., 3] + sign * (delta(e[..., 2] & 255, green) + delta(e[..., 1] & 255, source))) & 255
    p[..., 1], p[..., 3] = new_red, blue
    return _argb(p)


def _decode_stream(data: bytes) -> np.ndarray:
    bits = Bits(data)
    if bits.take(8) != 0x2F:
        raise ValueError("no VP8L stream")
    width, height = bits.take(14) + 1, bits.take(14) + 1
    bits.take(1)
    if bits.take(3):
        raise ValueError("unknown VP8L version")
    undo, across = [], width
    while bits.take(1):
        kind = bits.take(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.take(3) + 2
            w, h = (across + (1 << shift) - 1) >> shift, (height + (1 << shift) - 1) >> shift
            block = _decode_pixels(bits, w, h, False).reshape(h, w)
            if kind == PREDICTOR:
                modes = block >> np.uint32(8) & np.uint32(15)
                undo.append(lambda p, m=modes, s=shift: _unpredict(p, m, s))
            else:
                undo.append(lambda p, e=block, s=shift: _cross(p, e, s, 1))
        elif kind == SUBTRACT_GREEN:
            undo.append(lambda p: (p & np.uint32(0xFF00FF00)) | ((p & np.uint32(0x00FF00FF)) + (p >> np.uint32(8) & np.uint32(255)) * np.uint32(0x10001)) & np.uint32(0x00FF00FF))
        else:
            n = bits.take(8) + 1
            colours = _argb(_channels(_decode_pixels(bits, n, 1, False)).cumsum(0, dtype=np.int64))
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            table = np.zeros(256, np.uint32)
            table[:n] = colours
            undo.append(lambda p, t=table, k=pack, w=across: t[_unbundle(p >> np.uint32(8) & np.uint32(255), k, w)])
            across = (across + (1 << pack) - 1) >> pack
    argb = _decode_pixels(bits, across, height, True).reshape(height, across)
    for step in reversed(undo):
        argb = step(argb)
    return argb


def _unbundle(index: np.ndarray, pack: int, width: int) -> np.ndarray:
    if not pack:
        return index
    each = 8 >> pack
    parts = index[:, :, None] >> (each * np.arange(1 << pack, dtype=np.uint32)) & np.uint32((1 << each) - 1)
    return parts.reshape(len(index), -1)[:, :width]


def containers(data: bytes) -> Iterator[bytes]:
    """The RIFF containers one after another."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 12] != b"WEBP":
            raise ValueError("no WebP container")
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        yield data[at:end]
        at = end + (end & 1)


def decode(data: bytes) -> np.ndarray:
    """Pixels of one lossless WebP image: height x width x 4 samples (red, green, blue, alpha)."""
    at, end = 12, 8 + int.from_bytes(data[4:8], "little")
    while at + 8 <= end:
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        if data[at : at + 4] == b"VP8L":
            p = _decode_stream(data[at + 8 : at + 8 + size])
            return np.stack([(p >> np.uint32(s)).astype(np.uint8) for s in (16, 8, 0, 24)], -1)
        at += 8 + size + (size & 1)
    raise ValueError("no lossless image in the container")


# --- encoder ----------------------------------------------------------------------------------------------------


class Writer:
    """Bits, lowest first."""

    def __init__(self):
        self.values: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.few: list[tuple[int, int]] = []

    def put(self, value: int, n: int) -> None:
        if n:
            self.few.append((value, n))

    def many(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self._flush()
        self.values.append(values)
        self.sizes.append(sizes)

    def _flush(self) -> None:
        if self.few:
            v, n = zip(*self.few, strict=True)
            self.values.append(np.array(v, np.int64))
            self.sizes.append(np.array(n, np.int64))
            self.few = []

    def bytes(self) -> bytes:
        self._flush()
        values, sizes = np.concatenate(self.values), np.concatenate(self.sizes)
        ends = sizes.cumsum()
        # Each value falls into one 32-bit word or runs over into the next; all values are below 2 ** 31.
        start = ends - sizes
        word, shift = start >> 5, (start & 31).astype(np.uint64)
        both = values.astype(np.uint64) << shift
        n = int(ends[-1] + 31 >> 5) + 1
        out = np.zeros(n + 1, np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sums = np.add.reduceat(both, first)
        out[word[first]] += sums
        out[1:] += out[:-1] >> np.uint64(32)
        return (out & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()[: int(ends[-1] + 7 >> 3)]


def _write_lone(w: Writer, symbol: int) -> None:
    """The code of one symbol."""
    w.put(1, 1)
    w.put(0, 1)
    w.put(int(symbol > 1), 1)
    w.put(symbol, 8 if symbol > 1 else 1)


def _write_prefix(w: Writer, lengths: np.ndarray) -> None:
    used = np.flatnonzero(lengths)
    if len(used) <= 1 and (not len(used) or used[0] < 256):
        _write_lone(w, int(used[0]) if len(used) else 0)
        return
    w.put(0, 1)
    top = int(used[-1]) + 1
    tokens: list[tuple[int, int, int]] = []
    at, values = 0, lengths[:top].tolist()
    while at < top:
        run = 1
        while at + run < top and values[at + run] == values[at]:
            run += 1
        if values[at] == 0 and run >= 3:
            run = min(run, 138)
            tokens.append((17, run - 3, 3) if run <= 10 else (18, run - 11, 7))
        else:
            run = 1
            tokens.append((values[at], 0, 0))
        at += run
    inner = code_lengths(np.bincount([t[0] for t in tokens], minlength=19), 7)
    if np.count_nonzero(inner) == 1:  # a lone code takes no bits when read
        codes, sizes = np.zeros(19, np.int64), np.zeros(19, np.int64)
    else:
        codes, sizes = canonical(inner), inner
    n = max(4, 1 + max(k for k in range(19) if inner[LENGTH_ORDER[k]]))
    w.put(n - 4, 4)
    for k in range(n):
        w.put(int(inner[LENGTH_ORDER[k]]), 3)
    if len(tokens) < 2 or top == len(lengths):
        w.put(0, 1)
        if top < len(lengths):
            raise ValueError("a code of one token is written in full")
    else:
        w.put(1, 1)
        size = max(1, (len(tokens) - 2).bit_length() + 1 >> 1)
        w.put(size - 1, 3)
        w.put(len(tokens) - 2, 2 * size)
    for s, extra, more in tokens:
        w.put(int(codes[s]), int(sizes[s]))
        w.put(extra, more)


def _prefix_of(value: int) -> tuple[int, int, int]:
    """(symbol, extra, bits) of a length or distance."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    n = v.bit_length() - 2
    return 2 * (n + 1) + (v >> n & 1), v & ((1 << n) - 1), n


def _line_copies(data: bytes) -> list[tuple[int, int, int]]:
    """(at, length, distance) of lines that have occurred before."""
    seen: dict[bytes, int] = {}
    out, at = [], 0
    for line in data.split(b"\n"):
        size = len(line) + 1
        if len(line) >= _MATCH and at + size <= len(data):
            first = seen.setdefault(line, at)
            if first != at:
                for lo in range(0, size, 4096):
                    out.append((at + lo, min(4096, size - lo), at - first))
        at += size
    return out


def _write_single(w: Writer, green: bytes, red: int, blue: int, alpha: int, copies: list[tuple[int, int, int]]) -> None:
    """An entropy-coded image of which only green varies, with back-references."""
    data = np.frombuffer(green, np.uint8)
    keep = np.ones(len(data), bool)
    for at, n, _ in copies:
        keep[at : at + n] = False
    lengths, distances = [_prefix_of(n) for _, n, _ in copies], [_prefix_of(d + 120) for _, _, d in copies]
    counts = np.bincount(data[keep], minlength=280)
    for s, _, _ in lengths:
        counts[256 + s] += 1
    if np.count_nonzero(counts) == 1 and copies:
        counts[0] += 1
    g = code_lengths(counts, GREEN_BITS)
    d = code_lengths(np.bincount([s for s, _, _ in distances], minlength=40)) if copies else None
    _write_prefix(w, g)
    for s in (red, blue, alpha):
        _write_lone(w, s)
    if copies:
        _write_prefix(w, d)
    else:
        _write_lone(w, 0)
    if np.count_nonzero(g) == 1:
        return
    codes = canonical(g)
    if not copies:
        w.many(codes[data], g[data])
        return
    dc, dn = (canonical(d), d) if np.count_nonzero(d) > 1 else (np.zeros(40, np.int64), np.zeros(40, np.int64))
    last = 0
    for (at, n, _), (s, extra, more), (ds, dextra, dmore) in zip(copies, lengths, distances, strict=True):
        part = data[last:at]
        if len(part):
            w.many(codes[part], g[part])
        w.put(int(codes[256 + s]), int(g[256 + s]))
        w.put(extra, more)
        w.put(int(dc[ds]), int(dn[ds]))
        w.put(dextra, dmore)
        last = at + n
    if last < len(data):
        w.many(codes[data[last:]], g[data[last:]])


def _contained(w: Writer) -> bytes:
    stream = w.bytes()
    stream += bytes(len(stream) & 1)
    return b"RIFF" + (12 + len(stream)).to_bytes(4, "little") + b"WEBPVP8L" + len(stream).to_bytes(4, "little") + stream


def _header(width: int, height: int) -> Writer:
    w = Writer()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3)):
        w.put(value, n)
    return w


def encode_grey(data: bytes, width: int = ROW) -> bytes:
    """One lossless WebP image whose grey pixels are the bytes."""
    height = len(data) // width
    w = _header(width, height)
    values = np.flatnonzero(np.bincount(np.frombuffer(data, np.uint8), minlength=256))
    if len(values) <= 16:
        pack = 3 if len(values) <= 2 else 2 if len(values) <= 4 else 1
        w.put(1, 1)
        w.put(PALETTE, 2)
        w.put(len(values) - 1, 8)
        steps = np.diff(values, prepend=0)
        w.put(0, 1)
        grey = code_lengths(np.bincount(steps, minlength=280))
        alpha = code_lengths(np.bincount([255] + [0] * (len(values) - 1), minlength=256))
        for code in (grey, grey[:256], grey[:256], alpha, np.zeros(40, np.int64)):
            _write_prefix(w, code)
        gc, gn = (canonical(grey), grey) if np.count_nonzero(grey) > 1 else (grey * 0, grey * 0)
        ac, an = (canonical(alpha), alpha) if np.count_nonzero(alpha) > 1 else (alpha * 0, alpha * 0)
        for k, s in enumerate(steps.tolist()):
            for _ in range(3):
                w.put(int(gc[s]), int(gn[s]))
            a = 0 if k else 255
            w.put(int(ac[a]), int(an[a]))
        index = np.searchsorted(values, np.frombuffer(data, np.uint8)).reshape(height, width)
        across = (width + (1 << pack) - 1) >> pack
        index = np.pad(index, ((0, 0), (0, (across << pack) - width))).reshape(height, across, 1 << pack)
        green = (index << ((8 >> pack) * np.arange(1 << pack))).sum(-1).astype(np.uint8).tobytes()
        w.put(0, 1)
        w.put(0, 1)
        w.put(0, 1)
        _write_single(w, green, 0, 0, 255, [])
        return _contained(w)
    mode, green, copies = _chosen(data, width)
    if mode:
        w.put(1, 1)
        w.put(PREDICTOR, 2)
        w.put(TILE - 2, 3)
        w.put(0, 1)
        for symbol in (mode, 0, 0, 255, 0):
            _write_lone(w, symbol)
    w.put(1, 1)
    w.put(SUBTRACT_GREEN, 2)
    w.put(0, 1)
    w.put(0, 1)
    w.put(0, 1)
    _write_single(w, green, 0, 0, 0 if mode else 255, copies)
    return _contained(w)


def _chosen(data: bytes, width: int) -> tuple[int, bytes, list[tuple[int, int, int]]]:
    """(predictor mode or 0, green samples, back-references): of plain samples with copied lines, and of the differences
    from the pixel to the left or above, what takes the fewest bits by the entropies."""
    plain, copies = np.frombuffer(data, np.uint8), _line_copies(data)
    n = np.stack([np.bincount(x, minlength=256) for x in (plain, plain[1:] - plain[:-1], plain[width:] - plain[:-width])]).astype(np.float64)
    total = np.maximum(n.sum(1), 1)
    bits = total * np.log2(total) - (n * np.log2(np.maximum(n, 1))).sum(1)
    bits[1:] += 100
    # What the third way says of the first row is that of the second.
    bits[2] += bits[1] * width / len(data)
    if copies:
        bits[0] = bits[0] * (1 - sum(n for _, n, _ in copies) / len(data)) + 30 * len(copies)
    mode = int(bits.argmin())
    if not mode:
        return 0, data, copies
    # The first row is predicted from the left, the first column from above, whatever the mode.
    rows = plain.reshape(-1, width)
    off = np.empty_like(rows)
    off[0, 0], off[0, 1:], off[1:, 0] = rows[0, 0], rows[0, 1:] - rows[0, :-1], rows[1:, 0] - rows[:-1, 0]
    off[1:, 1:] = rows[1:, 1:] - (rows[1:, :-1] if mode == 1 else rows[:-1, 1:])
    return mode, off.tobytes(), []


def _write_image(w: Writer, argb: np.ndarray, cache_bits: int, top: bool) -> None:
    """An entropy-coded image of literals and, with a cache, of cache codes."""
    w.put(int(cache_bits > 0), 1)
    if cache_bits:
        w.put(cache_bits, 4)
    if top:
        w.put(0, 1)
    pixels, cache, symbols = argb.ravel().tolist(), {}, []
    for p in pixels:
        k = (0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
        symbols.append(280 + k if cache_bits and cache.get(k) == p else p >> 8 & 255)
        cache[k] = p
    literal = [p for p, s in zip(pixels, symbols, strict=True) if s < 256]
    codes = [code_lengths(np.bincount(symbols, minlength=280 + (1 << cache_bits if cache_bits else 0)))]
    codes += [code_lengths(np.bincount([p >> s & 255 for p in literal], minlength=256)) for s in (16, 0, 24)]
    if np.count_nonzero(codes[0]) == 1 and not literal:
        raise ValueError("nothing to write")
    for code in (*codes, np.zeros(40, np.int64)):
        _write_prefix(w, code)
    tables = [(canonical(c).tolist(), c.tolist()) if np.count_nonzero(c) > 1 else ([0] * len(c), [0] * len(c)) for c in codes]
    for p, s in zip(pixels, symbols, strict=True):
        w.put(tables[0][0][s], tables[0][1][s])
        if s < 256:
            for (c, n), shift in zip(tables[1:], (16, 0, 24), strict=True):
                w.put(c[p >> shift & 255], n[p >> shift & 255])


def encode_pixels(pixels: np.ndarray, *, modes: np.ndarray | None = None, cross: np.ndarray | None = None, subtract_green: bool = False, cache_bits: int = 0, shift: int = 2) -> bytes:
    """One lossless WebP image of height x width x 4 samples (red, green, blue, alpha) through the named transforms.

    modes: a predictor mode for each block of 2 ** shift pixels; cross: an element (ARGB number) for each block.
    """
    h, w_ = pixels.shape[:2]
    argb = _argb(pixels[..., [3, 0, 1, 2]].astype(np.int16))
    w = _header(w_, h)
    if modes is not None:
        w.put(1, 1)
        w.put(PREDICTOR, 2)
        w.put(shift - 2, 3)
        _write_image(w, modes.astype(np.uint32) << np.uint32(8) | np.uint32(0xFF000000), 0, False)
        p = _channels(argb)
        first = np.zeros_like(p[0, 0])
        first[0] = 255
        out = p.copy()
        for y in range(h):
            for x in range(w_):
                mode = _mode_at(y, x, modes, shift)
                guess = first if not y and not x else p[0, x - 1] if not y else p[y - 1, 0] if not x else predict(mode, *_neighbours(p, y, x))
                out[y, x] = (p[y, x] - guess) & 255
        argb = _argb(out)
    if cross is not None:
        w.put(1, 1)
        w.put(CROSS_COLOUR, 2)
        w.put(shift - 2, 3)
        _write_image(w, cross, 0, False)
        argb = _cross(argb, cross, shift, -1)
    if subtract_green:
        w.put(1, 1)
        w.put(SUBTRACT_GREEN, 2)
        p = _channels(argb)
        p[..., 1] -= p[..., 2]
        p[..., 3] -= p[..., 2]
        argb = _argb(p)
    w.put(0, 1)
    _write_image(w, argb, cache_bits, True)
    return _contained(w)


# --- columns ----------------------------------------------------------------------------------------------------


def padded(text: bytes) -> bytes:
    """The text with bytes PAD up to a positive multiple of ROW."""
    return text + bytes([PAD]) * (ROW - len(text) if not text else -len(text) % ROW)


def store(payload: bytes) -> bytes:
    """The payload as grey images."""
    step = ROW * MAX_ROWS
    return b"".join(encode_grey(payload[at : at + step]) for at in range(0, len(payload), step))


def samples(media: bytes) -> np.ndarray:
    """The stored samples, read back: the pixels of all images, one channel of grey."""
    return np.concatenate([decode(c)[..., 1].ravel() for c in containers(media)])


def feature_of(pixels: np.ndarray) -> str:
    """Sixteen hex digits: of 64 equal parts of the samples, which are above the median of their means."""
    edges = np.linspace(0, len(pixels), 65).astype(np.int64)
    means = np.add.reduceat(pixels.astype(np.int64), edges[:-1]) / np.diff(edges)
    bits = means > np.median(means)
    return np.packbits(bits).tobytes().hex()


def with_media(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with the column media: the text's bytes, padded, as lossless images. A null text is empty."""
    names = docs.columns
    if unused(names, "media") != "media":
        raise ValueError("the table has a column media")
    schema = docs.select("*", F.lit(b"").alias("media")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 500):
                batch = whole.slice(lo, 500)
                media = [store(padded(t)) for t in _texts(batch.column(names.index(text)))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(media, pa.binary())], names=[*names, "media"])

    return docs.mapInArrow(run, schema)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = byte_columns(column)
    data = data.tobytes()
    return (data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def with_pixels(media: DataFrame, *, column: str = "media") -> DataFrame:
    """media with the column pixels: each image's decoded samples, red, green, blue and alpha by turns, rows first."""
    names = media.columns
    if unused(names, "pixels") != "pixels":
        raise ValueError("the table has a column pixels")
    schema = media.select("*", F.lit(b"").alias("pixels")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 100):
                batch = whole.slice(lo, 100)
                pixels = [None if m is None else b"".join(decode(c).tobytes() for c in containers(m)) for m in batch.column(names.index(column)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pixels, pa.binary())], names=[*names, "pixels"])

    return media.mapInArrow(run, schema)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its text stored as media, and what is read back from the stored bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 500):
                batch = whole.slice(lo, 500)
                rows = []
                for text in _texts(batch.column(1)):
                    media = store(padded(text))
                    pixels = samples(media)
                    payload = pixels.tobytes()
                    rows.append((len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(pixels)))
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[x.split()[0] for x in DIGEST.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, DIGEST)
