"""Personal data by candidate gradient boosting.

Strict rules find the base spans of four kinds (e-mail, IP address, card, phone); they always stay. In the text
between them, high-recall generators propose spans that the rules miss: spelled-out or spaced-out addresses, and of a
run of numbers every sequence of its groups that has a fitting count of digits. Proposals may overlap one another.
Boosted trees score each by its format (length, digits, separators, checksum, sizes of groups) and its context
(neighbouring characters, numbers right before and after, distance to words that tell of a kind or of something
else); isotonic calibration turns margins into probabilities, and each kind's threshold is the lowest at which
proposals in held-out documents are right often enough. Of overlapping spans the likeliest stays.

The trees learn without labels, from examples whose class is known by how they were made. Right: a base span of the
corpus, or a made-up one, rewritten in place in one of the ways that people write (other separators, a spelled-out
at). Wrong: every proposal that cuts such a span or runs over it, a rewriting with a broken checksum, range or length,
or one glued to letters or signs; look-alikes (dates, versions, sums, ISBNs, tables of numbers) in the same places.
Bare numbers, which may be either, are right after a word of their kind, wrong after another or none. All that the
generators propose in the corpus itself counts as wrong with half a weight, whatever stands near. A document's
examples are either learned from or held out, all of them.

Spans are in code points, end exclusive. A null text is empty and has none. Repeated rows get a row each, a null key
a row with a null key; an empty table gives no rows. Only the key and the text are read to find spans; to redact, all
columns are kept, whatever their names. Time is in proportion to a text's length and the proposals in it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.llm.boosting import BoostedTrees, Isotonic

KINDS = ("email", "ip", "card", "phone")
#: Documents that the trees learn from at most, drawn by a hash among those with a digit or an at sign; parts of one document, drawn likewise; made-up spans of each kind beside them.
TRAIN_DOCS, PARTS, MADE_UP = 2000, 20, 200
#: Ways of writing each span that one example span is rewritten in.
WAYS = 3
#: Share of right proposals that a kind's threshold must reach on held-out ones, and the least threshold.
PRECISION, LEAST_THRESHOLD = 0.98, 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: What the generators look for.
_AT = re.compile(r"@|[\[({]\s?at\s?[\])}]|(?<=\w) at (?=[\w-]{1,63}\s?(?:dot|[\[(]dot[\])])\s?)|(?<=\w) at (?=[\w-]{1,63} dot )", re.I)
_AROUND = re.compile(r"\s?[\w-]{1,63}(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?| dot )[\w-]{1,63}){0,8}", re.I)
_RUN = re.compile(r"[0-9][0-9 ().\-/_]{5,}(?<=[0-9])")
_BETWEEN = r"(?:\s?[.,]\s?|\s?[\[(]\s?(?:\.|dot)\s?[\])]\s?| dot )"
_QUAD = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_BETWEEN}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)

#: Words that tell of a kind.
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "courriel", "correo", "schreib", "write"),
    "ip": ("ip", "host", "server", "address", "addr", "adresse", "dirección", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "téléphone", "teléfono"),
}
#: Words that tell of another number.
OTHERS = ("order", "invoice", "isbn", "version", "page", "total", "sum", "date", "since", "token", "id", "ref", "nr", "no.", "room", "€", "$", "%")
#: Code points of context on either side.
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the address pattern, found from their at signs."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        if at > free and text[at - 1] in _LOCAL and (m := _DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            free = m.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def base_ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]


def base_cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def base_phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Base spans of each kind."""
    digits = _DIGITS.search(text) is not None
    return [base_emails(text) if "@" in text else [], base_ips(text) if digits else [], base_cards(text) if digits else [], base_phones(text) if "+" in text else []]


def joined_spans(spans: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Disjoint spans, in order, that cover all of them."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(s for of in spans for s in of):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def proposals(text: str, taken: list[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all outside the taken spans (disjoint, in order) that may be personal data; overlaps are welcome."""
    out: list[tuple[int, int, int]] = []
    edges = [0, *(x for span in taken for x in span), len(text)]
    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        if hi - lo < 6:
            continue
        for m in _AT.finditer(text, lo, hi):
            left = m.start() - (m.start() > lo and text[m.start() - 1] == " ")
            start = left
            while True:
                while start > lo and text[start - 1] in _LOCAL and left - start < 64:
                    start -= 1
                if start - 5 > lo and left - start < 64 and text[start - 5 : start].lower() == " dot ":
                    start -= 5
                else:
                    break
            after = _AROUND.match(text, m.end(), hi)
            if start < left and after:
                out.append((0, start, after.end()))
        if not _DIGITS.search(text, lo, hi):
            continue
        out += [(1, *m.span()) for m in _QUAD.finditer(text, lo, hi)]
        for m in _RUN.finditer(text, lo, hi):
            groups = [g.span() for g in _DIGITS.finditer(text, *m.span())]
            for i, (a, _) in enumerate(groups):
                start, digits = a - (a > lo and text[a - 1] in "(+"), 0
                for j in range(i, len(groups)):
                    digits += groups[j][1] - groups[j][0]
                    if digits > 19 or (j > i and groups[j][0] - groups[j - 1][1] > 3):
                        break
                    if 7 <= digits <= 15:
                        out.append((3, start, groups[j][1]))
                    if digits >= 13:
                        out.append((2, start, groups[j][1]))
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of one proposal."""
    span, left, right = text[start:end], text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    low, digits = span.lower(), _NOT_DIGIT.sub("", span)
    parts = _DIGITS.findall(span)
    groups = [len(x) for x in parts]
    before, after = left[-1:] or " ", right[:1] or " "
    last = re.split(r"[^a-z]+", low)[-1] if kind == 0 else ""
    near = [max((left.rfind(w) + len(w) for w in words if w in left), default=-1) for words in (*CUES.values(), OTHERS)]
    return [
        kind, len(span), len(digits), len(digits) / max(len(span), 1), len(set(digits)), len(groups), max(groups, default=0), min(groups, default=0), float(len(set(groups)) == 1), groups[0] if groups else 0, groups[-1] if groups else 0,
        span.count(" "), span.count("-"), span.count("."), span.count("/"), span.count(",") + span.count("_"), span.count("(") + span.count("["), float(span[:1] == "+"), float(span[:2] == "00"), float(span[:1] == "0"), float(span[:2] in ("19", "20")), float(span[:1] == "("),
        float("@" in span), float("@ " in span) - float(" @" in span), float("at" in low and "@" not in low), float("dot" in low), len(last), float(span.count(")") != span.count("(")),
        float(len(digits) >= 13 and luhn(digits)), float(len(parts) == 4 and max(int(x[:6]) for x in parts) <= 255), float("  " in span),
        float(before.isalnum()), float(after.isalnum()), float(before in "=\"'#$/.,-_:%"), float(after in "=\"'#$/%-_:€"), float(before in "#$€="), float(_DIGITS.search(left[-3:]) is not None), float(_DIGITS.search(right[:3]) is not None),
        *(float(len(left) - n if n >= 0 else 99) for n in near), float(len(left) - near[kind] if near[kind] >= 0 else 99),
    ]


def made_up(rng: np.random.Generator, kind: int) -> str:
    """A span of the kind in its base form."""
    n = [int(x) for x in rng.integers(0, 256, 4)]
    if kind == 0:
        word = lambda size: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, size))
        local = word(3 + n[0] % 8) + ("." + word(5) if n[0] % 3 == 0 else str(n[1]) if n[0] % 3 == 1 else "")
        return f"{local}@{word(3 + n[2] % 9)}{'.' + word(4) if n[2] % 5 == 0 else ''}.{('com', 'org', 'net', 'de', 'fr', 'es', 'io', 'example')[n[3] % 8]}"
    if kind == 1:
        return ".".join(map(str, n))
    if kind == 2:
        card = f"{('4', '51', '6011', '35')[n[0] % 4]}{rng.integers(10**15)}"[:15]
        return card + next(c for c in "0123456789" if luhn(card + c))
    return f"+{1 + n[0] % 60} ({200 + n[1]}) {rng.integers(200, 999)}-{rng.integers(1000, 9999)}"


def _again(rng: np.random.Generator, digits: str) -> str:
    """The digits with one changed."""
    at = int(rng.integers(len(digits)))
    return digits[:at] + str((int(digits[at]) + int(rng.integers(1, 9))) % 10) + digits[at + 1 :]


def _right(rng: np.random.Generator, kind: int, span: str) -> list[str]:
    """Other ways to write a base span, right wherever they stand."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == 0:
        local, _, domain = span.partition("@")
        words = local.replace(".", " dot ")
        return [f"{local} [at] {domain}", f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local} at {domain.replace('.', ' dot ')}", f"{words} at {domain.replace('.', ' dot ')}", f"{local}[at]{domain.replace('.', '[dot]')}", f"{local} @ {domain}", f"{local} (AT) {domain}", f"{local} AT {domain.replace('.', ' DOT ')}", f"{local}(at){domain}", f"{local} [at] {domain.replace('.', ' [dot] ')}"]
    if kind == 1:
        parts = span.split(".")
        return [x.join(parts) for x in ("[.]", "(.)", " . ", "[dot]", " dot ", " [.] ", "(dot)")]
    if kind == 2:
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        amex = f"3{'47'[int(rng.integers(2))]}{rng.integers(10**12):012d}"
        amex += next(c for c in "0123456789" if luhn(amex + c))
        return [*(x.join(four) for x in (".", "/", "  ", " - ", "_")), f"{amex[:4]} {amex[4:10]} {amex[10:]}", f"{amex[:4]}-{amex[4:10]}-{amex[10:]}", amex]
    ten = f"{rng.integers(200, 999)}{digits[-7:]}"
    a, b, c = ten[:3], ten[3:6], ten[6:]
    pairs = [ten[i : i + 2] for i in range(2, 10, 2)]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"00{rng.integers(1, 60)} {a} {b} {c}", f"1-{a}-{b}-{c}", f"0{ten[:1]} {' '.join(pairs)}", f"0{ten[:1]}.{'.'.join(pairs)}", f"0{ten[:2]} / {ten[2:8]}", f"00{rng.integers(1, 60)}-{a}-{b}-{c}", f"0{a}/{b}{c}", f"({a}){b}-{c}"]


def _bare(rng: np.random.Generator, kind: int, span: str) -> list[str]:
    """Numbers that are of the kind after a word of it, and may be anything elsewhere."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == 3:
        ten = f"{rng.integers(200, 999)}{digits[-7:]}"
        return [ten, f"{ten[3:6]}-{ten[6:]}", f"{ten[:5]} {ten[5:]}", f"0{ten}"]
    return []


def _wrong(rng: np.random.Generator, kind: int, span: str) -> list[str]:
    """What looks like a span of the kind and is none."""
    digits, n = _NOT_DIGIT.sub("", span), [int(x) for x in rng.integers(0, 10_000, 6)]
    if kind == 0:
        local, _, domain = span.partition("@")
        return [f"{local}@{domain.split('.')[0]}", f"{local} @ {n[0] % 99}", f"{local} @{domain.split('.')[0]}", f"{local} @ {domain.split('.')[0]}", f"{local} at {domain.split('.')[0]} dot", f"{local} (at) {domain.split('.')[0]}", f"{local} @ {n[0] % 90}.{n[1] % 99:02d}", f"{local} @{n[0] % 12}pm"]
    if kind == 1:
        parts = span.split(".")
        at = n[0] % 4
        broken = [*parts[:at], str(256 + n[1] % 700), *parts[at + 1 :]]
        return [", ".join(parts), ",".join(parts), " . ".join(broken), "[.]".join(broken), ". ".join(parts), f"{n[1] % 9}, {n[2] % 9}, {n[3] % 9}, {n[4] % 9}", " dot ".join(broken)]
    if kind == 2:
        other = _again(rng, digits)
        four = [other[i : i + 4] for i in range(0, len(other), 4)]
        return [other, *(x.join(four) for x in (".", "/", "  ", " ", "-", "_")), f"{digits[:3]} {digits[3:7]} {digits[7:12]} {digits[12:]}.{n[0] % 10}", f"978-{n[0] % 10}-{n[1] % 100:02d}-{rng.integers(10**6):06d}-{n[2] % 10}", " ".join(str(int(x)) for x in rng.integers(0, 4000, 8)), f"20{n[0] % 30:02d}-{1 + n[1] % 12:02d}-{1 + n[2] % 28:02d} {n[3] % 24:02d}.{n[4] % 60:02d}"]
    return [
        f"20{n[0] % 30:02d}-{1 + n[1] % 12:02d}-{1 + n[2] % 28:02d}", f"{1 + n[2] % 28:02d}.{1 + n[1] % 12:02d}.{1900 + n[0] % 130}", f"{1 + n[2] % 28}/{1 + n[1] % 12}/{1900 + n[0] % 130}", f"{1 + n[2] % 28:02d}.{1 + n[1] % 12:02d}.{1900 + n[0] % 130} {n[3] % 24:02d}.{n[4] % 60:02d}", f"{1900 + n[0] % 100}-{2000 + n[1] % 30}", f"{n[0] % 10}.{rng.integers(10**8):08d}", f"{n[0] % 900} {n[1] % 1000:03d} {n[2] % 1000:03d}",
        f"20{n[0] % 30:02d}{1 + n[1] % 12:02d}{1 + n[2] % 28:02d}{n[3] % 24:02d}{n[4] % 60:02d}00", f"978-{n[0] % 10}-{n[1] % 100:02d}-{rng.integers(10**6):06d}-{n[2] % 10}", f"{n[0] % 90}.{n[1]:04d} {n[2] % 90}.{n[3]:04d}", f"{100 + n[0] % 900}-{n[1] % 90 + 10}-{1000 + n[2] % 9000}", " ".join(str(int(x)) for x in rng.integers(0, 4000, 5)), f"{n[0] % 30}-{n[1] % 30} {n[2] % 30}-{n[3] % 30} {n[4] % 30}-{n[5] % 30}", f"{n[0]}.{n[1]}.{n[2] % 100}", f"{rng.integers(10**9, 10**13)}",
    ]


@dataclass
class Redactor:
    """Trees, calibration and a threshold for each kind; without trees, base spans only."""

    trees: BoostedTrees | None = None
    calibration: Isotonic | None = None
    thresholds: tuple[float, ...] = (1.1,) * len(KINDS)

    def spans(self, text: str) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
        """(base spans, all spans) of each kind."""
        base = base_spans(text)
        every = [list(x) for x in base]
        free = proposals(text, joined_spans(base)) if self.trees is not None else []
        if free:
            p = np.concatenate([self.calibration(self.trees.margin(np.array([features(text, *c) for c in free[lo : lo + 4096]]))) for lo in range(0, len(free), 4096)])
            starts, ends = [], []  # of the spans that stay, in order
            for q, (k, a, b) in sorted(zip(p.tolist(), free, strict=True), key=lambda c: (-c[0], c[1][1] - c[1][2], c[1])):
                if q >= self.thresholds[k]:
                    at = bisect(starts, a)
                    if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
                        starts.insert(at, a)
                        ends.insert(at, b)
                        every[k].append((a, b))
            every = [sorted(x) for x in every]
        return base, every


@dataclass(frozen=True)
class Part:
    """What learning looks at: a span of a document with its context; kind and place, and whether it is a base span."""

    document: int
    text: str
    kind: int
    start: int
    end: int
    base: bool


def parts_of(document: int, text: str, most: int = PARTS) -> list[Part]:
    """The base spans and proposals of a text, at most so many, drawn by a hash."""
    base = base_spans(text)
    found = [(k, a, b, True) for k, spans in enumerate(base) for a, b in spans] + [(k, a, b, False) for k, a, b in proposals(text, joined_spans(base))]
    found.sort(key=lambda c: zlib.crc32(b"%d %d %d %d" % (document, *c[:3])))
    return [Part(document, text[max(0, a - 2 * CONTEXT) : b + 2 * CONTEXT], k, a - max(0, a - 2 * CONTEXT), b - max(0, a - 2 * CONTEXT), known) for k, a, b, known in found[:most]]


def learn(parts: list[Part], *, made: int = MADE_UP, seed: int = 7) -> Redactor:
    """A redactor from parts of the corpus and made-up spans in their places."""
    rng = np.random.default_rng(seed)
    places = [(p.text[: p.start], p.text[p.end :]) for p in parts] or [("it is written here as ", " and nothing else")]
    x, y, weight, of = [], [], [], []

    def add(row: list[float], right: bool, document: int, w: float = 1.0) -> None:
        x.append(row)
        y.append(float(right))
        weight.append(w)
        of.append(document)

    def written(head: str, span: str, tail: str, kind: int, right: bool, document: int) -> None:
        """All that the generators propose of a span in its place: right is what covers just it."""
        text, a, b = head + span + tail, len(head), len(head) + len(span)
        for k, s, e in proposals(text):
            if s < b and a < e:
                add(features(text, k, s, e), right and (k, s, e) == (kind, a, b), document)

    def examples(head: str, span: str, tail: str, kind: int, document: int) -> None:
        some = lambda of: [of[i] for i in rng.permutation(len(of))[:WAYS]]
        cue, other = (f"{words[rng.integers(len(words))]}{'  : . '[2 * int(rng.integers(3)) :][:2].rstrip()} " for words in (CUES[KINDS[kind]], OTHERS[:-3]))
        ways = some(_right(rng, kind, span))
        for n, way in enumerate(ways):
            # One after a word of its kind; one in a list, after another span; the others as they are.
            beside = made_up(rng, int(rng.integers(len(KINDS))))
            beside = f"{beside if rng.integers(2) else some(_right(rng, kind, made_up(rng, kind)))[0]}{' ,;'[int(rng.integers(3))]} ".replace("  ", " ")
            written(head + (cue, beside, "")[n % 3], way, tail, kind, True, document)
        for way in some(_wrong(rng, kind, span)):
            written(head + other if rng.integers(3) == 0 else head, way, tail, kind, False, document)
        for way in some(_bare(rng, kind, span)):
            written(head + cue, way, tail, kind, True, document)
            written(head + (other if rng.integers(2) else ""), way, tail, kind, False, document)
        # Glued to something, even a right one is part of that.
        sign = ("x", "#", "=", "7f", "$", "/id")[rng.integers(6)]
        written(head + sign, ways[0] if kind else ways[0].split()[-1], ("b", "%", "c4", "-k")[rng.integers(4)] + tail, kind, False, document)

    for p in parts:
        if p.base:
            add(features(p.text, p.kind, p.start, p.end), True, p.document)
            examples(p.text[: p.start], p.text[p.start : p.end], p.text[p.end :], p.kind, p.document)
        else:
            add(features(p.text, p.kind, p.start, p.end), False, p.document, 0.5)
    for n in range(made * len(KINDS)):
        at = int(rng.integers(len(places)))
        examples(places[at][0], made_up(rng, n % len(KINDS)), places[at][1], n % len(KINDS), parts[at].document if parts else n)
    x, y, weight, of = np.array(x), np.array(y), np.array(weight), np.array(of)
    held = np.array([zlib.crc32(b"held %d" % d) % 3 == 0 for d in of.tolist()])
    if held.all() or not held.any():  # a single document: there is nothing else to hold out
        held = np.arange(len(y)) % 3 == 0
    trees = BoostedTrees(rounds=60, depth=4).fit(x[~held], y[~held], weight[~held])
    margin = trees.margin(x[held])
    calibration = Isotonic().fit(margin, y[held])
    p, thresholds = calibration(margin), []
    for k in range(len(KINDS)):
        mine = x[held][:, 0] == k
        steps = [t for t in np.unique(p[mine]) if t >= LEAST_THRESHOLD and y[held][mine & (p >= t)].mean() >= PRECISION]
        thresholds.append(float(min(steps, default=1.1)))
    return Redactor(trees, calibration, tuple(thresholds))


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> Redactor:
    """A redactor learned from at most ``train_docs`` documents and at most ``PARTS`` spans of each."""
    drawn = docs.where(F.col(text).rlike("[0-9@]")).select(F.xxhash64(F.lit("pii"), F.col(key), F.col(text)).alias("draw"), F.col(text).alias("text"))
    ids = drawn.select("draw").distinct().orderBy("draw").limit(train_docs)
    parts = drawn.join(F.broadcast(ids), "draw", "left_semi").mapInArrow(_parts, PART).distinct()
    return learn([Part(*r) for r in parts.orderBy("document", "start", "text", "kind", "end").toArrow().to_pandas().itertuples(index=False)])


PART = "document long, text string, kind int, start int, end int, base boolean"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(p.document, p.text, p.kind, p.start, p.end, p.base) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for p in parts_of(d, t)]
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in PART.split(", ")])


def _joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, found in zip(KINDS, spans, strict=True) for a, b in found)


def find(docs: DataFrame, redactor: Redactor, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, counts of base spans, their digest, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(redactor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                found = [model.spans(t or "") for t in batch.column(1).to_pylist()]
                counts = [pa.array([len(base[k]) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                digests = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                spans = pa.array([_joined(every) for _, every in found], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, spans], names=[key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    rows = docs.select(key, F.col(text).alias("text"))
    zero = [F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.mapInArrow(run, rows.select(key, *zero, F.lit("").alias("base_sha256"), F.lit("").alias("spans")).schema)


def redact(docs: DataFrame, redactor: Redactor, *, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with each span of text replaced by its kind in angle brackets; ``length``, if there, follows the new text.

    All rows and columns stay; a null text stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(redactor)

    def clean(t: str) -> str:
        found = sorted((a, b, KINDS[k]) for k, spans in enumerate(shared.value.spans(t)[1]) for a, b in spans)
        if not found:
            return t
        out, at = [], 0
        for a, b, kind in found:
            if a >= at:
                out += [t[at:a], f"<{kind.upper()}>"]
            at = max(at, b)
        return "".join([*out, t[at:]])

    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                texts = [None if t is None else clean(t) for t in batch.column(names.index(text)).to_pylist()]
                columns = list(batch.columns)
                columns[names.index(text)] = pa.array(texts, pa.string())
                if length in names:
                    old = columns[names.index(length)]
                    columns[names.index(length)] = pa.array([o if t is None else len(t) for o, t in zip(old.to_pylist(), texts, strict=True)], old.type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def personal_data(docs: DataFrame) -> DataFrame:
    return find(docs.select("doc_id", "text"), train(docs.select("doc_id", "text")))


def without_personal_data(docs: DataFrame) -> DataFrame:
    return redact(docs, train(docs.select("doc_id", "text")))
