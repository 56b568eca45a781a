"""Hard negatives, collocations and main texts against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwork.llm import blocks, collocation, extraction, hardneg, mincut, scan

VECTORS = "vec_id long, embedding array<double>, label int"

# --- hard negatives ---------------------------------------------------------------------------------------------


def hard_negatives_plainly(rows):
    """rows: (id, vector, label), all of them fit to take part."""
    c = [(i, [int(np.floor(256.0 * v)) for v in x], y) for i, x, y in rows]
    score = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    out = []
    for a, x, y in {(i, tuple(x), y) for i, x, y in c if i % 50 == 0}:
        others = sorted((-score(x, v), i, z) for i, v, z in c if i != a)
        for n, (s, p, _) in enumerate([o for o in others if o[2] == y][:5], 1):
            found = [(i, -t) for t, i, z in others if z != y and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, r, i, -s, t, n) for r, (i, t) in enumerate(found, 1)]
    return sorted(out)


def shown(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")) for r in df.collect())


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    return [(i, [float(v) for v in centres[i % 12] + 0.3 * rng.normal(size=d)], int(rng.integers(0, 4))) for i in range(n)]


def test_hard_negatives_are_those_of_a_plain_search(spark, monkeypatch):
    rows = clustered(700, 8, 1) + [(701, [0.0] * 8, 1), (750, [0.0] * 8, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    want = hard_negatives_plainly(rows)
    assert len(want) > 100
    assert shown(hardneg.hard_negatives(df)) == want
    monkeypatch.setattr(hardneg, "TILE", 16)
    monkeypatch.setattr(hardneg, "CELLS", 64)
    assert shown(hardneg.hard_negatives(df.repartition(5))) == want
    # Blocks of a few anchors each give the same.
    found = scan.in_place
    monkeypatch.setattr(hardneg, "in_place", lambda *a, **k: found(*a, **k, block_bytes=500))
    assert shown(hardneg.hard_negatives(df)) == want


def test_bounds_hold_every_score_and_let_tiles_be_skipped():
    rng = np.random.default_rng(4)
    centres = 40 * rng.normal(size=(6, 16))
    x = np.floor(np.repeat(centres, 64, 0) + 3 * rng.normal(size=(384, 16))).astype(np.int64)
    refs = hardneg.references(x.astype(float))
    norms, to = hardneg.angles(x, refs)
    edges = np.arange(0, 384, 64)
    low, high = np.minimum.reduceat(to, edges), np.maximum.reduceat(to, edges)
    least, most = hardneg.score_bounds(low, high, np.minimum.reduceat(norms, edges), np.maximum.reduceat(norms, edges), to, norms)
    scores = hardneg.products(x, x).reshape(6, 64, 384)
    assert (scores.min(1) >= least).all() and (scores.max(1) <= most).all()
    own = scores.max(1).max(0)
    assert (most < 0.9 * own).mean() > 0.5  # most tiles can't have an anchor's best row


def test_products_are_exact_beyond_doubles():
    x = np.array([[(1 << 30) + 1, 3], [1 << 40, 1 << 40]], np.int64)
    assert hardneg.products(x[:1], x[:1])[0, 0] == ((1 << 30) + 1) ** 2 + 9
    assert hardneg.products(x[1:], x[1:])[0, 0] == (1 << 63) - 1


def test_hard_negatives_of_odd_rows(spark):
    base = clustered(120, 4, 2)
    odd = [(None, [1.0] * 4, 1), (200, None, 1), (201, [1.0, None, 1.0, 1.0], 1), (202, [float("nan")] * 4, 1), (203, [1.0] * 4, None), (204, [1.0] * 3, 1), (205, [], 1), (206, [float("inf")] * 4, 1)]
    twice = [base[0], base[3], (50, base[7][1], 2), (130, [1e30, -1e30, 0.0, 0.0], 1)]
    df = spark.createDataFrame(base + odd + twice, VECTORS).withColumns({"ID": F.lit("x"), "score": F.lit(1), "near": F.lit(2), "low": F.lit(0)})
    fine = [r for r in base + twice if r[0] != 130]
    got = shown(hardneg.hard_negatives(df.where("vec_id is null or vec_id <> 130")))
    assert got == hard_negatives_plainly(fine)
    assert hardneg.hard_negatives(df).count() > 0 and hardneg.hard_negatives(df.limit(0)).count() == 0
    assert hardneg.hard_negatives(df.where("vec_id = 50").limit(1)).count() == 0


# --- collocations -----------------------------------------------------------------------------------------------


def collocations_plainly(docs, support, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            low = low.replace(c, "\n")
        for piece in low.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def some_texts(n, seed):
    rng = random.Random(seed)
    words = ["a", "The", "the", "über", "x1", "naïve", "of", "\x00", "“quoted”", "e"]
    join = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ", "\r\n", " "]
    return [(rng.choice(["en", "en", "de", None]), "".join(rng.choices(words, range(10, 0, -1))[0] + rng.choice(join) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_collocations_are_those_of_a_plain_count(spark, shards, monkeypatch):
    docs = [*some_texts(200, shards), ("en", None), (None, ""), ("de", " .,; "), ("en", "one two three four " * 400)]
    monkeypatch.setattr(collocation, "CHUNK", 700)
    monkeypatch.setattr(collocation, "HELD", 300)
    df = spark.createDataFrame(docs, "lang string, text string").withColumns({"KEY": F.lit(1), "shard": F.lit("s"), "n": F.lit(0)}).repartition(6)
    for support in (7, 30):
        got = sorted(tuple(r) for r in collocation.collocations(df, support=support, shards=shards, top=40).collect())
        assert got == collocations_plainly(docs, support, 40)
    assert collocation.collocations(df.limit(0)).count() == 0


def test_long_texts_are_cut_between_pieces():
    text = b"alpha beta, gamma " * 50 + b"x" * 300 + b" end"
    parts = [p for p in collocation.chunks(text, np.array([0, len(text)]), limit=100) if p]
    assert b"".join(parts) == text and len(parts) > 5 and all(p.endswith(b",") for p in parts[:-1])


def test_a_full_bitmap_lets_phrases_pass_and_holds_none_back(spark, monkeypatch):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    held = np.array([r.key for r in keys.collect()]).astype(np.uint64)
    for most in (28, 20):
        monkeypatch.setattr(collocation, "LEAST_BITS", 20)
        monkeypatch.setattr(collocation, "MOST_BITS", most)
        bitmap = np.frombuffer(collocation.bitmap_of(keys), np.uint8)
        assert collocation.allowed(bitmap, held).all()
    others = np.random.default_rng(0).integers(0, 1 << 63, 20000).astype(np.uint64)
    assert collocation.allowed(bitmap, others).mean() < 0.01


# --- main texts -------------------------------------------------------------------------------------------------


def test_least_cuts_are_those_of_all_labellings():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randint(1, 7)
        terminals = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 5)) for _ in range(rng.randint(0, 12))]
        cost = lambda x: sum(t if t > 0 and not y else -t if t < 0 and y else 0 for t, y in zip(terminals, x, strict=True)) + sum(w for a, b, w in edges if x[a] != x[b])  # noqa: B023, E731
        got = mincut.labels(terminals, edges)
        assert (cost(got), sum(got)) == min((cost(x), sum(x)) for x in itertools.product([False, True], repeat=n))


P = "The committee met on Tuesday to discuss the plans for the new bridge, which has been delayed twice. Members said that the budget was not yet final."
Q = "Work is expected to begin in the spring, once the permits are in place and the contractor has been chosen by the council."
PAGES = {
    f'<html><body class="has-sidebar"><div id="top"><a href="/">Home</a> | <a href="/a">News</a></div><div class="wrap"><div class="post-content"><h1>Bridge delayed</h1><p>{P}</p><p>{Q}</p></div><div class="sidebar"><h3>Popular</h3><ul><li><a href=1>One story</a><li><a href=2>Another story</a></ul></div></div><div id="footer">Copyright 2020. All rights reserved.</div></body></html>': f"Bridge delayed {P} {Q}",
    f'<body><div><a href="/">Home</a> <a href="/a">News</a> <a href="/b">Sport</a></div><div><h2>Bridge delayed</h2><div>{P}</div><div>{Q}</div></div><div><a href=x>Imprint</a> <a href=y>Contact</a></div></body>': f"Bridge delayed {P} {Q}",
    f'<main><article><header><h1>Bridge</h1></header><p>{P}</p><aside class="ad"><p>Buy the best shoes now, half the price.</p></aside><p>{Q}</p><section id="comments"><h2>3 Comments</h2><article class="comment"><p>{P} I do not agree at all.</p></article></section></article></main><footer><p>{Q}</p></footer>': f"Bridge {P} {Q}",
    f"<table><tr><td><a href=1>a</a><br><a href=2>b</a></td><td><p>{P}</p><p>{Q}</p></td></tr></table>": f"{P} {Q}",
    f'<div class="cookie-notice"><p>We use cookies to improve your visit, and to show you adverts. Please accept.</p><button>Accept</button></div><div role="main"><h1>Title</h1><p>{P}</p><ul><li>first point, with text.</li><li>second point</li></ul><p>{Q}</p></div><form><label>Name</label><input></form>': f"Title {P} first point, with text. second point {Q}",
    f'<div class="content"><h1>T one</h1><p>{P}</p><p>{Q}</p><div><h3>Comments</h3><p>I think that the bridge is fine as it is, and that we need no other one.</p></div></div>': f"T one {P} {Q}",
    f"<nav><a href=1>x</a></nav><article><p>{P}<p>{Q} &am": f"{P} {Q} &am",
    f'<header class="site-header"><h1>The Daily</h1><p>News since 1900, every day, for you.</p></header><div class="story"><header class="entry-header"><h1>Bridge delayed</h1></header><p>{P}</p></div>': f"Bridge delayed {P}",
    f"<article><!-- <p>no</p> --><script>var a='<p>{Q}</p>'</script><p>A&nbsp; &amp;amp; b<b>old</b>\n\t&lt;c&gt;<br>d</p><p hidden>{Q}</p></article>": "A &amp; bold <c> d",
    f'<article><p>{P}</p><p title="a > b" class=\'x\'>{Q}</p></article><p>': f"{P} {Q}",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_texts_of_pages_of_many_makes(page):
    assert extraction.main_text(page) == PAGES[page]


def test_broken_and_deep_pages_are_read():
    for page in ("<", "<p", "<a href='x", "</", "<!--", "<!", "<p>" * 3000, "<div>" * 3000 + P, "</div>" * 50 + P, "<script>" + P, "<p " + "'" * 500):
        extraction.main_text(page)
    many = "<article>" + f"<p>{P}</p>" * 3000 + "</article>"
    assert extraction.main_text(many) == " ".join([P] * 3000)
    assert [b.text for b in blocks.read("a<p>b<div>c</div>d<ul><li>e<li>f</ul>g").blocks] == list("abcdefg")


def test_the_classifier_learns_from_plain_markup(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = extraction.learn(pages)
    assert weights.shape == extraction.GIVEN.shape and not np.array_equal(weights, extraction.GIVEN)
    assert np.array_equal(extraction.learn(pages.limit(0)), extraction.GIVEN)
    # Learned weights call prose content and menus not, without any markup.
    prose, menu = (np.dot(weights, extraction.shape(t, linked)) for t, linked in ((P, 0), ("Home", 4)))
    assert prose > 0 > menu


def test_main_texts_of_the_pages(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in extraction.extracted(pages.withColumn("TEXT", F.lit(1))).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<b>", "").replace("</b>", "").replace("<br>", " ")
        want = " ".join(" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:h1|p)>", inner) if x.strip())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_odd_rows_of_pages(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p></p>"), (3, "v", f"<article>{P}</article>"), (3, "v", f"<article>{P}</article>")]
    out = extraction.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in out) == sorted([("1", "", 0), ("None", "", 0), ("2", "", 0), ("3", P, len(P)), ("3", P, len(P))])
