"""The pass that gives phrases their words: each about once, whatever the number of tasks, and none lost if partitions change."""

import random

from siltwork.llm import collocation


def corpus(rng, n):
    words = [f"w{k}" for k in range(12)]
    return [(rng.choice(["aa", "bb", None]), " ".join(rng.choice(words) for _ in range(30)) + rng.choice([".", ", Ab w1 W2", "\n"])) for _ in range(n)]


def brute(docs, support):
    from collections import Counter

    f, total = Counter(), Counter()
    for lang, text in docs:
        for piece in collocation._BREAK.split(text.lower().encode()):
            w = piece.decode().split()
            total[lang or "und", "", 0] += len(w)
            f.update((lang or "und", " ".join(w[i : i + k]), k) for k in range(1, 5) for i in range(len(w) - k + 1))
    return {k: n for k, n in f.items() if n >= support} | dict(total)


def test_a_phrase_is_named_about_once(spark, monkeypatch):
    docs = corpus(random.Random(5), 2000)
    rows, written, store = spark.createDataFrame(docs, "lang string, text string").repartition(12), [], collocation.stored

    def stored(df, **more):
        out = store(df, **more)
        if "phrase" in out.columns and "key" in out.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(collocation, "stored", stored)
    want = brute(docs, 30)
    got = {(r.lang, r.phrase, r.words): r.f for r in collocation.phrase_counts(rows).collect()}
    assert got == dict(want)
    assert len(want) > 400
    # Each phrase, and 12 tasks' sums of all words of a language; 12 tasks wrote nearly all of them each before.
    assert written and written[0] < 1.1 * len(want) + 12 * 3


def test_phrases_whose_task_changed_are_named_by_any(spark, monkeypatch):
    docs = corpus(random.Random(6), 400)
    rows = spark.createDataFrame(docs, "lang string, text string").repartition(6)
    monkeypatch.setattr(collocation, "_TASK_BITS", 1)
    assert {(r.lang, r.phrase, r.words): r.f for r in collocation.phrase_counts(rows).collect()} == brute(docs, 30)
