"""Training windows of many texts at once: those that a plain loop over the words gives, in clearly less time."""

import random
import time

import numpy as np
import pyarrow as pa

from siltwork.llm import lblm


def plain_windows(texts, vocab, first, step):
    end, out = vocab.words[lblm.END], []
    known = {}
    for text in texts:
        ids = [end, end]
        for word in lblm.words_of(text or b""):
            if word not in known:
                known[word] = vocab.symbol(word)
            ids.append(known[word])
        ids.append(end)
        out += [ids[k : k + 3] for k in range(first, len(ids) - 2, step)]
    return np.array(out, np.int64).reshape(-1, 3)


def vocabulary(words, classes):
    n = len(words) + classes
    return lblm.Vocabulary({w: i for i, w in enumerate(words)}, {}, np.full(n, 1 / n), 1, 1, np.ones(classes, np.int64), np.ones(classes, np.int64))


def test_windows_are_those_of_a_plain_loop_and_faster():
    rng = random.Random(2)
    kinds = [bytes(rng.choice(b"abCDE\xc3\xa4\x00\x85\x1c") for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    vocab = vocabulary([*dict.fromkeys(w.lower() for w in kinds[:200]), lblm.END], 37)
    known = pa.array(vocab.words, pa.binary())
    texts = [None, b"", b"  ", b"a", b"B\x0b", b"\tab\r\nab", *(rng.choice([b"", b" "]) + b"".join(rng.choice(kinds) + rng.choice([b" ", b"\t\n", b"\x0c"]) for _ in range(rng.randint(0, 300))) + rng.choice(kinds) for _ in range(400)), b"zz", b"zz", None]
    for some in (texts, [], [None], texts[::-1]):
        column = pa.array([b"skipped", *some], pa.binary()).slice(1)
        for first, step in ((0, 2), (1, 2), (0, 1), (2, 3)):
            got = lblm.windows_of(*lblm.symbols_of(column, known, 37), vocab.words[lblm.END], first, step)
            assert got.tolist() == plain_windows(some, vocab, first, step).tolist()
    column, spent = pa.array(texts, pa.binary()), ([], [])
    for _ in range(5):
        for f, of in ((lambda: plain_windows(texts, vocab, 0, 2), spent[0]), (lambda: lblm.windows_of(*lblm.symbols_of(column, known, 37), 0, 0, 2), spent[1])):
            began = time.thread_time()
            f()
            of.append(time.thread_time() - began)
    assert min(spent[1]) < 0.6 * min(spent[0])
