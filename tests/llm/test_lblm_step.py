"""The training step against a plain form of it: the same parameters, in clearly less time."""

import time

import numpy as np

from siltwork.llm import lblm


def plain_step(p, square, before, before2, token, noise, log_kq, rate=lblm.RATE):
    u, v = p.context[before], p.context[before2]
    q = u * p.place[0] + v * p.place[1]
    t, n = p.target[token], p.target[noise]
    g_true = 1 / (1 + np.exp(-np.clip((q * t).sum(1) + p.bias[token] - log_kq[token], -30, 30))) - 1
    false = q @ n.T + p.bias[noise] - log_kq[noise]
    g_false = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
    g_q = g_true[:, None] * t + g_false @ n
    for name, index, grad in (
        ("target", np.concatenate([token, noise]), np.concatenate([g_true[:, None] * q, g_false.T @ q])),
        ("context", np.concatenate([before, before2]), np.concatenate([g_q * p.place[0], g_q * p.place[1]])),
        ("bias", np.concatenate([token, noise]), np.concatenate([g_true, g_false.sum(0)])),
    ):
        order = np.argsort(index, kind="stable")
        rows, first = np.unique(index[order], return_index=True)
        full = np.add.reduceat(grad[order].astype(np.float32) / len(token), first, axis=0)
        getattr(square, name)[rows] += full * full
        getattr(p, name)[rows] -= rate * full / (np.sqrt(getattr(square, name)[rows]) + 1e-6)
    place = np.stack([(g_q * u).sum(0), (g_q * v).sum(0)]).astype(np.float32) / len(token)
    square.place += place * place
    p.place -= rate * place / (np.sqrt(square.place) + 1e-6)


def test_a_training_step_is_the_plain_one_and_faster():
    rng, n = np.random.default_rng(0), 2047
    unigram = 1 / np.arange(1, n + 1) ** 0.8
    unigram /= unigram.sum()
    log_kq = np.log(lblm.NOISE * unigram).astype(np.float32)
    batches = [(*(rng.choice(n, lblm.BATCH, p=unigram) for _ in range(3)), rng.choice(n, lblm.NOISE, p=unigram)) for _ in range(30)]

    def taught(step):
        p = lblm.Parameters.initial(unigram)
        square = lblm.Parameters.of_rows(np.full_like(p.rows(), 1e-3))
        began = time.thread_time()
        for batch in batches:
            step(p, square, *batch, log_kq)
        return p.rows(), time.thread_time() - began

    runs = [(taught(plain_step), taught(lblm.nce_step)) for _ in range(6)]
    assert np.allclose(runs[0][0][0], runs[0][1][0], atol=1e-4)
    assert min(new[1] for _, new in runs) < 0.8 * min(old[1] for old, _ in runs)


def test_sums_of_rows_with_small_and_large_numbers():
    rng = np.random.default_rng(1)
    for top in (50, 1 << 20):
        index, grad = rng.integers(0, top, 500), rng.standard_normal((500, 3))
        rows, full = lblm._sums(index, grad)
        assert rows.tolist() == sorted(set(index.tolist()))
        assert np.allclose(full, [grad[index == r].sum(0) for r in rows])
