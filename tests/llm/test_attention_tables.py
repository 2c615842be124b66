"""The attention model looks up what depends on ids alone, and holds the output scores of a few places only."""
import tracemalloc

import numpy as np
import pytest

from fraudlake.llm import attention

N = attention.IDS


def plain(p, ids, target):
    """Log-probabilities by the formula, each position for itself, in double precision."""
    out = np.zeros(target.shape)
    p = {n: x.astype(np.float64) for n, x in p.items()}
    for w in range(len(ids)):
        for i in range(attention.BLOCK):
            at = attention.BLOCK + i
            keys = [j for j in range(at + 1) if ids[w, j] != attention.PAD]
            x = p["emb"][ids[w]]
            s = np.array([x[at] @ p["q"] @ (x[j] @ p["k"]) * attention.WIDTH**-0.5 + p["near"][at - j] for j in keys])
            a = np.exp(s - s.max())
            h = x[at] + (a / a.sum()) @ (x[keys] @ p["v"]) @ p["o"]
            y = np.tanh(h @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
            out[w, i] = y[target[w, i]] - y.max() - np.log(np.exp(y - y.max()).sum())
    return out


@pytest.mark.parametrize("scale, kind", [(1, np.float32), (30, np.float64)])  # 30: exponents far beyond the range
def test_tables_give_the_formula(scale, kind):
    rng = np.random.default_rng(3)
    m = attention.Model(np.full(N, 1 / N))
    m.p = {n: (rng.normal(0, 0.3, x.shape) * (scale if n in ("q", "k", "near", "w2", "b2") else 1)).astype(kind) for n, x in m.p.items()}
    ids, target = rng.integers(0, N, (5, 2 * attention.BLOCK)), rng.integers(0, N, (5, attention.BLOCK))
    ids[0, : attention.BLOCK] = attention.PAD
    assert m.tables()["deep"] == (m._bias() is None) == (scale > 1)
    assert np.allclose(m.log_prob(ids, target), plain(m.p, ids, target), rtol=1e-5, atol=1e-4)
    target[1, 9:] = attention.PAD
    g = m.gradients(ids, target)
    loss = lambda: -m.log_prob(ids, np.minimum(target, N - 1))[target != attention.PAD].mean()
    if kind == np.float64:
        for name, x in m.p.items():
            at = np.unravel_index(np.abs(g[name]).argmax(), x.shape)
            old, step = x[at], 1e-6
            x[at] = old + step
            up = loss()
            x[at] = old - step
            down = loss()
            x[at] = old
            assert abs((up - down) / (2 * step) - g[name][at]) < 1e-4 * max(1, abs(g[name][at]))


def test_many_windows_are_scored_in_little_memory():
    rng = np.random.default_rng(4)
    m = attention.Model(np.full(N, 1 / N))
    ids, target = rng.integers(0, N, (4096, 2 * attention.BLOCK)).astype(np.int16), rng.integers(0, N, (4096, attention.BLOCK))
    m.log_prob(ids[:128], target[:128])
    tracemalloc.start()
    m.log_prob(ids, target)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6  # one array of all windows' scores is 33 MB
