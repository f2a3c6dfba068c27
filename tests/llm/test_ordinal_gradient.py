"""The ordinal fit ends where the numeric gradient of its own objective is zero."""
import pickle

import numpy as np
import pyarrow as pa

from ledgerscope.llm import _text as X
from ledgerscope.llm import ordinal_quality as O

DECAY = 0.05


def rated():
    rng = np.random.default_rng(4)
    words = ["aa", "bb", "cc", "dd", "ee", "ff"]        # too short for the features of four and five bytes
    texts, grades = [], []
    for _ in range(48):
        g = int(rng.integers(0, 3))
        p = np.array([[4, 2, 1, 1, 1, 1], [1, 1, 4, 2, 1, 1], [1, 1, 1, 1, 4, 2]])[g] / 10
        texts.append(" ".join(rng.choice(words, 3, p=p)))
        grades.append(g)
    return texts, grades


def test_numeric_gradient_vanishes_at_the_fit():
    texts, grades = rated()
    # all rows are one batch, so each epoch is one step on the whole objective
    w, theta, known = pickle.loads(O.fit_rows(texts, grades, epochs=6000, rate=0.3, decay=DECAY, least=1))
    assert (np.diff(theta) > 0).all()
    (_, _, data, offsets, _), = X.blocks(pa.array(texts))
    f, first = O.known_only(*O.features(data, offsets), known)
    used, where = np.unique(f, return_inverse=True)
    n, y = np.diff(first), np.array(grades)

    def loss(v):
        eta = np.add.reduceat(v[:len(used)][where], first[:-1]) * n ** -0.25
        below = 1 / (1 + np.exp(-(v[len(used):][None, :] - eta[:, None])))
        cdf = np.concatenate([np.zeros((len(y), 1)), below, np.ones((len(y), 1))], 1)
        p = cdf[np.arange(len(y)), y + 1] - cdf[np.arange(len(y)), y]
        return -np.log(p).sum() + DECAY / 2 * (v[:len(used)] ** 2).sum()

    def gradient(v):
        step = 1e-5
        return np.array([(loss(v + step * e) - loss(v - step * e)) / (2 * step) for e in np.eye(len(v))])
    start = np.concatenate([np.zeros(len(used)), np.array([-0.7, 0.7])])
    end = np.concatenate([w[used].astype(np.float64), theta])
    assert loss(end) < 0.9 * loss(start)
    assert np.abs(gradient(end)).max() < 1e-2 < 1 < np.abs(gradient(start)).max()
