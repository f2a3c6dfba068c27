"""Viterbi of the transcript model against all state sequences."""
import itertools

import numpy as np
import pytest

from ledgerscope.llm import chat_hmm


def model():
    roles = ["assistant", "user"]
    rng = np.random.default_rng(8)
    names = [f"{r}/{p}" for r in roles for p in ("open", "on")]
    counts = {("start", n, ""): float(rng.integers(1, 9)) for n in names}
    counts |= {("next", a, b): float(rng.integers(1, 30)) for a in names for b in names}
    counts |= {(k, n, v): float(rng.integers(1, 30)) for k, vs in chat_hmm.KINDS.items() for n in names for v in vs}
    return chat_hmm.Hmm(roles, counts)


def total(h, lines, states, enter):
    got = h.start[states[0]] if enter is None else (enter + h.trans[:, states[0]]).max()
    got += h.scores(lines[0])[states[0]]
    for f, a, b in zip(lines[1:], states, states[1:]):
        got += h.trans[a, b] + h.scores(f)[b]
    return got


@pytest.mark.parametrize("text", ["User: hi there?", "Assistant: yes\n- one\n\nmore of it", "### Human\nwhat?\n```\ncode", "\n\n\nx"])
@pytest.mark.parametrize("enters", [False, True])
@pytest.mark.parametrize("leave", [None, 0, 3])
def test_best_of_all_sequences(text, enters, leave):
    h, lines = model(), chat_hmm.line_features(text)
    enter = np.log(np.array([0.4, 0.1, 0.3, 0.2])) if enters else None
    every = [s for s in itertools.product(range(4), repeat=len(lines)) if leave is None or s[-1] == leave]
    best = max(total(h, lines, s, enter) for s in every)
    if np.isfinite(best):
        assert abs(total(h, lines, h.path(lines, enter, leave), enter) - best) < 1e-9


def test_matrix_is_best_between_borders():
    h, lines = model(), chat_hmm.line_features("User: a\nb?\n- c")
    m = h.matrix(lines)
    for i, j in itertools.product(range(4), repeat=2):
        enter = np.where(np.arange(4) == i, 0.0, -np.inf)
        best = max(total(h, lines, s, enter) for s in itertools.product(range(4), repeat=3) if s[-1] == j)
        assert m[i, j] == best or abs(m[i, j] - best) < 1e-9
