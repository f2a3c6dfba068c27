"""Counts and roles do not depend on where the pieces' borders lie."""
import numpy as np
import pytest

from ledgerscope.llm import chat_hmm


@pytest.mark.parametrize("seed", [4, 5])
def test_pieces_give_one_result(spark, monkeypatch, seed):
    rng = np.random.default_rng(seed)
    t = [(5, i // 2, ["user", "assistant", None][int(rng.integers(3))], f"User: hi {i}\nmore?" if i % 3 else None) for i in range(60)]
    t += [(7 + i // 3, i % 3, ["user", "assistant"][i % 2], "hi " * int(rng.integers(1, 9))) for i in range(30)]
    d = spark.createDataFrame(t + [(None, None, None, "x"), (6, 0, "system", "Assistant: y")],
                              "conv_id long, turn long, role string, text string").coalesce(1)
    learned, learn = [], chat_hmm.learn
    monkeypatch.setattr(chat_hmm, "learn", lambda *a: learned.append(learn(*a)) or learned[-1])

    def result(n):
        return sorted(map(repr, chat_hmm.parse(d, piece_rows=n).collect()))
    whole = result(10_000)
    assert len(whole) == len(t) + 2
    assert result(7) == whole
    assert learned[0] == learned[1]
