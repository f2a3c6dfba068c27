"""Workers give back what a task freed: they live on beside the next stage's memory."""
import re

import numpy as np
import pyarrow as pa

from ledgerscope.llm import _text, langid_crf


def resident() -> float:
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\s+(\d+)", f.read())[1]) / 1024


def test_freed_memory_goes_back():
    before = resident()
    held = [bytearray(b"x" * 50_000) for _ in range(4_000)]      # too small for maps of their own
    last = bytearray(100)                                        # keeps the heap's end in place
    full = resident()
    del held
    _text.release()
    assert full - before > 150
    assert resident() - before < 60, last


def test_language_task_gives_back(spark, monkeypatch):
    """The stage's task ends with a release, and keeps the same rows."""
    words = ["le chat noir", "the black cat", "die schwarze katze"]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(rng.choice(words[k % 3].split(" "), 30)), "fed"[k % 3]) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    blob = langid_crf.fit(docs, "doc_id", "text", "lang", 20)
    called, batch = [], pa.RecordBatch.from_arrays(
        [pa.array([r[1] for r in rows]), pa.array([{"doc_id": r[0], "lang": r[2]} for r in rows])], names=["text", "rest"])
    monkeypatch.setattr(_text, "release", lambda: called.append(1))
    run = []
    frame = type(docs)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, schema: run.append(f) or self)
    langid_crf.accepted(docs, blob, 0.5)
    got = pa.Table.from_batches(run[0](iter([batch])))
    assert called and got.num_rows == 60
