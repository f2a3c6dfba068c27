"""A line's fate depends on how many documents of its host hold it, not on the host's size."""
from ledgerscope.llm import line_rules


def test_same_counts_on_small_and_hot_host(spark):
    def body(i):
        name = "".join("abcdefghij"[int(d)] for d in str(i))      # digits count as equal
        return " ".join(f"w{name}x{'k' * k}" for k in range(60))
    held = "\n".join(f"shared line {c} " + c * 3 + " and so on" for c in "abcdefghijklm")
    docs = []
    for host, size in (("small", 40), ("hot", 4000), (None, 2600)):
        for i in range(size):
            text = body(len(docs))
            if i < 21:
                text += "\n" + "seen in one and twenty documents"
            if i < 20:
                text += "\n" + "seen in twenty documents"
            if 10 <= i < 35:
                text += "\n" + held
            docs.append((len(docs), host, text))
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(4)
    got = {r["doc_id"]: r for r in line_rules.line_quality(df).collect()}
    assert len(got) == len(docs)
    start = 0
    for size in (40, 4000, 2600):
        for i in range(size):
            r = got[start + i]
            lines = (i < 21) + (13 if 10 <= i < 35 else 0)
            assert r["n_removed_lines"] == lines
            assert r["n_removed_words"] == 6 * (i < 21) + (13 * 7 if 10 <= i < 35 else 0)
            assert not r["base_failed"] and r["kept"] == (not 10 <= i < 35)
        start += size
