r"""Operator 10: transcript parsing with a hidden Markov model, then canonical turns.

Observations are the lines of a conversation's messages in order (turn, then row). A hidden
state is a role and whether the line opens a turn of that role or goes on with it. Lines
emit features: the speaker marker they begin with (``User:``, ``Assistant>``, ``### Human``
and the like), whether they are a message's first line, their length in steps, a question
mark at the end, a list or code mark at the start. Start, transition and emission
probabilities are counted (with add-one smoothing) on messages whose role is known, of
conversations whose crc32 modulo 4 is not 2; Viterbi recovers the roles of all lines, and
consecutive lines of one turn are rendered canonically without their markers.

Scale: counting is a Spark aggregation. Lines before a message matter only through a small
matrix, so Viterbi runs in pieces: records are range-partitioned by conversation and order
into pieces of about PIECE_ROWS rows, however long a conversation is. Each piece yields the
max-plus matrices of the conversations that cross its borders (two at most); these few
numbers per piece are scanned to get the scores that enter and the state that leaves each
piece, and every piece then runs by itself. The result is that of one long Viterbi run.

Results: a null text is one empty line; a null role is unknown and predicted like all; a
null conv_id is a conversation of its own; equal turns and repeated rows follow each other
in row order; with no known role every role is ``user``; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm._shared import Scratch

PIECE_ROWS = 20_000
#: words of speaker markers and their roles
MARKERS = {"system": "system", "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user",
           "assistant": "assistant", "ai": "assistant", "bot": "assistant", "agent": "assistant", "model": "assistant",
           "answer": "assistant", "a": "assistant"}
MARKER = re.compile(r"^\s*(?:#{1,6}\s*|\*{1,2}|<\|?|\[)?(" + "|".join(sorted(MARKERS, key=len, reverse=True))
                    + r")(?:\*{1,2}|\|?>|\])?\s*(?::|>|\n|$|(?<=>)|(?<=\]))[\s*]*", re.I)
KINDS = {"marker": ["none", "system", "user", "assistant"], "first": ["0", "1"], "size": [str(i) for i in range(12)],
         "asks": ["0", "1"], "open": ["plain", "list", "code", "empty"]}


def line_features(text: str | None) -> list[dict[str, str]]:
    out = []
    for k, line in enumerate((text or "").split("\n")):
        m = MARKER.match(line)
        body = line[m.end():] if m else line
        head = body.lstrip()[:3]
        out.append({
            "marker": MARKERS[m.group(1).lower()] if m else "none",
            "first": "1" if k == 0 else "0",
            "size": str(min(11, len(body.split()).bit_length())),
            "asks": "1" if body.rstrip().endswith("?") else "0",
            "open": "empty" if not head else "code" if head.startswith("```") else "list" if re.match(r"[-*•]|\d+[.)]", head) else "plain",
        })
    return out


class Hmm:
    """Log-probabilities; states are 2 * role (opens a turn) and 2 * role + 1 (goes on)."""

    def __init__(self, roles: list[str], counts: dict[tuple[str, str, str], float]):
        self.roles, s = roles, 2 * len(roles)
        name = [f"{r}/{p}" for r in roles for p in ("open", "on")]
        self.start = np.array([counts.get(("start", n, ""), 0) + (1 if i % 2 == 0 else 1e-6) for i, n in enumerate(name)])
        self.start = np.log(self.start / self.start.sum())
        # a turn goes on only as itself
        free = np.array([[1.0 if j % 2 == 0 or j // 2 == i // 2 else 0.0 for j in range(s)] for i in range(s)])
        t = free * (np.array([[counts.get(("next", a, b), 0) for b in name] for a in name]) + 1)
        with np.errstate(divide="ignore"):
            self.trans = np.log(t / t.sum(1, keepdims=True))
        self.emit = {}
        for kind, values in KINDS.items():
            c = np.array([[counts.get((kind, n, v), 0) + 1 for v in values] for n in name])
            self.emit[kind] = dict(zip(values, np.log(c / c.sum(1, keepdims=True)).T, strict=True))
        self.cache: dict[tuple, np.ndarray] = {}

    def scores(self, f: dict[str, str]) -> np.ndarray:
        key = tuple(f.values())
        if key not in self.cache:
            self.cache[key] = sum(self.emit[k][v] for k, v in f.items())
        return self.cache[key]

    def matrix(self, lines: list[dict]) -> np.ndarray:
        """Best score from each state before the lines to each state of the last one."""
        m = None
        for f in lines:
            step = self.trans + self.scores(f)[None, :]
            m = step if m is None else (m[:, :, None] + step[None]).max(1)
        return m

    def path(self, lines: list[dict], enter: np.ndarray | None, leave: int | None) -> list[int]:
        """Viterbi; enter: scores of the states before (None: a conversation starts);
        leave: the state of the last line, if later lines have decided it."""
        back, score = [], None
        for k, f in enumerate(lines):
            if k == 0 and enter is None:
                score = self.start + self.scores(f)
                back.append(None)
                continue
            reach = (enter if k == 0 else score)[:, None] + self.trans
            back.append(reach.argmax(0))
            score = reach.max(0) + self.scores(f)
        state = int(score.argmax()) if leave is None else leave
        out = [state]
        for b in reversed(back[1:]):
            state = int(b[state])
            out.append(state)
        return out[::-1]


def learn(messages: DataFrame, roles_known: DataFrame) -> tuple[list[str], dict]:
    """Counts of starts, transitions and emissions of the known messages (bounded result)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            c: dict[tuple, int] = {}
            for role, text, before, starts in zip(pdf["role"], pdf["text"], pdf["before"], pdf["starts"], strict=True):
                prev = f"{before}/any" if isinstance(before, str) else None
                for k, f in enumerate(line_features(text if isinstance(text, str) else None)):
                    state = f"{role}/{'on' if k or (before == role and not starts) else 'open'}"
                    if k == 0 and starts:
                        c["start", state, ""] = c.get(("start", state, ""), 0) + 1
                    elif prev is not None:
                        for p in ([f"{before}/open", f"{before}/on"] if prev.endswith("/any") else [prev]):
                            c["next", p, state] = c.get(("next", p, state), 0) + 1
                    for kind, v in f.items():
                        c[kind, state, v] = c.get((kind, state, v), 0) + 1
                    prev = state
            yield pd.DataFrame([(*k, v) for k, v in c.items()], columns=["kind", "a", "b", "n"])
    got = roles_known.select("role", "text", "before", "starts").mapInPandas(run, "kind string, a string, b string, n long")
    rows = got.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    roles = sorted({r["a"].rpartition("/")[0] for r in rows})
    return roles or ["user"], {(r["kind"], r["a"], r["b"]): float(r["n"]) for r in rows}


def render(lines: list[str], states: list[int], roles: list[str], goes_on: bool) -> tuple[list[str], str]:
    """(roles of the turns in a message, canonical text)."""
    turns: list[tuple[str, list[str]]] = []
    for k, (line, s) in enumerate(zip(lines, states, strict=True)):
        m = MARKER.match(line)
        body = line[m.end():] if m else line
        if s % 2 == 0 or not turns:
            turns.append((roles[s // 2], [body]))
        else:
            turns[-1][1].append(body)
    parts = [f"<|{r}|>\n" + "\n".join(b).strip() + "\n<|end|>" for r, b in turns]
    if goes_on:                      # the first line goes on with the message before
        parts[0] = parts[0].replace(f"<|{turns[0][0]}|>", "<|more|>", 1)
    return [r for r, _ in turns], "\n".join(parts)


def parse(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per message: conv, turn, role, role_pred (of its first line), n_turns, roles, rendered."""
    scratch = Scratch(messages.sparkSession)
    src = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                          F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    src = scratch.save(src.withColumn("row", F.monotonically_increasing_id()))
    n = src.count()
    pieces = max(1, -(-n // piece_rows))
    keys = ["conv", "turn", "row"]
    placed = scratch.save(src.repartitionByRange(pieces, *keys).withColumn("piece", F.spark_partition_id()))
    # the message before: inside a piece, and across the border through each piece's last message
    last, carried = None, {}
    ends = placed.groupBy("piece").agg(F.max_by(F.struct("conv", "role"), F.struct(*keys)).alias("m")).collect()     # one row a piece
    for r in sorted(ends, key=lambda r: r["piece"]):
        carried[r["piece"]], last = last, (r["m"]["conv"], r["m"]["role"])
    over = messages.sparkSession.sparkContext.broadcast(carried)
    out_type = "conv long, turn long, role string, text string, row long, piece int, before string, starts boolean"

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values(keys, na_position="first", kind="stable").reset_index(drop=True)

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = ordered(pdf)
        conv = [None if pd.isna(x) else int(x) for x in pdf["conv"]]
        before = over.value[int(pdf["piece"][0])]
        same = [before is not None and before[0] == conv[0], *[a == b for a, b in zip(conv[1:], conv[:-1], strict=True)]]
        pdf["starts"] = [not x for x in same]
        pdf["before"] = [r if s else None for r, s in zip([before and before[1], *pdf["role"][:-1]], same, strict=True)]
        return pdf[["conv", "turn", "role", "text", "row", "piece", "before", "starts"]]
    linked = placed.groupBy("piece").applyInPandas(chain, out_type)
    known = linked.filter(F.col("role").isNotNull() & (F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % 4, F.lit(0)) != 2))
    roles, counts = learn(messages, known)
    sent = messages.sparkSession.sparkContext.broadcast((roles, counts))     # states x feature values

    def borders(pdf: pd.DataFrame) -> pd.DataFrame:
        """The piece's first and last conversation: id, product of its lines' matrices."""
        hmm = Hmm(*sent.value)
        pdf = ordered(pdf)
        conv = [None if pd.isna(x) else int(x) for x in pdf["conv"]]
        out = []
        for which, c in (("first", conv[0]), ("last", conv[-1])):
            lines = [f for x, t in zip(conv, pdf["text"], strict=True) if x == c for f in line_features(t if isinstance(t, str) else None)]
            if which == "last" and conv[0] == c:
                break
            first = hmm.start + hmm.scores(lines[0])
            rest = hmm.matrix(lines[1:]) if len(lines) > 1 else None
            opened = first if rest is None else (first[:, None] + rest).max(0)
            out.append((int(pdf["piece"][0]), which, c, conv[0] == conv[-1], hmm.matrix(lines).ravel().tolist(), opened.tolist()))
        return pd.DataFrame(out, columns=["piece", "which", "conv", "whole", "m", "opened"])
    edge = placed.groupBy("piece").applyInPandas(borders, "piece int, which string, conv long, whole boolean, m array<double>, opened array<double>")
    rows = sorted(edge.collect(), key=lambda r: (r["piece"], r["which"] == "last"))     # two rows a piece at most
    enter, leave = _scan(rows, 2 * len(roles))
    ends = messages.sparkSession.sparkContext.broadcast((enter, leave))

    def decode(pdf: pd.DataFrame) -> pd.DataFrame:
        hmm = Hmm(*sent.value)
        came, goes = ends.value
        pdf = ordered(pdf)
        piece = int(pdf["piece"][0])
        conv = [None if pd.isna(x) else int(x) for x in pdf["conv"]]
        cut = [0, *[k for k in range(1, len(conv)) if conv[k] != conv[k - 1]], len(conv)]
        got = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            texts = [t if isinstance(t, str) else "" for t in pdf["text"][a:b]]
            feats = [line_features(t) for t in texts]
            states = hmm.path([f for fs in feats for f in fs], came.get(piece) if a == 0 else None,
                              goes.get(piece) if b == len(conv) else None)
            at = 0
            for k, (t, fs) in enumerate(zip(texts, feats, strict=True)):
                part = states[at:at + len(fs)]
                at += len(fs)
                turns, text = render(t.split("\n"), part, hmm.roles, part[0] % 2 == 1)
                got.append((turns[0], len(turns), turns, text))
        pdf[["role_pred", "n_turns", "roles", "rendered"]] = pd.DataFrame(got, columns=["role_pred", "n_turns", "roles", "rendered"])
        return pdf[["conv", "turn", "role", "role_pred", "n_turns", "roles", "rendered"]]
    done = placed.groupBy("piece").applyInPandas(
        decode, "conv long, turn long, role string, role_pred string, n_turns long, roles array<string>, rendered string")
    return done.withColumnRenamed("conv", conv_col).withColumnRenamed("turn", turn_col)


def _scan(rows: list, s: int) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Scores that enter each piece's first conversation, and the state that its last one
    leaves with, where a conversation crosses a border."""
    order: dict[int, dict] = {}
    for r in rows:
        order.setdefault(r["piece"], {})[r["which"]] = r
    pieces = sorted(order)
    enter: dict[int, np.ndarray] = {}
    out: dict[int, np.ndarray] = {}          # scores at the end of each piece
    for k, p in enumerate(pieces):
        first, last = order[p]["first"], order[p].get("last", order[p]["first"])
        prev = order[pieces[k - 1]] if k else None
        if prev is not None and prev.get("last", prev["first"])["conv"] == first["conv"]:
            enter[p] = out[pieces[k - 1]]
        if last is first and p in enter:
            out[p] = (enter[p][:, None] + np.array(first["m"]).reshape(s, s)).max(0)
        else:
            out[p] = np.array(last["opened"])
    leave: dict[int, int] = {}
    for k in range(len(pieces) - 2, -1, -1):
        p, q = pieces[k], pieces[k + 1]
        if q not in enter:
            continue
        m = np.array(order[q]["first"]["m"]).reshape(s, s)
        ends = leave.get(q) if order[q]["first"]["whole"] else None
        total = enter[q][:, None] + m
        leave[p] = int((total[:, ends] if ends is not None else total.max(1)).argmax())
    return enter, leave
