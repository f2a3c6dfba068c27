r"""Operator 9: exact BPE encoding by backtracking, and decoding.

The vocabulary is read from a SentencePiece BPE model (path is a parameter). Encoding
never replays merges over the text. It walks left to right over Aho-Corasick longest
matches; a token is kept only if it may stand beside its left neighbour, which a short
re-merging of the two tokens decides; otherwise the next shorter prefix piece is tried,
and positions from which no continuation exists are remembered in a bitfield, so no
position fails twice. The result is the very segmentation that greedy merging by score
(leftmost first among equals) gives.

Blanks become the piece mark, one mark is put before a non-empty text, and a character
without a piece becomes its byte pieces. Where no piece holds a mark after another
character (checked on loading), merges never cross from a word into the next mark, so
marks cut the text into units and the units' encodings are kept within a task.

Results: null or empty text gives only the end id and decodes to the empty text;
texts of any length take linear time; repeated rows repeat their result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import ship

MARK = "▁"
KEEP_UNITS = 150_000      # units kept in a task; the store is emptied when full and at the end


class PieceModel:
    """Pieces of a BPE model, with the tables that compatibility checks need."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk, self.bos, self.eos = sp.unk_id(), sp.bos_id(), sp.eos_id()
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.byte_id, self.byte_of = {}, {}
        plain = []
        for i in range(n):
            if sp.is_byte(i):
                b = int(self.pieces[i][3:5], 16)
                self.byte_id[b], self.byte_of[i] = i, b
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain.append(i)
        # rank: order of merging. A better score merges first.
        self.rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-sp.get_score(i), i)))}
        self.id_of = {self.pieces[i]: i for i in plain}
        self.size = [len(p) for p in self.pieces]
        self.longest = max((len(self.pieces[i]) for i in plain), default=1)
        self.marks_cut = not any(re.search(f"[^{MARK}]{MARK}", self.pieces[i]) for i in plain)
        # the last merge inside each piece; pieces that merging never builds are left out
        self.split: dict[int, tuple[int, int] | None] = {}
        for i in sorted(plain, key=lambda i: len(self.pieces[i])):
            made = self._last_merge(self.pieces[i])
            if made is not None:
                self.split[i] = made or None
        self.trie = ahocorasick.Automaton()
        for i in self.split:
            self.trie.add_word(self.pieces[i], i)
        self.trie.make_automaton()
        # the next shorter piece that begins a piece
        self.shorter: dict[int, int] = {}
        for i in self.split:
            s = self.pieces[i]
            for k in range(len(s) - 1, 0, -1):
                j = self.id_of.get(s[:k])
                if j in self.split:
                    self.shorter[i] = j
                    break
        # for every path in the trie, the longest piece that begins it
        self.best: dict[str, int] = {}
        for i in sorted(self.split, key=lambda i: len(self.pieces[i])):
            s = self.pieces[i]
            for k in range(1, len(s) + 1):
                j = self.id_of.get(s[:k])
                if j in self.split:
                    last = j
                    self.best[s[:k]] = j
                elif k > 1:
                    self.best[s[:k]] = last
        self.chars = frozenset(c for c in self.id_of if len(c) == 1)
        self.bytes_of = [self._bytes(i) for i in range(n)]
        self.text_of = [str(i) for i in range(n)]
        self.pair: dict[int, bool] = {}
        self.store: dict[str, tuple] = {}
        self.keep = KEEP_UNITS

    def _bytes(self, i: int) -> bytes:
        """Bytes of an id: a mark is a blank, a byte piece its byte, a control id nothing."""
        if i in self.byte_of:
            return bytes([self.byte_of[i]])
        if i == self.unk:
            return " ⁇ ".encode()
        return b"" if i in self.control else self.pieces[i].replace(MARK, " ").encode("utf-8", "surrogatepass")

    def _last_merge(self, s: str):
        """The two ids whose merge completes s when s is merged by itself; () for one
        character; None if merging s does not end in s."""
        if len(s) == 1:
            return ()
        parts = list(s)
        if any(p not in self.id_of for p in parts):
            return None
        while len(parts) > 2:
            best = min(((self.rank.get(self.id_of.get(parts[k] + parts[k + 1]), 1 << 60), k)
                        for k in range(len(parts) - 1)))
            if best[0] == 1 << 60:
                return None
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return tuple(self.id_of[p] for p in parts)

    def joined(self, a: int, b: int) -> int | None:
        """Merge rank of two adjacent pieces, None if they do not merge."""
        i = self.id_of.get(self.pieces[a] + self.pieces[b])
        return None if i is None else self.rank[i]

    def compatible(self, a: int, b: int) -> bool:
        """May b follow a? Undo the two tokens' merges from the latest on; at each stage
        the pieces that then face each other must not have merged with each other earlier
        than the merge undone last took one of them away (among equal ranks the left
        position goes first)."""
        limit, ok = float("inf"), True
        while True:
            r = self.joined(a, b)
            if r is not None and r < limit:
                ok = False
                break
            sa, sb = self.split[a], self.split[b]
            ra = self.rank[a] if sa else -1
            rb = self.rank[b] if sb else -1
            if ra < 0 and rb < 0:
                break
            if ra > rb:        # a's last merge came later than b's: a was still in two
                limit, a = ra, sa[1]
            else:              # equal ranks: the left one came first, so b is undone first
                limit, b = rb + 0.5, sb[0]
        return ok

    def fit(self, a: int, b: int) -> bool:
        """``compatible``, kept for the pair."""
        if len(self.pair) > 300_000:
            self.pair.clear()
        got = self.pair[a << 20 | b] = self.compatible(a, b)
        return got

    def encode_known(self, s: str) -> list[int]:
        """Ids of a run of characters that all have pieces."""
        n, at, out, last = len(s), 0, [], -1
        deepest, best, size, pair, longest = self.trie.longest_prefix, self.best, self.size, self.pair, self.longest
        while True:                                 # until a longest match does not fit
            rest = s[at:at + longest]
            token = best[rest[:deepest(rest)]]
            if last >= 0:
                fits = pair.get(last << 20 | token)
                if fits is None:
                    fits = self.fit(last, token)
                if not fits:
                    break
            out.append(token)
            at += size[token]
            if at >= n:
                return out
            last = token
        failed = bytearray((n + 8) // 8)            # a bit for each position with no way on
        while at < n:
            end = at + size[token]
            fits = not failed[end >> 3] >> (end & 7) & 1
            if fits and out:
                key = out[-1] << 20 | token
                fits = pair.get(key)
                if fits is None:
                    fits = self.fit(out[-1], token)
            if fits:
                out.append(token)
                at = end
                if at < n:
                    rest = s[at:at + longest]
                    token = best[rest[:deepest(rest)]]
                continue
            token = self.shorter.get(token)
            while token is None:                     # back to the position before
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError("no segmentation")
                token = out.pop()
                at -= size[token]
                token = self.shorter.get(token)
        return out

    def encode_unit(self, s: str) -> list[int]:
        if self.chars.issuperset(s):
            return self.encode_known(s)
        out, at, n = [], 0, len(s)
        while at < n:
            end = at
            while end < n and s[end] in self.chars:
                end += 1
            if end > at:
                out += self.encode_known(s[at:end])
            if end < n:
                raw = [self.byte_id.get(b) for b in s[end].encode("utf-8", "surrogatepass")]
                out += [self.unk] if None in raw else raw
                end += 1
            at = end
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for unit in self.units(text):
            out += self.unit(unit)[0]
        return out + [self.eos]

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        s = MARK + text.replace(" ", MARK)
        return UNIT.findall(s) if self.marks_cut else [s]

    def unit(self, u: str) -> tuple[tuple[int, ...], str, bytes]:
        """(ids, ids as text, decoded bytes) of one unit."""
        got = self.store.get(u)
        if got is None:
            ids = self.encode_unit(u)
            got = (tuple(ids), " ".join([self.text_of[i] for i in ids]), self.raw(ids))
            if len(u) <= 200:
                if len(self.store) >= self.keep:
                    self.store.clear()
                self.store[u] = got
        return got

    def raw(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the mark put in front goes, broken bytes become U+FFFD each."""
        raw = self.raw(ids)
        lead = next((i for i in ids if i not in self.control), None)
        if lead is not None and lead not in self.byte_of and self.pieces[lead].startswith(MARK):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of this worker, loaded once."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids`` (array of all ids with the end id) and ``decoded`` text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [m.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([m.decode(x) for x in ids], pa.string())],
                    names=["id", "ids", "decoded"])
        m.store.clear()
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
            keep_units: int = KEEP_UNITS) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256, without building the id arrays:
    each unit's ids, as text and decoded, are taken from the worker's store of at most
    ``keep_units`` units (about 0.9 KB each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        m.keep = keep_units
        for batch in batches:
            n, hid, hdec = [], [], []
            known, end = m.store.get, f" {m.eos}".encode()
            for i in range(batch.num_rows):
                units = [known(u) or m.unit(u) for u in m.units(batch.column(1)[i].as_py())]
                ids, text, raw = zip(*units, strict=True) if units else ((), (), ())
                n.append(sum(map(len, ids)) + 1)
                hid.append(hashlib.sha256(" ".join(text).encode() + end if units else end[1:]).hexdigest())
                hdec.append(hashlib.sha256(b"".join(raw)[1:]).hexdigest())     # without the mark put in front
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hid, pa.string()), pa.array(hdec, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        m.store.clear()                      # the worker lives on and other tasks need the memory
        X.release()
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string") \
        .withColumnRenamed("id", id_col)
