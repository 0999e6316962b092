"""Token counts (operator 7): prefix dynamic programming over a sentencepiece BPE model.

Merges only ever join neighbours, the best piece first, so two facts hold of the tokens of a text:

- every run of neighbouring tokens is itself encoded as just these tokens;
- a sequence of pieces is the encoding of its text if each two neighbours are the encoding of theirs.

Hence the tokens of a prefix are those of a shorter prefix and one last token, which is the only piece ending
there that its text, joined to the last token before it, keeps apart:

    last(i)  = the piece t ending at i with encode(last(i - |t|) + t) = last(i - |t|), t
    count(i) = count(i - |t|) + tokens of t

The table holds ``last`` and ``count`` for every character; a step tries at most one piece of each length, so it
is linear in the text. Whether two pieces stay apart is asked of the library once per pair and remembered.

No piece of such a model holds a space mark after another character (checked when it is loaded), so no token
crosses from a word into the spaces of the next one: the tables of distinct segments (spaces, then other
characters) are built once and remembered, and a text's table is its segments' tables, each on top of the tokens
before it. A model with pieces across that border has one segment per text.

``prefix_tokens`` stores the exact count of the first 1, 2, … characters of a text. ``tokens_before``,
``longest_prefix`` and ``truncate`` only look things up there; they never encode.

Models of another kind (no byte pieces, own symbols, characters that only longer pieces hold, not BPE, folded or
dropped characters) keep exact counts,
but their tables are built by encoding every prefix, in time that grows with the square of a text.

Defined cases: null text counts as empty (0 bytes, 0 tokens, an empty table; cut, it stays null); texts without
spaces are one segment; a budget below 0 is taken as 0, and asks beyond the text as its length; counts may fall from
one prefix to the next, and the longest prefix within the budget is taken, whatever lies between; repeated
rows give repeated results; columns of the result replace columns of the same name.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField

from . import common

MARK = "▁"
#: A character of no piece: it puts an end to the mark that the library places before a text.
GUARD = "\U0010FFFD"
#: Bytes of tables and keys (with ENTRY for each entry's objects) that a Python worker's dictionary of segments may
#: hold; cleared when full. Longer segments than SHORT are not remembered. PAIRS bounds the remembered pairs.
MEMO_BYTES, ENTRY, SHORT, PAIRS = 128 << 20, 160, 64, 400_000
SEGMENT = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")


class Counter:
    """Exact prefix counts with one sentencepiece model."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        kinds, normal = sentencepiece_model_pb2.ModelProto.SentencePiece, [p.piece for p in proto.pieces if p.type == 1]
        ordinary = set(normal)
        self.chains = proto.trainer_spec.model_type == proto.trainer_spec.BPE and proto.trainer_spec.byte_fallback \
            and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) or GUARD in p.piece for p in proto.pieces) \
            and all(c in ordinary for p in normal for c in p) and self.plain()
        self.splits = self.chains and not any(MARK in p.lstrip(MARK) for p in normal)
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0
        if self.chains:
            self.guard = len(self.model.encode(GUARD))
            ids = self.model.encode([GUARD + p for p in normal], num_threads=1)
            self.pieces = {p: i[-1] for p, i in zip(normal, ids, strict=True) if len(i) == self.guard + 1}
            self.pairs: dict[str, dict[str, bool]] = {p: {} for p in self.pieces}
            self.asked = 0
            self.ending = ahocorasick.Automaton()
            for p, known in self.pairs.items():
                self.ending.add_word(p, (len(p), p, known))
            self.ending.make_automaton()

    def plain(self) -> bool:
        """Whether texts reach the merges unchanged but for a leading mark (no folding, no dropped spaces)."""
        probe = " a  b　ﬁ½ ​ "
        ids = self.model.encode(probe)
        return self.model.decode(ids).replace(" ", "") == probe.replace(" ", "") and \
            "".join(self.model.encode(" a  b ", out_type=str)) == f"{MARK}{MARK}a{MARK}{MARK}b{MARK}"

    def apart(self, u: str, t: str, known: dict[str, bool]) -> bool:
        """Whether the text of two tokens is encoded as these two; remembered in ``known``, the pairs of ``t``."""
        if u not in self.pieces:
            return True
        if self.asked >= PAIRS:
            for pairs in self.pairs.values():
                pairs.clear()
            self.asked = 0
        self.asked += 1
        known[u] = self.model.encode(GUARD + u + t)[self.guard:] == [self.pieces[u], self.pieces[t]]
        return known[u]

    def table(self, segment: str) -> list[int]:
        """Token count of every non-empty prefix of one segment.

        The automaton names the pieces that end at each character, longest first. A character that is no piece is kept
        as its bytes and apart from all neighbours.
        """
        if not self.chains:
            return [len(x) for x in self.model.encode([segment[:i] for i in range(1, len(segment) + 1)], num_threads=1)]
        last, count, filled = [""], [0], 0
        for at, (size, t, known) in self.ending.iter(segment):
            if at < filled:
                continue
            while filled < at:
                last.append(segment[filled])
                count.append(count[filled] + len(segment[filled].encode()))
                filled += 1
            start = at + 1 - size
            u = last[start]
            if not u or (known[u] if u in known else self.apart(u, t, known)):
                last.append(t)
                count.append(count[start] + 1)
                filled += 1
        for char in segment[filled:]:
            count.append(count[-1] + len(char.encode()))
        return count[1:]

    def segments(self, text: str) -> list[str]:
        """Segments of the text as the merges see it: with the leading mark, spaces as marks."""
        if not text or not self.chains:
            return [text] if text else []
        body = MARK + text.replace(" ", MARK)
        return SEGMENT.findall(body) if self.splits else [body]

    def known(self, segments: list[str]) -> list[bytes]:
        """Tables (32-bit counts) of distinct segments."""
        out = []
        for s in segments:
            t = self.memo.get(s)
            if t is None:
                t = array("i", self.table(s)).tobytes()
                if len(s) <= SHORT:
                    size = len(s) + len(t) + ENTRY
                    self.memo_bytes += size
                    if self.memo_bytes > MEMO_BYTES:
                        self.memo.clear()
                        self.memo_bytes = size
                    self.memo[s] = t
            out.append(t)
        return out

    def prefix_counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all prefixes of all texts in one array, and where each text starts in it."""
        number: dict[str, int] = {}
        codes, heads = [], []
        for t in texts:
            heads.append(len(codes))
            codes += [number.setdefault(s, len(number)) for s in self.segments(t or "")]
        starts = np.concatenate([[0], np.cumsum([len(t or "") for t in texts])]).astype(np.int64)
        if not codes:
            return np.zeros(0, np.int32), starts
        flat = np.frombuffer(b"".join(self.known(list(number))), dtype=np.int32)
        code = np.array(codes, dtype=np.int32)
        size = np.fromiter(map(len, number), np.int64, len(number))
        end = np.cumsum(size)
        total = flat[end - 1].astype(np.int64)[code]
        before = np.cumsum(total) - total
        heads = np.array(heads)
        of_text = np.searchsorted(heads, np.arange(len(code)), side="right") - 1
        before -= before[heads[of_text]]
        lens = size[code]
        to = np.cumsum(lens)
        shift = (end - size)[code] - (to - lens)
        counts = flat[np.arange(to[-1]) + np.repeat(shift, lens)] + np.repeat(before.astype(np.int32), lens)
        if self.chains:
            first = np.zeros(len(code), dtype=bool)
            first[heads[np.diff(starts) > 0]] = True
            counts = np.delete(counts, (to - lens)[first])
        return counts, starts


def tokens_before(counts: np.ndarray, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters, from a text's stored counts."""
    n_chars = max(0, min(n_chars, len(counts)))
    return int(counts[n_chars - 1]) if n_chars else 0


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Most characters whose token count is within ``budget``, from a text's stored counts."""
    fits = np.flatnonzero(counts <= max(0, budget))
    return int(fits[-1]) + 1 if len(fits) else 0


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def prefix_token_counts(df: DataFrame, model_path: str, limit: int = 4096, text: str = "text",
                        keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``prefix_tokens`` (tokens of the first 1, 2, … characters).

    The whole count is the last entry of the prefix table.
    """
    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()),
              StructField("prefix_tokens", ArrayType(IntegerType()))]

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(text).to_pylist()
        counts, starts = counter(model_path).prefix_counts(texts)
        n = np.append(counts, 0)[starts[1:] - 1] * (np.diff(starts) > 0)
        return {"n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": pa.array(n.astype(np.int64)),
                "over_limit": pa.array(n > limit),
                "prefix_tokens": pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32, copy=False)))}

    return common.map_batches(df, run, fields, [text], keep)


def truncate(df: DataFrame, budget: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (with stored prefix tables) with ``within_budget``: its text cut to at most ``budget`` tokens, by looking up."""

    def run(batch: pa.RecordBatch) -> dict:
        tables = batch.column("prefix_tokens")
        return {"within_budget": [t and t[:longest_prefix(np.asarray(c.values), budget)]
                                  for t, c in zip(batch.column(text).to_pylist(), tables, strict=True)]}

    return common.map_batches(df, run, [StructField("within_budget", StringType())], [text, "prefix_tokens"], keep)
