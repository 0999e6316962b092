"""Byte-level BPE encoding and decoding (operator 4) with the tokenizers library over Arrow batches.

The rank file is turned into the library's vocabulary and merges once, on the
driver: bytes are written as the printable characters of the byte table, and
the two parts of each token are what the lower ranks merge its bytes to. The
serialised tokenizer (a few MB, fixed by the vocabulary) travels with the
tasks and is loaded once per Python worker.

Texts are cut at single spaces between two non-space characters, where the
split pattern always starts a new match, so each distinct short chunk of a
worker is encoded once and kept in a dictionary bounded by bytes. New chunks are
encoded joined to one text and taken apart by the tokens' byte offsets, which must
fall on the chunks' ends.

Decoding reverses the byte table. A token may end inside a UTF-8 character;
``byte_spans`` keeps byte offsets and ``char_spans`` maps them to the
characters a token touches, so a split character is named by each of its
tokens.

Defined cases: null text encodes as empty text (no ids); ids decode to the
exact bytes of the text; a null id list decodes to no bytes; an unknown id
raises ValueError; repeated rows give repeated results; columns of the result
replace columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField

from . import common

#: Bytes that a Python worker's dictionary of chunks may hold (with ENTRY for each entry's objects); cleared when full.
MEMO_BYTES, ENTRY = 32 << 20, 150
#: Longer chunks are not remembered; new chunks are encoded in joined pieces of about so many characters.
SHORT, PIECE = 64, 1 << 16
CUT = re.compile(r"(?<=\S) (?=\S)")
NOT_SINGLE = re.compile(r"\s | \s|^ | $")


def byte_table() -> list[str]:
    """The printable character of each byte: itself where printable, else the next free one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


TO_CHAR = byte_table()
TO_BYTE = {c: b for b, c in enumerate(TO_CHAR)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def two_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """What merges below the token's own rank leave of its bytes; always two parts."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        i = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], len(ranks)))
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@lru_cache(maxsize=4)
def tokenizer_json(rank_path: str, pattern: str) -> str:
    """The library's own serialised form of the tokenizer that the ranks and the split pattern describe."""
    ranks = read_ranks(rank_path)
    chars = {t: "".join(map(TO_CHAR.__getitem__, t)) for t in ranks}
    merges = [[chars[p] for p in two_parts(t, ranks)] for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "post_processor": None, "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                  "vocab": {chars[t]: r for t, r in ranks.items()}, "merges": merges}})


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocab = self.tokenizer.get_vocab()
        self.pieces = [b""] * (max(vocab.values(), default=-1) + 1)
        for piece, i in vocab.items():
            self.pieces[i] = bytes(map(TO_BYTE.__getitem__, piece))
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.by_id = np.array(self.pieces, object)
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (unsigned 32 bit) of each text."""
        split = [chunks(t or "") for t in texts]
        memo = self.memo
        fresh = self.encode_chunks(list(dict.fromkeys(c for cs in split for c in cs if c not in memo)))
        out = [np.frombuffer(b"".join([memo[c] if c in memo else fresh[c] for c in cs]), "<u4") for cs in split]
        self.remember(fresh)
        return out

    def remember(self, fresh: dict[str, bytes]) -> None:
        for c, ids in fresh.items():
            if len(c) <= SHORT:
                self.memo_bytes += 4 * len(c) + len(ids) + ENTRY
                if self.memo_bytes > MEMO_BYTES:
                    self.memo.clear()
                    self.memo_bytes = 4 * len(c) + len(ids) + ENTRY
                self.memo[c] = ids

    def encode_chunks(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks. Those that begin with the space they were cut at and end with another character are joined."""
        found: dict[str, bytes] = {}
        joined, apart, size = [], [], 0
        for c in new:
            if c[0] == " " and not c[-1].isspace():
                joined.append(c)
                size += len(c)
                if size >= PIECE:
                    self.encode_joined(joined, found)
                    joined, size = [], 0
            else:
                apart.append(c)
        self.encode_joined(joined, found)
        self.encode_apart(apart, found)
        return found

    def encode_apart(self, some: list[str], found: dict[str, bytes]) -> None:
        for at in range(0, len(some), 1_000):
            part = some[at:at + 1_000]
            for c, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                found[c] = np.array(e.ids, "<u4").tobytes()

    def encode_joined(self, some: list[str], found: dict[str, bytes]) -> None:
        if not some:
            return
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<u4")
        _, ends = self.byte_spans(ids)
        stops = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in some])
        cuts = np.searchsorted(ends, stops) + 1
        if cuts[-1] != len(ids) or not np.array_equal(ends[cuts - 1], stops):
            return self.encode_apart(some, found)  # a token across two chunks: a pattern that does not split there
        raw, start = ids.tobytes(), 0
        for c, stop in zip(some, (4 * cuts).tolist(), strict=True):
            found[c], start = raw[start:stop], stop

    def decode(self, ids, piece: int = 1 << 20) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.pieces):
            raise ValueError("an id is outside the vocabulary")
        return b"".join(b"".join(self.by_id[ids[at:at + piece]].tolist()) for at in range(0, len(ids), piece))

    def byte_spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end byte of each token in the text."""
        ends = np.cumsum(self.sizes[ids]) if len(ids) else np.zeros(0, np.int64)
        return ends - (self.sizes[ids] if len(ids) else 0), ends


def chunks(text: str) -> list[str]:
    """The text cut before single spaces between two non-space characters, where a match always starts."""
    if not text:
        return []
    first, *rest = CUT.split(text) if NOT_SINGLE.search(text) else text.split(" ")
    return [first, *(" " + x for x in rest)]


def char_spans(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character that each byte span touches; a split character belongs to all its tokens."""
    char_of = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
    if not len(starts):
        return starts, ends
    return char_of[starts], char_of[ends - 1] + 1


def split_tokens(text: bytes, starts: np.ndarray) -> int:
    """Tokens that begin inside a character."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8)[starts] & 0xC0) == 0x80)) if len(starts) else 0


@lru_cache(maxsize=2)
def codec(spec: str) -> Codec:
    return Codec(spec)


class Shipped:
    """The serialised tokenizer as a broadcast value (its size is that of the vocabulary)."""

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        self.value = spark.sparkContext.broadcast(tokenizer_json(rank_path, pattern))

    def codec(self) -> Codec:
        return codec(self.value.value)


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", spans: bool = True,
           keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``ids`` and, if asked for, the characters each token touches: ``char_start``, ``char_end``."""
    shipped = Shipped(df.sparkSession, rank_path, pattern)
    fields = [StructField("ids", ArrayType(IntegerType()))]
    if spans:
        fields += [StructField(c, ArrayType(LongType())) for c in ("char_start", "char_end")]

    def run(batch: pa.RecordBatch) -> dict:
        own = shipped.codec()
        texts = batch.column(text).to_pylist()
        ids = own.encode(texts)
        out = {"ids": [i.astype(np.int32) for i in ids]}
        if spans:
            pairs = [char_spans((t or "").encode(), *own.byte_spans(i)) for t, i in zip(texts, ids, strict=True)]
            out |= {"char_start": [p[0] for p in pairs], "char_end": [p[1] for p in pairs]}
        return out

    return common.map_batches(df, run, fields, [text], keep)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` with ``decoded`` (bytes): the byte table reversed over ``ids``."""
    shipped = Shipped(df.sparkSession, rank_path, pattern)

    def run(batch: pa.RecordBatch) -> dict:
        own = shipped.codec()
        return {"decoded": [own.decode(i or []) for i in batch.column(ids).to_pylist()]}

    used = df.columns if keep is None else keep
    return common.map_batches(df, run, [StructField("decoded", BinaryType())], [ids], used)


def round_trip(df: DataFrame, rank_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode in one pass, returning digests: ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and ``n_split``:
    the tokens whose offset lies inside a character."""
    shipped = Shipped(df.sparkSession, rank_path, pattern)
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
              StructField("decoded_sha256", StringType()), StructField("n_split", LongType())]

    def run(batch: pa.RecordBatch) -> dict:
        own = shipped.codec()
        out: dict = {f.name: [] for f in fields}
        for ids in own.encode(batch.column(text).to_pylist()):
            decoded = own.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            out["n_split"].append(split_tokens(decoded, own.byte_spans(ids)[0]))
        return out

    return common.map_batches(df, run, fields, [text], keep)
