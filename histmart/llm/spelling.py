"""Spelling variants (operator 13) by search schemes on a pair of FM-indexes.

Words are near if they differ by exactly one inserted, deleted or replaced
character. With one error, the first or the last half of the shorter word is
untouched, so a word is looked for twice: one half is matched exactly from the
word's end inwards, then the search goes on across the other half and may spend
one error. The vocabulary is written as one text, each word between delimiters,
and indexed in both directions (the text and its mirror image): a state is the
interval of suffix ranks that begin with what was matched, and one step looks
up both of its bounds. Each search starts at a delimiter and moves one way, so
it needs the index of that direction alone.

Dealing: two near words agree on the first or the last half of the shorter
one's length l. So a word is dealt by (l, half) for l = its own length and one
less: four shards, at two of which any near word is found too. Shards with more
than ``max_shard`` words are dealt anew by the same rule over the part not
known to agree, until one character is left (so a shard ends at about the
alphabet's size). A task indexes the words of its shards; a pair counts at one
shard only, the first by this order. No vocabulary is broadcast.

Forms: the near word of largest count, if it has ``ratio`` times the word's;
counts grow along forms, so following them by pointer doubling ends.

Defined cases: null text has no words; a null id reads as an empty one; repeated
rows count again; ties by code-point order; an empty table gives no rows; extra
columns are ignored; words of any length are dealt alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MIN_LENGTH = 6
LETTER, RUN = re.compile("[A-Za-zÀ-ÿ]"), re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
#: A task's counts are passed on when it holds so many words.
HELD = 300_000
#: Words in one index, about; queries searched at once.
INDEXED, AT_ONCE = 30_000, 8_000
#: No shared beginning bars a pair.
OPEN = 1 << 30


# ---- the vocabulary ----

def damaged(word: str, seed: int, every: int) -> str:
    """The word, or the word less one character, as its checksum (continuing ``seed``) says."""
    h = crc32(word.encode(), seed)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199, min_length: int = MIN_LENGTH,
               min_count: int = 5) -> DataFrame:
    """``(word, n)``: words of at least ``min_length`` characters and ``min_count`` occurrences over whole texts."""

    def pieces(text: str, size: int = 1 << 20) -> Iterator[list[str]]:
        at = 0
        while at < len(text):
            end = at + size
            while end < len(text) and LETTER.match(text, end):
                end += 1
            yield RUN.findall(text, at, end)
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for part in common.slices(batch, "text"):
                for i, t in zip(part.column("id").to_pylist(), common.encoded(part.column("text")), strict=True):
                    seed = crc32(f"{i}:".encode())
                    for words in pieces(t.lower().decode()):  # bytes: only A-Z change
                        for word, n in Counter(words).items():
                            word = damaged(word, seed, every)
                            if len(word) >= min_length:
                                held[word] += n
            if len(held) >= HELD:
                yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(common.quoted(doc_id).cast("string"), F.lit("")).alias("id"),
                       common.quoted(text).cast("string").alias("text"))
    found = common.in_batches(rows, run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- the index ----

def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; the last symbol is the smallest and unique."""
    rank, step, n = text.astype(np.int64), 1, len(text)
    while True:
        key = rank * (rank.max() + 2)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        if fresh[order[-1]] == n - 1:
            return order
        rank, step = fresh, 2 * step


class FMIndex:
    """Suffix ranks over the words, each between delimiters; states are stepped in bulk."""

    END, MARK = 0, 1  # end of the text, delimiter; letters follow

    def __init__(self, words: list[str]):
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.letters, code = np.unique(codes, return_inverse=True)
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes + 1) - sizes  # of the words, after their delimiters
        text = np.full(int(sizes.sum()) + len(words) + 2, self.MARK, np.int64)
        text[-1] = self.END
        self.word_at = np.full(len(text), -1, np.int64)  # by the delimiter before the word
        self.word_at[starts - 1] = np.arange(len(words))
        text[np.arange(len(codes)) + np.repeat(np.arange(len(words)) + 1, sizes)] = code + 2
        self.order = suffix_order(text)
        self.before = text[self.order - 1]
        self.n, self.sigma = len(text), len(self.letters) + 2
        # the ranks of one symbol, in order, follow those of smaller symbols: a search in them is C[c] + occ(c, i)
        self.keys = np.sort(self.before * self.n + np.arange(self.n))
        self.marks = tuple(int(x) for x in np.searchsorted(np.sort(text), [self.MARK, self.MARK + 1]))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with ``symbol`` set before what was matched."""
        at = symbol * self.n
        return np.searchsorted(self.keys, at + lo), np.searchsorted(self.keys, at + hi)

    def choices(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) for each letter found before a state's interval."""
        size = hi - lo
        narrow, wide = np.flatnonzero(size <= self.sigma), np.flatnonzero(size > self.sigma)
        k = size[narrow]
        state = np.repeat(narrow, k)
        symbol = self.before[np.repeat(lo[narrow] - np.cumsum(k) + k, k) + np.arange(k.sum())]
        pairs = np.unique(state * self.sigma + symbol)
        every = (wide[:, None] * self.sigma + np.arange(self.sigma)[None, :]).ravel()
        pairs = np.concatenate([pairs, every])
        state, symbol = pairs // self.sigma, pairs % self.sigma
        letter = symbol > self.MARK
        return state[letter], symbol[letter]

    def search(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed word): words at one error from the queries that share their last ``exact`` characters.

        A query's own word is never found: one error must be spent."""
        width = max(map(len, words), default=0)
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.zeros((len(words), width + 1), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        known = np.clip(np.searchsorted(self.letters, flat), 0, max(0, len(self.letters) - 1))
        codes[np.repeat(np.arange(len(words)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.where(
            self.letters[known] == flat, known + 2, self.sigma) if len(self.letters) else 0
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # a state: query, characters left to match, rank interval; ``clean`` has its error left, ``spent`` has not
        q = np.arange(len(words))
        clean = (q, sizes, np.full(len(q), self.marks[0]), np.full(len(q), self.marks[1]))
        spent = tuple(np.zeros(0, np.int64) for _ in range(4))
        while len(clean[0]) or len(spent[0]):
            new = []
            q, left, lo, hi = clean
            may = np.flatnonzero(sizes[q] - left >= exact[q])
            at, c = self.choices(lo[may], hi[may])
            at = may[at]
            nlo, nhi = self.step(c, lo[at], hi[at])
            own = codes[q[at], left[at] - 1]
            other = (left[at] > 0) & (c != own)
            new.append((q[at][other], left[at][other] - 1, nlo[other], nhi[other]))  # replaced
            new.append((q[at], left[at], nlo, nhi))  # the indexed word has one more
            drop = may[left[may] > 0]
            new.append((q[drop], left[drop] - 1, lo[drop], hi[drop]))  # the indexed word has one less
            clean, _ = self.onward(codes, clean)
            spent, ended = self.onward(codes, spent)
            found.append(ended)
            spent = tuple(np.concatenate([x, *(y[k] for y in new)]) for k, x in enumerate(spent))
            some = spent[3] > spent[2]
            spent = tuple(x[some] for x in spent)
        q, rank = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        pairs = np.unique(q * (len(self.word_at) + 1) + self.word_at[self.order[rank]])
        return pairs // (len(self.word_at) + 1), pairs % (len(self.word_at) + 1)

    def onward(self, codes: np.ndarray, states: tuple) -> tuple[tuple, tuple]:
        """States after their next character; and (query, rank) of those that stood at their word's beginning and met a delimiter."""
        q, left, lo, hi = states
        symbol = np.where(left > 0, codes[q, left - 1], self.MARK)
        lo, hi = self.step(symbol, lo, hi)
        some = hi > lo
        ends, on = some & (left == 0), some & (left > 0)
        return (q[on], left[on] - 1, lo[on], hi[on]), (q[ends], lo[ends])


# ---- dealing ----

def dealt(rows: DataFrame) -> DataFrame:
    """One level of dealing: of the ``gap`` characters not known to agree the first or the last half does.

    A row's shard: the length ``l`` of the shorter word of its pairs, the numbers ``a`` and ``b`` of first and last
    characters that agree; ``bar``: pairs with so long a common beginning count at another shard."""
    half = F.floor((F.col("l") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("bar").alias("bar"))
    last = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), F.least("bar", F.col("a") + half).alias("bar"))
    return (rows.select("word", "n", "l", F.explode(F.array(first, last)).alias("s")).select("word", "n", "l", "s.*")
            .withColumn("shard", shard_key()))


def shard_key() -> Column:
    return F.concat_ws(" ", "l", "a", "b", "bar", F.expr("substring(word, 1, a)"), F.expr("right(word, b)"))


def shards(words: DataFrame, max_shard: int) -> DataFrame:
    """``word, n, l, a, b, bar, shard``: every word at all shards where its near words are looked for."""
    size = F.length("word")
    ready = None
    rows = dealt(words.select("word", "n", F.explode(F.array(size, size - 1)).alias("l"), F.lit(0).alias("a"), F.lit(0).alias("b"),
                              F.lit(OPEN).alias("bar")))
    while True:
        rows = common.table(rows)
        large = rows.where("l - a - b > 1").groupBy("shard").agg(F.count("*").alias("m")).where(F.col("m") > max_shard)
        large = common.cut(large)
        n = large.count()
        if not n:
            return rows if ready is None else ready.unionByName(rows)
        side = F.broadcast(large.select("shard")) if n <= common.BROADCAST_ROWS else large.select("shard")
        small = rows.join(side, "shard", "left_anti").select(rows.columns)
        ready = small if ready is None else ready.unionByName(small)
        rows = dealt(rows.join(side, "shard", "left_semi").drop("shard"))


def alike_from_start(a: str, b: str) -> int:
    """Length of the common beginning."""
    k = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        k += 1
    return k


def near_of(words: list[str], counts: list[int], dealt_as: list[tuple[int, int, int, int]], min_length: int) -> Iterator[tuple]:
    """``(row, near words, best count, best word)`` of rows (a word and its shard's l, a, b, bar) with near words here."""
    vocabulary = sorted({w: n for w, n in zip(words, counts, strict=True)}.items())
    plain = [w for w, _ in vocabulary]
    for mirrored in (False, True):
        mine = [r for r, (_, a, b, _) in enumerate(dealt_as) if (a >= b) == mirrored]
        if not mine:
            continue
        turn = (lambda w: w[::-1]) if mirrored else (lambda w: w)
        index = FMIndex([turn(w) for w in plain])
        for at in range(0, len(mine), AT_ONCE):
            rows = mine[at:at + AT_ONCE]
            exact = np.array([max(dealt_as[r][1:3]) for r in rows], np.int64)
            best: dict[int, list] = {}
            for q, v in zip(*(x.tolist() for x in index.search([turn(words[r]) for r in rows], exact)), strict=True):
                row, (near, n) = rows[q], vocabulary[v]
                word, (l, a, b, bar) = words[row], dealt_as[row]
                if min(len(word), len(near)) != l or word == near:
                    continue
                start = alike_from_start(word, near)
                if start < a or start >= bar or b and word[-b:] != near[-b:]:
                    continue
                held = best.setdefault(row, [0, -1, ""])
                held[0] += 1
                if n > held[1] or n == held[1] and near < held[2]:
                    held[1:] = [n, near]
            yield from ((row, *x) for row, x in best.items())


def near_words(words: DataFrame, max_shard: int = 4096) -> DataFrame:
    """``word, n_near, form, form_n`` of every word with near words: their number, and the most frequent one."""
    rows = shards(words, max_shard)
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // INDEXED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches).to_pydict() if (batches := list(batches)) else None  # about INDEXED rows
        if not got:
            return
        found = list(near_of(got["word"], got["n"], list(zip(got["l"], got["a"], got["b"], got["bar"], strict=True)), MIN_LENGTH))
        cols = list(zip(*found, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array([got["word"][r] for r in cols[0]], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[3], pa.string()), pa.array(cols[2], pa.int64())], ["word", "n_near", "form", "form_n"])

    shard_rows = rows.repartition(tasks, "shard").select("word", "n", "l", "a", "b", "bar")
    found = common.in_batches(shard_rows, run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.form", (-F.col("best.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words with a form: the last form, by pointer doubling."""
    held = common.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        held = common.cut(held.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not held.where("moved").limit(1).count():
            return held.drop("moved")
        held = held.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199, min_length: int = MIN_LENGTH,
             min_count: int = 5, ratio: int = 5, max_shard: int = 4096) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    words = common.table(vocabulary(docs, doc_id, text, every, min_length, min_count))
    near = common.table(words.join(near_words(words, max_shard), "word", "left"))
    has = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("form")).alias("form"),
                       F.when(has, F.col("form_n")).alias("form_n"))
    ends = roots(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
