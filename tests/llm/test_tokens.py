import hashlib

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from histmart.llm import byte_bpe, token_counts

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "  a  b\n\n c ", "naïve 漢字 🙂🙂 ﬁ½", "it's we'll 's '", "\x00\x1c\x85 x", "<|endoftext|></s><s>[INST]",
         "a" * 5000, "word " * 3000, "tab\tand\r\nline  \n", "▁a▁▁b ▁", "it's we'll 's '"]
ODD = st.lists(st.sampled_from(list("aab thé \n\t'sll  12#€漢🙂\u0085\x1c▁") + ["the ", "'s", "ing", "  "]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Codec(byte_bpe.tokenizer_json(RANKS, PATTERN))


@given(st.one_of(ODD, st.text(max_size=60)))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_library_and_round_trips(tik, own, text):
    ids = own.encode([text])[0]
    assert ids.tolist() == tik.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_bpe_frames(spark, tik):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(docs, RANKS, PATTERN, keep=["doc_id"]).collect()}
    full = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(full) == len(TEXTS)
    for r in full:
        text = TEXTS[r["doc_id"]] or ""
        ids = tik.encode_ordinary(text)
        assert r["ids"] == ids and bytes(r["decoded"]) == text.encode()
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        for s, e, i in zip(r["char_start"], r["char_end"], ids):
            piece = tik.decode_single_token_bytes(i)
            assert s < e and piece in text[s:e].encode() and len(text[s:e].encode()) < len(piece) + 8


def test_bpe_split_characters_and_unknown_ids(own):
    ids = own.encode(["🙂漢"])[0]
    starts, ends = byte_bpe.char_spans("🙂漢".encode(), *own.byte_spans(ids))
    assert len(ids) > 2 and starts[0] == 0 and ends[-1] == 2 and (ends - starts >= 1).all()
    assert own.decode(ids[:1]) == "🙂".encode()[:len(own.decode(ids[:1]))]
    with pytest.raises(ValueError):
        own.decode([10 ** 6])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(docs, RANKS, PATTERN).count() == 0
    assert token_counts.prefix_token_counts(docs, MODEL).count() == 0


@given(ODD)
@settings(max_examples=150, deadline=None)
def test_every_prefix_count_is_exact(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = token_counts.counter(MODEL)
    counts, starts = own.prefix_counts([None, text, "", text])
    table = counts[starts[1]:starts[2]]
    assert starts.tolist() == [0, 0, len(text), len(text), 2 * len(text)] and table.tolist() == counts[starts[3]:].tolist()
    want = [len(sp.encode(text[:n])) for n in range(len(text) + 1)]
    assert [token_counts.tokens_before(table, n) for n in range(len(text) + 1)] == want
    for budget in (-1, 0, 1, 3, 7):
        assert token_counts.longest_prefix(table, budget) == max(n for n, k in enumerate(want) if k <= max(0, budget))


@pytest.mark.parametrize("splits", [True, False])
def test_runs_of_spaces_and_pieces_of_equal_rank(splits):
    """Pieces of spaces share one rank: ties go to the left. Without segments the whole text is one chain."""
    own = token_counts.Counter(MODEL)
    own.splits = splits
    for text in [" " * k + "foo" + " " * (k // 2) + "\nthe  end" for k in range(40)] + [" " * k for k in range(1, 50)]:
        counts, _ = own.prefix_counts([text])
        assert counts.tolist() == [len(own.model.encode(text[:n])) for n in range(1, len(text) + 1)]


def test_questions_need_no_model():
    """A long text without spaces: its table takes linear time; then the model is taken away."""
    text = "".join(chr(0x4E00 + 7 * k * k % 3000) for k in range(60_000)) + "abcdefgh" * 5_000 + "\U000F1234é" * 1_000
    own = token_counts.Counter(MODEL)
    counts, starts = own.prefix_counts([text])
    some = [1, 2, 17, 5_000, 59_999, 60_003, 99_998, 100_001, len(text)]
    want = [len(own.model.encode(text[:n])) for n in some]
    own.model = None
    assert [token_counts.tokens_before(counts, n) for n in some] == want and starts.tolist() == [0, len(text)]
    assert token_counts.tokens_before(counts, token_counts.longest_prefix(counts, 4096)) <= 4096 < counts[token_counts.longest_prefix(counts, 4096)]
    assert not own.memo


def test_other_models_encode_every_prefix():
    own = token_counts.Counter(MODEL)
    own.chains = own.splits = False
    text = " it's  naïve 漢🙂 "
    assert own.prefix_counts([text, "", text])[0].tolist() == 2 * [len(own.model.encode(text[:n])) for n in range(1, len(text) + 1)]


def test_token_count_frames(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens long")
    got = token_counts.prefix_token_counts(docs, MODEL, limit=1000)
    cut = {r["doc_id"]: r["within_budget"] for r in token_counts.truncate(got, 5).collect()}
    for r in got.collect():
        text = TEXTS[r["doc_id"]]
        n = len(sp.encode(text or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 1000)
        assert len(r["prefix_tokens"]) == len(text or "") and r["prefix_tokens"][-1:] == ([n] if text else [])
        assert cut[r["doc_id"]] is None if text is None else len(sp.encode(cut[r["doc_id"]])) <= 5 and text.startswith(cut[r["doc_id"]])


def test_dictionaries_are_bounded_by_bytes(own):
    """Texts without single spaces are one chunk each: none is remembered, however many there are."""
    own.memo.clear()
    own.memo_bytes = 0
    texts = [chr(0x4E00 + k) * 2000 for k in range(50)] + [" ".join(f"w{k}x{j}" for j in range(2000)) for k in range(20)]
    ids = own.encode(texts)
    assert all(own.decode(i) == t.encode() for i, t in zip(ids, texts, strict=True))
    assert 0 < own.memo_bytes <= byte_bpe.MEMO_BYTES and max(map(len, own.memo)) <= byte_bpe.SHORT
    counter = token_counts.Counter(MODEL)
    want = [len(counter.model.encode(t, num_threads=1)) for t in texts]
    for _ in range(2):
        counts, starts = counter.prefix_counts(texts)
        assert counts[starts[1:] - 1].tolist() == want
    assert 0 < counter.memo_bytes <= token_counts.MEMO_BYTES and max(map(len, counter.memo)) <= token_counts.SHORT


def test_full_dictionaries_are_cleared(own, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_BYTES", 2_000)
    monkeypatch.setattr(token_counts, "MEMO_BYTES", 2_000)
    monkeypatch.setattr(token_counts, "PAIRS", 20)
    counter = token_counts.Counter(MODEL)
    for k in range(6):
        text = " ".join(f"some{j}thing{k}" for j in range(40))
        assert own.decode(own.encode([text, text])[1]) == text.encode() and own.memo_bytes <= 2_000
        assert counter.prefix_counts([text])[0][-1] == len(counter.model.encode(text, num_threads=1)) and counter.memo_bytes <= 2_000 + 500


def test_joined_chunks_fall_back_where_a_pattern_does_not_split(tik):
    """A pattern that keeps several words together: chunks joined to one text would merge across their ends."""
    codec = byte_bpe.Codec(byte_bpe.tokenizer_json(RANKS, r"[\s\S]+"))
    new = [" of", " the", " theof", "x", " a\n", " b"]
    apart = {}
    codec.encode_apart(new, apart)
    assert codec.encode_chunks(new) == apart
