"""Byte-level BPE and token files against the public libraries."""

import struct
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercato.llm import bpe, queries, token_files
from mercato.session import scratch_path

RANKS = P.path(queries.BYTE_RANKS)
RAW = open(RANKS, "rb").read()
TOKEN_RANKS = bpe.read_ranks(RAW)
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RAW), special_tokens={})
WORDS = Tokenizer.from_file(P.path(queries.WORD_TOKENIZER))
WORDS.encode_special_tokens = True
WORDS_RAW = open(P.path(queries.WORD_TOKENIZER), "rb").read()

texts = st.one_of(st.text(max_size=80), st.text(alphabet="ab \n", max_size=300), st.text(alphabet="Éé's1́Σ .", max_size=60))
ROWS = [(3, "Hello world, it's 2024"), (1, None), (2, ""), (5, "a" * 30_000), (4, " \n\t "), (3, "Hello world, it's 2024"),
        (None, "no id"), (9, "<|endoftext|> é́ \x1c\x85 x"), (7, "naïve ÉTÉ ΟΔΟΣ Σ")]


def own(text):
    split, tokens = bpe._encoder(RAW, P.PATTERN)
    packed = b"".join(map(tokens, split(text)))
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(max_examples=300, deadline=None)
@given(texts)
def test_bpe_is_tiktokens(text):
    assert own(text) == TIKTOKEN.encode_ordinary(text)


def test_long_piece():
    for text in ("ab" * 20_000, " " * 9_999, "é" * 5_000):
        assert own(text) == TIKTOKEN.encode_ordinary(text)


def test_bpe_operator(docs):
    coded = bpe.decode(bpe.encode(docs(ROWS), RANKS, P.PATTERN), RANKS)
    once = bpe.round_trip(docs(ROWS), RANKS, P.PATTERN).select(*coded.columns)
    assert sorted(map(str, once.collect())) == sorted(map(str, coded.collect()))
    for row in coded.collect():
        text = row["text"] or ""
        ids = TIKTOKEN.encode_ordinary(text)
        assert bytes(row["token_ids"]) == struct.pack(f"<{len(ids)}I", *ids) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == text.encode()
    assert coded.count() == len(ROWS) and bpe.encode(docs([]), RANKS, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(texts)
def test_stretches_encode_like_the_whole_text(text):
    packed = token_files.encode_text(WORDS_RAW, text)
    assert list(struct.unpack(f"<{len(packed) // 2}H", packed)) == WORDS.encode(text, add_special_tokens=False).ids


def test_every_white_space_splits_alike():
    for sign in "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0  　​":
        text = f"ab{sign}cd {sign}é{sign}́"
        packed = token_files.encode_text(WORDS_RAW, text)
        assert list(struct.unpack(f"<{len(packed) // 2}H", packed)) == WORDS.encode(text, add_special_tokens=False).ids, repr(sign)


@pytest.mark.parametrize("length", [4, 2048])
def test_token_files(spark, docs, length):
    folder = scratch_path(spark, "test-tokens")
    index = token_files.write_token_files(docs(ROWS), folder, P.path(queries.WORD_TOKENIZER), length=length)
    read = token_files.read_checksums(index, folder).orderBy("start").collect()
    expected, start = [], 0
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = WORDS.encode(text or "", add_special_tokens=False).ids + [1]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read] == expected


def test_no_documents(spark, docs):
    folder = scratch_path(spark, "test-tokens")
    index = token_files.write_token_files(docs([]), folder, P.path(queries.WORD_TOKENIZER))
    assert token_files.read_checksums(index, folder).collect() == []


UNMODIFIED = Tokenizer.from_file(P.path(queries.WORD_TOKENIZER))


@settings(max_examples=300, deadline=None)
@given(st.one_of(texts, st.lists(st.sampled_from(
    ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "H", "J", "h", "É", "\u0331", "\u030c", "\u0301", " ", "\n", "x",
     "don't", "'s", "'S", ",", "...", "word", "The", "\u0130", "1", "_", "|>", "!", "caf\u00e9", "ok"]),
    max_size=12).map("".join)))
def test_unmodified_tokenizer(text):
    packed = token_files.encode_text(WORDS_RAW, text, names_as_text=False)
    assert list(struct.unpack(f"<{len(packed) // 2}H", packed)) == UNMODIFIED.encode(text, add_special_tokens=False).ids


def test_special_names_and_marks():
    for text in ("a <|endoftext|> b", "H\u0331 x", "J\u030c"):
        packed = token_files.encode_text(WORDS_RAW, text, names_as_text=False)
        assert list(struct.unpack(f"<{len(packed) // 2}H", packed)) == UNMODIFIED.encode(text, add_special_tokens=False).ids
    packed = token_files.encode_text(WORDS_RAW, "H\u0331 x")
    assert list(struct.unpack(f"<{len(packed) // 2}H", packed)) == WORDS.encode("H\u0331 x", add_special_tokens=False).ids


def test_query_encodes_as_the_unmodified_tokenizer(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "H\u0331 x"), (3, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    got, start = queries.all_queries()["op9_token_files"](spark, str(tmp_path)).orderBy("start").collect(), 0
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = UNMODIFIED.encode(text, add_special_tokens=False).ids + [1]
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.text(max_size=40).map(str.encode), st.text("aeinrst ", max_size=60).map(str.encode)))
def test_short_pieces_merge_as_by_the_tree(piece):
    ranks = TOKEN_RANKS
    short = bpe.SHORT_PIECE
    try:
        bpe.SHORT_PIECE = 1
        tree = bpe.merge_piece(piece, ranks)
    finally:
        bpe.SHORT_PIECE = short
    assert bpe.merge_short(piece, ranks) == bpe.merge_piece(piece, ranks) == tree


def test_a_word_needs_no_tree(monkeypatch):
    """A tree costs a word more than looking through its pairs."""
    asked = []
    monkeypatch.setattr(bpe, "merge_short", lambda piece, ranks: asked.append(piece) or [])
    bpe.merge_piece(b" unforeseeably", TOKEN_RANKS)
    assert asked == [b" unforeseeably"]
