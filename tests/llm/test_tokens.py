"""Token ids against another library's encoder of the same vocabulary, and exact round trips."""

import random

import pytest

from tidelake.llm import tokens

SAMPLES = [
    "", " ", "hello world", "don't DON'T we'll I'd", "a  b   c \n\n d\t\te", "12345 abc123def", "日本語のテキスト。", "<|endoftext|> x", "é́ ﬁ ½ µ", "\x00\x07\x1c\x85\xa0x", "🚨🚨 ok", "\r\n\r\nx",
    "x" * 30_000, "ab1" * 20_000, "word " * 30_000, " " * 3_000_000, "a" + " " * 900_000 + "b", "a" + "　" * 600 + "b" + "\n" * 700, "\n" * 800 + " x", "日本" * 40_000, "!?" * 30_000, "a1 " * 9_000 + "\x1c" * 600 + "z", "Ａ" * 25_000 + " 1",
]


@pytest.fixture(scope="module")
def other():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_same_ids(other):
    encode = tokens.encoder()
    for s in SAMPLES:
        assert encode(s) == other(s), s[:20]


def test_random_long_texts(other):
    r = random.Random(3)
    encode = tokens.encoder()
    alphabet = [*"abcXYZ019 '.,;-\n\t", "  ", "é", "日", " ", "'s", " ", "\x1c", " " * 501, "\n" * 600]
    for _ in range(12):
        s = "".join(r.choice(alphabet[:-2] if r.random() < 0.999 else alphabet) for _ in range(r.choice([10, 200, 50_000])))
        assert encode(s) == other(s)


def test_pieces_join_and_ids_decode():
    encode = tokens.encoder()
    for s in SAMPLES:
        assert "".join(p for p, _ in tokens.safe_pieces(s)) == s
        assert tokens.decode(encode(s)) == s.encode()


def test_every_row_comes_out(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (1, "a b", "y"), (None, "c", None)], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, list(r.ids)) for r in tokens.encode_texts(d, "doc_id", "text").collect()), key=str)
    assert got == sorted([(1, [64, 275]), (1, [64, 275]), (2, []), (3, []), (None, [66])], key=str)
    assert tokens.encode_texts(d.limit(0), "doc_id", "text").count() == 0
    assert sorted(r.n_tokens for r in tokens.count_tokens(d, "text").collect()) == [0, 0, 1, 2, 2]
    assert sorted(r.ids for r in tokens.count_tokens(d, "text", "ids").collect()) == [0, 0, 1, 2, 2]


def test_ids_of_a_table_decode(spark):
    d = spark.createDataFrame([(i, s, None) for i, s in enumerate(SAMPLES[:20])] + [(90, None, None)], "doc_id long, text string, bytes string")
    back = {r.doc_id: bytes(r.bytes) for r in tokens.decode_ids(tokens.encode_texts(d, "doc_id", "text"), "doc_id", "ids").collect()}
    assert back == {i: s.encode() for i, s in enumerate(SAMPLES[:20])} | {90: b""}
    none = spark.createDataFrame([(1, None)], "k long, ids array<int>")
    assert [tuple(r) for r in tokens.decode_ids(none, "k", "ids").collect()] == [(1, None)]
    assert tokens.decode_ids(none.limit(0), "k", "ids").count() == 0


def test_rank_file_by_uri():
    assert tokens.encoder(f"file://{tokens.RANK_FILE}")("a b") == [64, 275]
