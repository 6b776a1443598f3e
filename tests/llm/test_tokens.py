"""Encoding, decoding and prefix counts against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postings.llm import queries
from postings.llm.bpe import byte_pairs, decode_documents, encode_documents, own_ids
from postings.llm.token_counts import (
    longest_prefix,
    prefix_counter,
    prefix_counts,
    tokens_of_prefix,
    total_tokens,
    truncated,
)
from postings.llm.tokens import BYTE_BPE, WORD_BPE, library_ids, tokenizer_path
from postings.llm.workers import Pieces
from tests.llm import cases

PARTS = [
    "a", "b", "the", " ", "  ", "\n", " \n", "'s", "'ll", "'", "\u00e9", "\u00c9", "e\u0301", "\u03a3", "\u03c2",
    "\u0130", "\u00df", "\u4e2d", "\u56fd", "\u00a0", "\u2003", "\x1c", "\t", "\r\n", "1", "\u00b2", "\u00bd", "_", "!",
    "<|endoftext|>", "<|startoftext|>", "<|end", "\U0001f642", "\u200d", "\ud55c", "\u1112", "\u1161", "\u11ab",
    "\ufb01", "\u01c4", "x\u0304", "-", "don't", "HELLO", "ing", "tion", "\u0663", "\u00aa", "\x00", "\u0178", "\u0149",
    "\u00d7", "\u0131", "12",
]


def texts(count, seed=1, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(count)]


@pytest.fixture(scope="module", params=[BYTE_BPE, WORD_BPE])
def path(request):
    return tokenizer_path(request.param)


def test_ids_are_those_of_the_library(path):
    library, own, cached = Tokenizer.from_file(path), own_ids(path), library_ids(path)
    for text in [*texts(3000), *(text for text in cases.TEXTS if text and len(text) < 1000), "x" * 5000, "e\u0301" * 3000]:
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own(text) == ids, text
        assert cached(text) == ids, text
    assert own(None) == cached(None) == own("") == b""


def test_decoding(path):
    library, pairs = Tokenizer.from_file(path), byte_pairs(path)
    rng = random.Random(2)
    if path.endswith(BYTE_BPE):
        for _ in range(500):
            ids = [rng.randrange(50257) for _ in range(10)]
            assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for text in texts(500):
        if pairs.keeps_spaces:
            assert pairs.decode(pairs.encode(text)) == text


def test_round_trip(spark):
    path = tokenizer_path(BYTE_BPE)
    docs = cases.documents(spark).where("doc_id < 100")
    back = decode_documents(encode_documents(docs, path), path)
    found = {row["doc_id"]: row["text"] for row in back.collect()}
    assert found == {row["doc_id"]: row["text"] or "" for row in docs.collect()}
    assert encode_documents(cases.empty(spark), path).collect() == []


def test_bpe_query(spark):
    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        hashes = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded)]
        expected.append((doc, len(ids), *hashes))
    assert sorted(map(tuple, queries.QUERIES["op6_bpe"](spark, folder).collect())) == sorted(expected)


def test_counts_of_every_prefix():
    path = tokenizer_path(WORD_BPE)
    library, counter = Tokenizer.from_file(path), prefix_counter(path)

    def count(text):
        return len(library.encode(text, add_special_tokens=False).ids)

    for text in texts(1200, seed=3, longest=10):
        assert counter(text).tolist() == [count(text[:k]) for k in range(len(text) + 1)], text
    for text in ("e\u0301" * 400, "e\u0301x" * 300, "\u1112\u1161\u11ab" * 200 + "a"):
        found = counter(text)
        assert len(found) == len(text) + 1 and found[-1] == count(text)
    # Decomposed accents in a long run: exact where a character is whole.
    run = "e\u0301" * 200
    assert [counter(run)[k] for k in range(0, 401, 2)] == [count(run[:k]) for k in range(0, 401, 2)]
    assert counter(None).tolist() == counter("").tolist() == [0]


def test_counts_of_every_prefix_of_long_runs():
    path = tokenizer_path(WORD_BPE)
    library, counter = Tokenizer.from_file(path), prefix_counter(path)
    rng = np.random.default_rng(0)
    kinds = [
        ["e\u0301", "the", "o\u0308", "n"], ["\u1112\u1161\u11ab", "\u1100\u1161", "\uac00\u11a8"], ["\u304b\u3099", "\u306e", "\u30cf\u309a"],
        ["\u0130", "a", "b"], ["a\u0301", "\n", "word", "\t", "!\u0301", "'s", "'", "'re", "7", "\u0327\u0301", "!!'", "'ll", "\u3000", "\u0344", "\u09c7\u09be"],
    ]
    for kind in [*kinds, *kinds[-1:] * 3]:
        text = "".join(rng.choice(kind, 300)) + "e\u0301"
        assert len(text) > 256
        expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counter(text).tolist() == expected, text


def test_budget_questions(spark):
    path = tokenizer_path(WORD_BPE)
    library = Tokenizer.from_file(path)
    docs = cases.documents(spark).where("doc_id < 16")
    prefix = F.col("prefix_tokens")
    counts = prefix_counts(docs, path).join(docs.select("doc_id", "text"), "doc_id")
    rows = counts.select(
        "text",
        total_tokens(prefix).alias("total"),
        tokens_of_prefix(prefix, F.lit(20)).alias("first"),
        longest_prefix(prefix, 5).alias("fits"),
        truncated(F.col("text"), prefix, 5).alias("cut"),
        longest_prefix(prefix, 10**9).alias("all"),
    ).collect()
    for row in rows:
        text = row["text"] or ""
        sizes = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(min(len(text), 300) + 1)]
        assert row["total"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["first"] == sizes[min(20, len(text))]
        assert row["fits"] == max(k for k, size in enumerate(sizes) if size <= 5)
        assert (row["cut"] or "") == text[: row["fits"]] and row["all"] == len(text)


def test_count_query(spark):
    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc, text in docs:
        n = len(library.encode(text, add_special_tokens=False).ids)
        expected.append((doc, len(text.encode()), n, n > 2048))
    assert sorted(map(tuple, queries.QUERIES["op7_token_counts"](spark, folder).collect())) == sorted(expected)


def test_count_cases(spark):
    found = prefix_counts(cases.documents(spark), tokenizer_path(WORD_BPE))
    assert found.count() == cases.documents(spark).count()
    assert prefix_counts(cases.empty(spark), tokenizer_path(WORD_BPE)).collect() == []


def test_memory_of_pieces_is_bounded():
    made = []
    pieces = Pieces(lambda x: made.append(x) or x * 2, most=10, longest=3)
    for i in range(100):
        assert pieces[f"{i}"] == f"{i}" * 2
        assert pieces["1"] == "11"
    assert len(pieces) <= 10 and len(pieces.older) <= 10
    assert made.count("1") == 1, "a piece in use is carried over"
    assert pieces["long one"] == "long onelong one" and "long one" not in pieces


def test_a_piece_of_one_word_is_remembered_once():
    own_ids.cache_clear()
    byte_pairs.cache_clear()
    encode, pairs = own_ids(tokenizer_path(BYTE_BPE)), byte_pairs(tokenizer_path(BYTE_BPE))
    encode("first zyxwv twice,there")
    assert "zyxwv" in encode.pieces and " zyxwv" not in pairs.remembered
    assert " twice" in pairs.remembered


@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_a_word_with_marks_around_it_is_encoded_once(monkeypatch, name):
    made = []

    class Seen(Pieces):
        def __init__(self, make, **given):
            super().__init__(lambda piece: made.append(piece) or make(piece), **given)

    monkeypatch.setattr("postings.llm.tokens.Pieces", Seen)
    library_ids.cache_clear()
    encode, text = library_ids(tokenizer_path(name)), "a zyxwv, zyxwv.\n(zyxwv! zyxwv zyxwv's"
    ids = Tokenizer.from_file(tokenizer_path(name)).encode(text, add_special_tokens=False).ids
    library_ids.cache_clear()
    assert encode(text) == np.array(ids, "<u4").tobytes()
    assert len([piece for piece in made if piece.strip() == "zyxwv"]) <= 2 and not any("zyxwv," in piece for piece in made)


def test_a_word_with_marks_around_it_is_counted_once(monkeypatch):
    counter = prefix_counter(tokenizer_path(WORD_BPE))
    made, word = [], counter._word
    monkeypatch.setattr(counter, "_word", lambda given: made.append(given) or word(given))
    counter.pieces.forget(), counter.parts.forget()
    text = "  Uvutsrq, uvutsrq.\n\n(uvutsrq) uvutsrq's 'lluvutsrq"
    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert counter(text).tolist() == expected
    assert not counter.pieces and made.count("uvutsrq") == 1


def test_short_words_are_merged_as_long_ones(monkeypatch):
    from postings.llm import bpe

    pairs = byte_pairs(tokenizer_path(BYTE_BPE))
    words = ["aaaaaaaaa", " banananana", "lllllll", " übergrößenträger", "x", "((((()))))", " 0000000"]
    symbols = [[pairs.inner[byte] for byte in word.encode()] for word in words]
    short = [pairs.merge(given) for given in symbols]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert short == [pairs.merge(given) for given in symbols]


class CountedBytes(bytes):
    looks = 0

    def __getitem__(self, at):
        CountedBytes.looks += 1
        return super().__getitem__(at)


def test_a_prefix_is_looked_at_no_further_back_than_tokens_reach():
    counter = prefix_counter(tokenizer_path(WORD_BPE))
    word = "qzxjkvwqpzjxkqvz" * 4
    data, count, last, begins = CountedBytes(word.encode()), [0], [-1], [0]
    CountedBytes.looks = 0
    for end in range(1, len(word) + 1):
        state = counter._state(data, end, True, count, last, begins)
        assert state[3] == len(counter.pairs.encode_ordinary(word[:end]))
        for values, value in zip((count, last, begins), state, strict=False):
            values.append(value)
    assert CountedBytes.looks < 5 * len(word)
