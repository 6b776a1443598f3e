import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from postings.llm import queries
from postings.llm.packing import Tournament, first_fit_decreasing, pack_documents
from postings.llm.tokens import WORD_BPE, tokenizer_path
from tests.llm import cases

END = 2


def check(docs, pieces, capacity):
    """Every id in one piece, sequences without gaps; the number of sequences."""
    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for row in pieces:
        sequences[row["sequence_id"]].append(row)
        by_doc[row["doc_id"]].append(row)
    for rows in sequences.values():
        at = 0
        for row in sorted(rows, key=lambda row: row["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert at <= capacity
    for doc, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END], "<u4")
        at = 0
        for row in sorted(by_doc[doc], key=lambda row: row["start"]):
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    return len(sequences)


def test_first_fit_decreasing():
    rng = np.random.default_rng(0)
    for _ in range(50):
        sizes = rng.integers(1, 101, size=rng.integers(0, 60))
        bins, offsets = first_fit_decreasing(sizes, 100)
        room = []
        for i in np.argsort(-sizes, kind="stable"):
            place = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            if place == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (place, 100 - room[place])
            room[place] -= sizes[i]
    with pytest.raises(ValueError):
        Tournament(1, 10).place(11)


@pytest.mark.parametrize("group_size", [50, 4000])
def test_query(spark, group_size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = pack_documents(docs, tokenizer_path(WORD_BPE), END, 4096, group_size=group_size).collect()
    given = [(row["doc_id"], row["text"]) for row in docs.collect()]
    used = check(given, found, 4096)
    assert used * 4096 < 1.1 * sum(row["length"] for row in found) + 4096 * (len(given) // group_size + 2)
    if group_size == 4000:
        query = queries.QUERIES["op8_packing"](spark, "/root/testdata/sf0.001")
        assert sorted(map(tuple, query.collect())) == sorted(map(tuple, found))


def test_cases(spark):
    docs = cases.documents(spark)
    for group_size in (4, 4000):
        found = pack_documents(docs, tokenizer_path(WORD_BPE), END, 64, group_size=group_size)
        assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        rows = found.collect()
        known = docs.where("doc_id < 100").collect()
        check([(row["doc_id"], row["text"]) for row in known], rows, 64)
        assert sum(row["doc_id"] is None and row["start"] == 0 for row in rows) == 3
        assert sum(row["doc_id"] == 100 and row["start"] == 0 for row in rows) == 3
    assert pack_documents(cases.empty(spark), tokenizer_path(WORD_BPE), END).collect() == []


def test_rows_that_repeat_id_and_text_are_spread(spark):
    docs = spark.range(400).selectExpr("7L as doc_id", "'one text' as text")
    found = pack_documents(docs, tokenizer_path(WORD_BPE), END, 64, group_size=50).collect()
    assert len(found) == 400 and len({row["sequence_id"] >> 32 for row in found}) == 8
