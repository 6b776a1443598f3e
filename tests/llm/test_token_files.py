import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postings.llm import queries
from postings.llm.token_files import SequenceReader, read_token_files, write_token_files
from postings.llm.tokens import BYTE_BPE, tokenizer_path
from postings.shared import settle
from tests.llm import cases

END = 2


def expected_rows(docs):
    library = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    rows, start = [], 0
    order = [(doc is not None, doc or 0, text is not None, (text or "").encode()) for doc, text in docs]
    for i in sorted(range(len(docs)), key=order.__getitem__):
        doc, text = docs[i]
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END], "<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def in_order(found):
    return sorted(map(tuple, found.collect()), key=lambda row: row[1])


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    assert in_order(queries.QUERIES["op10_token_files"](spark, folder)) == expected_rows([tuple(r) for r in docs.collect()])


def test_cases_in_many_files(spark, tmp_path):
    docs = cases.documents(spark)
    target, path = str(tmp_path / "files"), tokenizer_path(BYTE_BPE)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = settle(write_token_files(docs, target, path, END, length=16, file_ids=40), "manifest")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert manifest.count() > 2
    assert in_order(read_token_files(manifest, target)) == expected_rows(
        [(row["doc_id"], row["text"]) for row in docs.collect()]
    )


def test_random_access(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words, "), 7).alias("text"))
    target, path = str(tmp_path / "files"), tokenizer_path(BYTE_BPE)
    for row in settle(write_token_files(docs, target, path, END, length=32), "manifest").collect():
        reader = SequenceReader(target, row["file"])
        flat = reader.tokens(0, row["n_tokens"])
        count = -(-row["n_tokens"] // 32)
        assert reader.first[-1] == count
        for i in range(count):
            ids, mask = reader.sequence(i)
            assert len(ids) == len(mask) == 32
            assert mask.sum() == min(32, row["n_tokens"] - 32 * i)
            assert (ids[mask] == flat[32 * i : 32 * i + 32]).all()
            assert not ids[~mask].any() and ids.dtype == np.uint16
        # A sequence is a view of the file, not a copy.
        assert not reader.sequence(0)[0].flags.owndata


def test_no_rows(spark, tmp_path):
    target = str(tmp_path / "files")
    manifest = settle(write_token_files(cases.empty(spark), target, tokenizer_path(BYTE_BPE), END), "manifest")
    assert manifest.collect() == [] and read_token_files(manifest, target).collect() == []
