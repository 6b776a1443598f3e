"""Byte-pair encoding and decoding.

Encoding keeps the symbols of a word in a doubly linked list and the possible merges in a priority
queue by rank, then position. A merge changes its neighbours' pairs; entries that name a pair which is
no longer there are skipped when they come up. Decoding joins the vocabulary's strings.
"""

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.tokens import PLAIN_SPACED, PLAIN_WORDS, PieceIds, byte_characters, packed, plain
from postings.llm.workers import Pieces, map_batches, slices

# How the two kinds of vocabulary cut a text into words before merging. White space is
# Unicode's White_Space, which \s of this library is not.
BYTE_LEVEL_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WORD_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


#: Symbols of a word up to which looking at all its pairs is faster than a queue of them.
SHORT = 24
_NO_MERGE = (1 << 62, -1)


class BytePairs:
    """A vocabulary with its merges, from the tokenizers library's file format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        # White space before a word is part of it only where there are no word ends.
        self.keeps_spaces = not self.end
        self.words = regex.compile(WORD_LEVEL_WORDS if self.end else BYTE_LEVEL_WORDS)
        self.characters = byte_characters()
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            into = self.vocabulary[left + right]
            self.merges[self.vocabulary[left], self.vocabulary[right]] = (rank, into)
        self.inner = [self.vocabulary[c] for c in self.characters]
        self.last = [self.vocabulary[c + self.end] for c in self.characters]
        self.special = {token["content"]: token["id"] for token in given["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        self.strings = self._strings()
        self.remembered = Pieces(self._encode_word)

    def _strings(self) -> list[bytes]:
        """The bytes of every id."""
        byte_of = {c: byte for byte, c in enumerate(self.characters)}
        strings = [b""] * (max([*self.vocabulary.values(), *self.special.values()]) + 1)
        for token, number in self.vocabulary.items():
            inside = token.removesuffix(self.end) if self.end else token
            spaced = b" " if self.end and token.endswith(self.end) else b""
            strings[number] = bytes(byte_of[c] for c in inside) + spaced
        for token, number in self.special.items():
            strings[number] = token.encode()
        return strings

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges: lowest rank first, of equal ranks the leftmost."""
        count = len(symbols)
        if count < 2:
            return symbols
        if count <= SHORT:
            return self._merge_short(symbols)
        merges = self.merges
        queue = []
        for i in range(count - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(queue)
        symbols = list(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        while queue:
            _, i, left, right, into = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j == count or symbols[j] != right:
                continue  # stale
            symbols[i], symbols[j] = into, -1
            k = after[i] = after[j]
            if k < count:
                before[k] = i
                found = merges.get((into, symbols[k]))
                if found:
                    heapq.heappush(queue, (found[0], i, into, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], into))
                if found:
                    heapq.heappush(queue, (found[0], h, symbols[h], into, found[1]))
        return [symbol for symbol in symbols if symbol >= 0]

    def _merge_short(self, symbols: list[int]) -> list[int]:
        """The same, with a look at every pair for each merge."""
        found = self.merges.get
        symbols = list(symbols)
        pairs = [found(pair, _NO_MERGE) for pair in zip(symbols, symbols[1:], strict=False)]
        while pairs:
            lowest = min(pairs)
            if lowest is _NO_MERGE:
                break
            i, into = pairs.index(lowest), lowest[1]
            symbols[i : i + 2] = [into]
            del pairs[i]
            if i:
                pairs[i - 1] = found((symbols[i - 1], into), _NO_MERGE)
            if i < len(pairs):
                pairs[i] = found((into, symbols[i + 1]), _NO_MERGE)
        return symbols

    def _encode_word(self, word: str) -> list[int]:
        data = word.encode()
        return self.merge([*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]])

    def normalise(self, text: str) -> str:
        """Texts of vocabularies with word ends are composed (NFC) and lower-cased, letter by letter."""
        if self.keeps_spaces:
            return text
        if text.isascii():
            return text.lower()
        return "".join(c.lower() for c in unicodedata.normalize("NFC", text))

    def encode_ordinary(self, text: str, is_remembered: bool = False) -> list[int]:
        if plain(text):
            words = PLAIN_SPACED.findall(text) if self.keeps_spaces else PLAIN_WORDS.findall(text.lower())
        else:
            words = self.words.findall(self.normalise(text))
        if is_remembered and len(words) == 1:
            # Whoever asks remembers the whole text: the word need not be remembered too.
            return self._encode_word(words[0])
        found: list[int] = []
        for word in words:
            found += self.remembered[word]
        return found

    def encode(self, text: str, is_remembered: bool = False) -> list[int]:
        """The ids of a text; strings of special tokens inside it become those tokens."""
        if not self.special_pattern.search(text):
            return self.encode_ordinary(text, is_remembered)
        found, begin = [], 0
        for match in self.special_pattern.finditer(text):
            found += self.encode_ordinary(text[begin : match.start()])
            found.append(self.special[match.group()])
            begin = match.end()
        return found + self.encode_ordinary(text[begin:])

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids, special tokens included; bytes that are no UTF-8 as U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


@functools.lru_cache(maxsize=4)
def own_ids(path: str) -> PieceIds:
    pairs = byte_pairs(path)
    return PieceIds(lambda piece: packed(pairs.encode(piece, is_remembered=True)), pairs.keeps_spaces)


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` with the token ids of each whole text as an array; a null text has none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = own_ids(path)
        for batch in slices(batches):
            ids = [np.frombuffer(encode(value), "<i4") if value else [] for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, work, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` of arrays of ids; null ids give the empty text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                texts = [pairs.decode(value or []) for value in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts)], ["doc_id", "text"])

    rows = encoded.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return map_batches(rows, work, "doc_id long, text string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what encoding and decoding each text gives.

    The ids are decoded as they come out of the encoder and neither leaves the task, so no ids or
    decoded texts move. A null text counts as empty.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pairs = own_ids(path), byte_pairs(path)
        for batch in slices(batches):
            counts, ids_hashes, text_hashes = [], [], []
            for value in batch.column("text").to_pylist():
                ids = encode(value)
                decoded = pairs.decode(np.frombuffer(ids, "<u4").tolist() if ids else [])
                counts.append(len(ids) // 4)
                ids_hashes.append(hashlib.sha256(ids).hexdigest())
                text_hashes.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hashes), pa.array(text_hashes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
