"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

In a word, the encoding of each prefix ends in one token, and what stands before that token is the
encoding of a shorter prefix. So going through the prefixes in order it is enough to keep, for each,
the number of tokens and the last one: the next prefix ends in the one token that fits behind the
encoding of the prefix it extends. Words do not share tokens, so the counts of a text are those of its
words added up. Budget and truncation questions are answered from the counts, without encoding again.
"""

import functools
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.bpe import BytePairs, byte_pairs
from postings.llm.tokens import PLAIN_WORDS, plain
from postings.llm.workers import Pieces, map_batches, slices

#: Prefixes of words up to so many bytes are remembered, so many of them at once. Few words share longer ones.
REMEMBERED, MOST_STATES = 7, 500_000
#: The key of tokens where others are bytes.
TOKENS = -1

_SPACE = regex.compile(r"\p{White_Space}")
_LETTER = regex.compile(r"\p{L}")
#: No contraction ('s, 'll) is longer.
CONTRACTION = 3


@functools.cache
def _joining() -> frozenset[str]:
    """Characters that composition may join to the one before, besides those with a combining class."""
    found = {chr(c) for c in range(0x1161, 0x1176)} | {chr(c) for c in range(0x11A8, 0x11C3)}
    for code in range(0x80, 0x30000):
        parts = unicodedata.decomposition(chr(code))
        if parts and parts[0] != "<":
            found.update(chr(int(part, 16)) for part in parts.split()[1:])
    return frozenset(found)


@functools.cache
def _opens(character: str) -> bool:
    """Whether what stands before a character is normalised without regard to it and what follows."""
    first = unicodedata.normalize("NFD", character)[0]
    return not unicodedata.combining(first) and first not in _joining()


class _Growing:
    """The states of the prefixes of one word, to be added to at the end and cut back."""

    def __init__(self, counter: "PrefixCounts"):
        self.counter, self.data = counter, bytearray()
        self.count, self.last, self.begins = [0], [-1], [0]

    def add(self, text: str) -> None:
        for character in text:
            self.data += character.encode()
            for end in range(len(self.count), len(self.data) + 1):
                state = self.counter._state(self.data, end, False, self.count, self.last, self.begins)
                self.count.append(state[0])
                self.last.append(state[1])
                self.begins.append(state[2])

    def finished(self) -> int:
        """Tokens of the word if it ends here."""
        return self.counter._state(self.data, len(self.data), True, self.count, self.last, self.begins)[3]

    def cut(self, size: int) -> None:
        """Back to the first ``size`` bytes."""
        del self.data[size:], self.count[size + 1 :], self.last[size + 1 :], self.begins[size + 1 :]


class PrefixCounts:
    """Counts for a vocabulary with word ends, in which white space only separates words."""

    def __init__(self, pairs: BytePairs):
        if pairs.keeps_spaces:
            raise ValueError("prefix counts need a vocabulary with word ends")
        self.pairs = pairs
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        byte_of = {c: byte for byte, c in enumerate(pairs.characters)}
        for token, number in pairs.vocabulary.items():
            table = self.final if token.endswith(pairs.end) else self.inner
            table[bytes(byte_of[c] for c in token.removesuffix(pairs.end))] = number
        self.symbols = {
            **{number: [pairs.inner[b] for b in data] for data, number in self.inner.items()},
            **{
                number: [*(pairs.inner[b] for b in data[:-1]), pairs.last[data[-1]]]
                for data, number in self.final.items()
            },
        }
        # The tokens by their bytes from the last to the first. Under ``TOKENS``: inside a word, and at its end.
        self.endings: dict = {}
        for data in self.inner.keys() | self.final.keys():
            node = self.endings
            for byte in reversed(data):
                node = node.setdefault(byte, {})
            node[TOKENS] = self.inner.get(data), self.final.get(data)
        self.fits = Pieces(self._fits, longest=2)
        self.states: dict[bytes, tuple[int, int, int, int]] = {}
        self.words = Pieces(self._word)
        self.pieces = Pieces(self._piece)
        self.parts = Pieces(self._part)

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether the second token can follow the first (-1: nothing) in an encoding."""
        first, second = pair
        if first < 0:
            return self.pairs.merge(self.symbols[second]) == [second]
        return self.pairs.merge(self.symbols[first] + self.symbols[second]) == [first, second]

    def _state(
        self, data: bytes, end: int, whole: bool, count: list[int], last: list[int], begins: list[int]
    ) -> tuple[int, int, int, int]:
        """Of ``data[:end]``: tokens if the word goes on, the last one and its begin; tokens if not.

        Of the tokens that ``data[:end]`` ends in only one fits, most often one of the longest.
        """
        fits, node, ending = self.fits, self.endings, []
        for at in range(end - 1, -1, -1):
            node = node.get(data[at])
            if node is None:
                break
            if TOKENS in node:
                ending.append((at, node[TOKENS]))
        ending.reverse()
        for begin, (token, _) in ending:
            if token is not None and fits[last[begin], token]:
                break
        else:
            raise AssertionError("every byte is a token")
        if not whole:
            return count[begin] + 1, token, begin, 0
        for at, (_, closing) in ending:
            if closing is not None and fits[last[at], closing]:
                return count[begin] + 1, token, begin, count[at] + 1
        raise AssertionError("every byte is a token at the end of a word")

    def _word(self, word: str) -> list[int]:
        """Tokens of every prefix of a word, by character.

        Words share beginnings: the states of short prefixes are remembered.
        """
        data = word.encode()
        plain = len(data) == len(word)
        count, last, begins, ends = [0], [-1], [0], []
        known = self.states
        for end in range(1, len(data) + 1):
            # Whether a character ends here: the next byte does not continue one.
            whole = plain or end == len(data) or data[end] & 0xC0 != 0x80
            state = known.get(data[:end]) if end <= REMEMBERED else None
            if state is None:
                state = self._state(data, end, whole, count, last, begins)
                if end <= REMEMBERED:
                    if len(known) >= MOST_STATES:
                        known.clear()
                    known[data[:end]] = state
            count.append(state[0])
            last.append(state[1])
            begins.append(state[2])
            if whole:
                ends.append(state[3])
        return ends

    def of_normal(self, text: str) -> list[int]:
        """Tokens of every prefix of a normalised text without special tokens, by character."""
        found: list[int] = []
        total = at = 0
        words = PLAIN_WORDS.finditer if plain(text) else self.pairs.words.finditer
        for match in words(text):
            begin, word = match.start(), match.group()
            if begin > at:
                found += [total] * (begin - at)
            counts = self._contraction(word) or self.words[word]
            found += [total + count for count in counts] if total else counts
            total, at = found[-1], match.end()
        return found + [total] * (len(text) - at) if at < len(text) else found

    def _contraction(self, word: str) -> list[int] | None:
        """A prefix of 's, 'll and the like falls apart into the mark and the letters."""
        if word[0] != "'" or not word[1:].isalpha():
            return None
        return [1, *(len(self.pairs.encode_ordinary(word[:k])) for k in range(2, len(word) + 1))]

    def of_ordinary(self, text: str) -> list[int]:
        """The same for a text that is not normalised."""
        if plain(text) or text.isascii():
            return self.of_normal(text.lower())
        lowered = [c.lower() for c in text]
        if unicodedata.is_normalized("NFC", text) and all(len(c) == 1 for c in lowered):
            return self.of_normal("".join(lowered))
        found: list[int] = []
        begin = 0
        # No word and no composition goes over white space.
        for match in _SPACE.finditer(text):
            total = found[-1] if found else 0
            found += [total + c for c in self._of_composed(text[begin : match.start()])]
            found.append(found[-1] if found else 0)
            begin = match.end()
        total = found[-1] if found else 0
        return found + [total + c for c in self._of_composed(text[begin:])]

    def _of_composed(self, text: str) -> list[int]:
        """The same for a text without white space that composition may change.

        What stands before the last character that opens a new one is normalised for good. So each
        prefix is the beginning of the normalised text and a short rest. Its last word, or what the
        rest adds to it, is counted from the states at the end of that beginning.
        """
        normalise, words = self.pairs.normalise, self.pairs.words
        normal, found = normalise(text), []
        matches = [match.span() for match in words.finditer(normal)]
        before = [0]
        for begin, end in matches:
            before.append(before[-1] + self._finished(normal[begin:end]))
        at, fixed, segment = 0, 0, 0
        growing, grown = _Growing(self), matches[0][0] if matches else 0
        for k in range(len(text)):
            if k and _opens(text[k]):
                fixed += len(normalise(text[segment:k]))
                segment = k
            rest = normalise(text[segment : k + 1])
            # The word that the last fixed character is in.
            while at + 1 < len(matches) and matches[at][1] < fixed:
                at += 1
                growing, grown = _Growing(self), matches[at][0]
            begin = matches[at][0] if matches else 0
            if fixed - begin <= CONTRACTION:
                # A mark alone may be one with letters behind it that composition has not changed yet.
                first = at - 1 if at and normal[matches[at - 1][0] : begin] == "'" else at
                begin = matches[first][0] if matches else 0
                ends = words.findall(normal[begin:fixed] + rest)
                found.append(before[first] + sum(map(self._finished, ends)))
                continue
            growing.add(normal[grown:fixed])
            grown = fixed
            size = len(growing.data)
            # One character in place of the word so far, that goes on with the same ones.
            stand_in = "a" if _LETTER.match(normal[begin]) else "!"
            first, *others = words.findall(stand_in + rest)
            growing.add(first[1:])
            count = growing.finished()
            growing.cut(size)
            found.append(before[at] + count + sum(map(self._finished, others)))
        return found

    def _finished(self, word: str) -> int:
        return len(self.pairs.remembered[word])

    def of_piece(self, piece: str) -> array:
        """Tokens of every prefix of a piece, by character, and once more for the space behind it."""
        found, begin = [], 0
        for match in self.pairs.special_pattern.finditer(piece):
            total = found[-1] if found else 0
            # Short of its last character, the string of a special token is ordinary text.
            found += [total + c for c in self.of_ordinary(piece[begin : match.end() - 1])]
            before = len(self.pairs.encode_ordinary(piece[begin : match.start()]))
            found.append(total + before + 1)
            begin = match.end()
        total = found[-1] if found else 0
        found += [total + c for c in self.of_ordinary(piece[begin:])]
        found.append(found[-1] if found else 0)
        return array("i", found)

    def _piece(self, piece: str) -> bytes:
        if piece.isalpha() and plain(piece):
            counts = self.words[piece.lower()]
            return array("i", counts).tobytes() + array("i", counts[-1:]).tobytes()
        return self.of_piece(piece).tobytes()

    def _part(self, word: str) -> bytes:
        """Tokens of every prefix of a word of a plain lower-cased text."""
        return array("i", self._contraction(word) or self._word(word)).tobytes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Tokens of the prefixes of 0, 1, 2, ... characters of a text."""
        if not text:
            return np.zeros(1, dtype=np.int32)
        if plain(text) and not self.pairs.special_pattern.search(text):
            parts = list(map(self.parts.__getitem__, PLAIN_WORDS.findall(text.lower())))
            counts = np.frombuffer(b"".join([b"\0\0\0\0", *parts]), dtype=np.int32).copy()
            if parts:
                self._add_up(counts[1:], parts)
            # All but white space is in words, and white space adds nothing.
            characters = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
            places = np.zeros(len(text) + 1, dtype=np.int64)
            np.cumsum((characters != 32) & (characters != 10), out=places[1:])
            return counts[places]
        parts = list(map(self.pieces.__getitem__, text.split(" ")))
        counts = np.frombuffer(b"".join(parts), dtype=np.int32).copy()
        self._add_up(counts, parts)
        # The entry for the space behind the last piece makes room for that of the empty prefix.
        counts[1:] = counts[:-1].copy()
        counts[0] = 0
        return counts

    @staticmethod
    def _add_up(counts: np.ndarray, parts: list[bytes]) -> None:
        """Add to the counts in each part those of the parts before it."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        totals = counts[np.cumsum(lengths) - 1]
        counts += np.repeat(np.cumsum(totals, dtype=np.int32) - totals, lengths)


@functools.lru_cache(maxsize=4)
def prefix_counter(path: str) -> PrefixCounts:
    return PrefixCounts(byte_pairs(path))


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, prefix_tokens``: for each text the tokens of its prefixes.

    ``prefix_tokens`` has one entry more than the text has characters (code points): entry k is the
    number of tokens of the first k characters encoded on their own, the last that of the whole text.
    Special strings in a text count as the token they become. A null text counts as empty. Prefixes
    that end inside a character of several code points count as they are encoded, at every length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = prefix_counter(path)
        for batch in slices(batches):
            counts = [count(value) for value in batch.column("text").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in counts])))
            values = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), lists], ["doc_id", "n_bytes", "prefix_tokens"]
            )

    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    return map_batches(rows, work, "doc_id long, n_bytes long, prefix_tokens array<int>")


def total_tokens(prefix_tokens: Column) -> Column:
    return F.element_at(prefix_tokens, -1).cast("long")


def tokens_of_prefix(prefix_tokens: Column, characters: Column) -> Column:
    """Tokens of the first characters of a text; all of it if it has fewer."""
    return F.element_at(prefix_tokens, F.least(characters, F.size(prefix_tokens) - 1).cast("int") + 1)


def longest_prefix(prefix_tokens: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens.

    Counts can fall from one prefix to the next, when a letter completes a longer token; the longest
    prefix within the budget may have shorter ones that exceed it.
    """
    within = F.transform(prefix_tokens, lambda count: count <= F.lit(budget))
    return (F.size(prefix_tokens) - F.array_position(F.reverse(within), F.lit(True))).cast("int")


def truncated(text: Column, prefix_tokens: Column, budget: int) -> Column:
    return F.substring(text, F.lit(1), longest_prefix(prefix_tokens, budget))
