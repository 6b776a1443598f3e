"""Languages of texts: scripts narrow the candidates, Viterbi labels the words.

Every word has a score in every language from its letter trigrams. The script of a word rules out the
languages that are hardly ever written in it. The labels of a text's words are the path of highest
score, where each change of language costs a penalty, so a few odd words do not break a span.
"""

import bisect
import re
import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.tokens import LETTERS, plain
from postings.llm.workers import Pieces, map_batches, ship, slices
from postings.shared import settle

UNKNOWN = "und"

#: A classifier is fitted on at most so many texts of each language, chosen by a hash of id and text.
TEXTS_PER_LANGUAGE = 2000
#: Trigrams kept of each language, the most frequent first.
MOST_TRIGRAMS = 50_000
#: Scores that are remembered of words, or held at once for the words of a slice, about: words times
#: languages. With more languages, fewer words are remembered and slices are smaller.
MOST_SCORES = 50_000_000
#: What a change of language costs, in nats.
SWITCH = 12.0
#: A language counts as written in a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01

# First code points of the ranges of Unicode blocks, and the script used there.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
    (0x1780, "Khmer"), (0x1800, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"),
    (0x3200, "Han"), (0xA000, "other"), (0xA720, "Latin"), (0xA800, "other"), (0xAB30, "Latin"),
    (0xABC0, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0x10000, "other"), (0x20000, "Han"), (0x32000, "other"),
)
_STARTS = [start for start, _ in SCRIPTS]
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# Of text that ``plain`` lets through, the runs of lower-case letters.
_LATIN_WORD = re.compile(f"[{LETTERS}]+")


def script(letter: str) -> str:
    return SCRIPTS[bisect.bisect_right(_STARTS, ord(letter)) - 1][1]


def words_of(text: str) -> Iterator[tuple[int, int, str]]:
    """Begin, end and script of every run of letters of one script."""
    for match in _WORD.finditer(text):
        begin, run = match.start(), match.group()
        if run.isascii():
            yield begin, match.end(), "Latin"
            continue
        scripts = [script(c) if c.isalpha() else None for c in run]
        first = 0
        for i in range(1, len(run) + 1):
            if i == len(run) or (scripts[i] is not None and scripts[i] != scripts[first]):
                yield begin + first, begin + i, scripts[first]
                first = i


def trigrams(word: str) -> list[str]:
    padded = f" {word.lower()} "
    return list(map("".join, zip(padded, padded[1:], padded[2:], strict=False)))


class TrigramTable:
    """Log-probabilities of trigrams by language, of which only those that a language has take room."""

    def __init__(self, unseen: np.ndarray, starts: np.ndarray, at: np.ndarray, more: np.ndarray):
        self.unseen, self.starts, self.at, self.more = unseen, starts, at, more

    def sum_of(self, rows: list[int]) -> np.ndarray:
        """The rows' scores added up; the row behind the last is that of unknown trigrams."""
        scores, starts = len(rows) * self.unseen, self.starts
        for row in rows:
            part = slice(starts[row], starts[row + 1])
            scores[self.at[part]] += self.more[part]
        return scores


    def sums_of(self, rows: list[list[int]]) -> np.ndarray:
        """``sum_of`` for many words, a row each."""
        languages = len(self.unseen)
        lengths = np.array([len(row) for row in rows], dtype=np.int64)
        flat = np.fromiter((r for row in rows for r in row), np.int64, int(lengths.sum()))
        sizes = self.starts[flat + 1] - self.starts[flat]
        ends = np.cumsum(sizes)
        entry = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[flat] - (ends - sizes), sizes)
        word = np.repeat(np.repeat(np.arange(len(rows)), lengths), sizes)
        more = np.bincount(word * languages + self.at[entry], self.more[entry], minlength=len(rows) * languages)
        return lengths[:, None] * self.unseen + more.reshape(len(rows), languages)


@dataclass
class LanguageModel:
    """Log-probabilities of trigrams by language, and the scripts of each language."""

    languages: list[str]
    index: dict[str, int]
    table: np.ndarray | TrigramTable
    scripts: dict[str, np.ndarray]
    switch: float = SWITCH
    words: Pieces | None = field(default=None, repr=False)
    pieces: Pieces | None = field(default=None, repr=False)

    def word_scores(self, word: str, kind: str) -> np.ndarray:
        """Score of a word in every language; far below all others where its script rules one out."""
        unknown, get = len(self.index), self.index.get
        rows = [get(gram, unknown) for gram in trigrams(word)]
        if isinstance(self.table, TrigramTable):
            scores = self.table.sum_of(rows)
        else:
            scores = np.add.reduce(self.table.take(rows, axis=0), axis=0)
        allowed = self.scripts.get(kind)
        if allowed is not None and not allowed.all():
            scores = np.where(allowed, scores, -1e6)
        return scores

    def _word(self, word: str) -> bytes:
        letters = len(word) if word.isalpha() else sum(map(str.isalpha, word))
        return self.word_scores(word, script(word[0])).astype("<f4").tobytes() + struct.pack("<f", letters)

    @staticmethod
    def _words(piece: str) -> list[str]:
        # The score of a word is that of its lower-case form, and words share pieces' punctuation.
        if plain(piece):
            return _LATIN_WORD.findall(piece.lower())
        return [piece[begin:end] for begin, end, _ in words_of(piece)]

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self._words(piece)))

    def _remember(self) -> None:
        if self.pieces is None:
            most = min(500_000, max(1_000, MOST_SCORES // max(1, len(self.languages))))
            self.words, self.pieces = Pieces(self._word, most=most), Pieces(self._piece, most=most)

    def learn(self, texts: list[str | None], at_once: int = 20_000) -> None:
        """Score the words of texts that are not remembered, many in one go."""
        self._remember()
        if not isinstance(self.table, TrigramTable):
            return
        pieces: set[str] = set()
        for text in texts:
            pieces.update((text or "").split())
        new = [p for p in pieces if p not in self.pieces and p not in self.pieces.older]
        known, older, longest = self.words, self.words.older, self.words.longest
        words = list({w for p in new for w in self._words(p) if len(w) <= longest and w not in known and w not in older})
        step = max(1, min(at_once, MOST_SCORES // max(1, 8 * len(self.languages))))
        for begin in range(0, len(words), step):
            part = words[begin : begin + step]
            for word, found in zip(part, self._packed(part), strict=True):
                self.words.keep(word, found)

    def _packed(self, words: list[str]) -> Iterator[bytes]:
        """What ``_word`` gives, for many words."""
        unknown, get = len(self.index), self.index.get
        rows = [[get(gram, unknown) for gram in trigrams(word)] for word in words]
        scores = self.table.sums_of(rows)
        letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], dtype="<f4")
        kinds = [self.scripts.get(script(word[0])) for word in words]
        for i, allowed in enumerate(kinds):
            if allowed is not None and not allowed.all():
                scores[i, ~allowed] = -1e6
        packed = np.concatenate([scores.astype("<f4"), letters[:, None]], axis=1)
        return map(bytes, packed)

    def text_scores(self, text: str) -> np.ndarray:
        """A row per word of the text: its scores, then its letters."""
        self._remember()
        joined = b"".join(map(self.pieces.__getitem__, text.split()))
        return np.frombuffer(joined, dtype="<f4").reshape(-1, len(self.languages) + 1)

    def slice_bytes(self) -> int:
        """Bytes of text whose words are scored at once."""
        return min(8 << 20, max(1 << 16, 6 * MOST_SCORES // max(1, len(self.languages))))

    def __getstate__(self):
        return {**self.__dict__, "words": None, "pieces": None}


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word, for texts one after another with so many words each.

    All texts of a batch go word by word at once, the longest first, so that those that still have
    words are the first rows. Staying is preferred to an equal change, and the first of equal labels.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    longest = int(sorted_lengths[0]) if len(lengths) else 0
    labels = scores.shape[1]
    # How many texts have a word at each place.
    active = np.searchsorted(-sorted_lengths, -np.arange(longest), side="left")
    kind = np.int16 if labels < 1 << 15 else np.int32
    came = np.zeros((len(scores), labels), dtype=kind)
    own = np.arange(labels, dtype=kind)
    value = np.zeros((len(lengths), labels))
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        if t == 0:
            value[:n] = scores[at]
            continue
        now = value[:n]
        best = now.argmax(axis=1)
        changed = now[np.arange(n), best] - switch
        change = changed[:, None] > now
        came[at] = np.where(change, best[:, None], own)
        value[:n] = np.where(change, changed[:, None], now) + scores[at]
    state = value.argmax(axis=1)
    path = np.zeros(len(scores), dtype=np.int64)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = came[at, state[:n]]
    return path


def label_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and its share of the letters, for each text."""
    count = len(model.languages)
    if not count:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    model.learn(texts)
    # Grown in place: the texts' rows and their concatenation would be there at once.
    grown, sizes = bytearray(), []
    for text in texts:
        row = model.text_scores(text or "")
        grown += row.tobytes()
        sizes.append(len(row))
    lengths = np.array(sizes, dtype=np.int64)
    joined = np.frombuffer(grown, dtype="<f4").reshape(-1, count + 1)
    path = viterbi(joined[:, :count], lengths, model.switch)
    text_of = np.repeat(np.arange(len(texts)), lengths)
    letters = np.bincount(text_of * count + path, weights=joined[:, count], minlength=len(texts) * count)
    letters = letters.reshape(len(texts), count)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    share = letters[np.arange(len(texts)), best] / np.maximum(total, 1)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, total, strict=True)]
    return names, [float(s) for s in share]


def text_spans(model: LanguageModel, text: str | None) -> list[tuple[int, int, str]]:
    """Begin, end and language of each run of words of one language in a text."""
    words = list(words_of(text or ""))
    if not words or not model.languages:
        return []
    scores = np.array([model.word_scores(text[begin:end], kind) for begin, end, kind in words])
    path = viterbi(scores, np.array([len(words)]), model.switch)
    spans: list[tuple[int, int, str]] = []
    for (begin, end, _), label in zip(words, path, strict=True):
        name = model.languages[label]
        if spans and spans[-1][2] == name:
            spans[-1] = (spans[-1][0], end, name)
        else:
            spans.append((begin, end, name))
    return spans


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit_languages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = TEXTS_PER_LANGUAGE,
    switch: float = SWITCH,
    most_trigrams: int | None = MOST_TRIGRAMS,
) -> LanguageModel:
    """Learn from the texts that have a language and are not held out.

    Of each language at most ``per_language`` whole texts are read, those whose id and text have the smallest
    hash; rows that repeat both count once, and texts without an id or under one id are as likely as others.
    Every language that occurs is learned. Only sums per script, and of the ``most_trigrams`` most frequent
    trigrams of each language (all of its sample for ``None``), reach the driver.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text", F.lit("language")).alias("name"))
    sizes = settle(rows.groupBy("lang").agg(F.approx_count_distinct("name").alias("texts")), "languages")
    languages = sorted(row["lang"] for row in sizes.select("lang").collect())
    if not languages:
        return LanguageModel([], {}, np.zeros((1, 0)), {}, switch)
    # A row per language, as the model has too. About three times as many as are wanted come near.
    rows = rows.join(F.broadcast(sizes), "lang")
    share = F.least(F.lit(1.0), F.lit(3.0 * per_language) / F.col("texts"))
    near = (F.pmod("name", F.lit(1 << 30)) / float(1 << 30)) < share
    once = rows.where(near).groupBy("lang", "name").agg(F.first("text").alias("text"))
    once = once.withColumn("place", F.expr("row_number() over (partition by lang order by pmod(name, 1073741824), name)"))
    sample = once.where(F.col("place") <= per_language).select("lang", "text")
    counts = map_batches(sample, _count_trigrams, "lang string, kind string, item string, n long")
    counts = counts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    if most_trigrams is not None:
        # The trigrams of a bounded sample.
        rank = F.expr("row_number() over (partition by lang, kind order by n desc, item)")
        counts = counts.withColumn("rank", rank).where(F.col("rank") <= most_trigrams)
    found = counts.select("lang", "kind", "item", "n").toArrow()
    return _model(languages, found, switch)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, str, str]] = Counter()
    for batch in slices(batches):
        seen: Counter[tuple[str, str, str]] = Counter()
        for name, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for begin, end, kind in words_of(text or ""):
                seen[name, kind, text[begin:end].lower()] += 1
        for (name, kind, word), n in seen.items():
            counts[name, "script", kind] += n * sum(map(str.isalpha, word))
            for gram in trigrams(word):
                counts[name, "trigram", gram] += n
    if counts:
        names, kinds, items = zip(*counts, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(kinds), pa.array(items), pa.array(list(counts.values()), pa.int64())],
            ["lang", "kind", "item", "n"],
        )


def _model(languages: list[str], found: pa.Table, switch: float) -> LanguageModel:
    at = {name: i for i, name in enumerate(languages)}
    grams = found.filter(pc.equal(found["kind"], "trigram"))
    names = pc.unique(grams["item"]).sort()
    row = pc.index_in(grams["item"], value_set=names).to_numpy().astype(np.int64)
    column = pc.index_in(grams["lang"], value_set=pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    order = np.lexsort((column, row))
    n, row, column = grams["n"].to_numpy()[order], row[order], column[order]
    # Every trigram that any language has counts a tenth in each, and one more stands for unknown ones.
    total = np.log(0.1 * (len(names) + 1) + np.bincount(column, weights=n, minlength=len(languages)))
    starts = np.concatenate((np.searchsorted(row, np.arange(len(names) + 1)), [len(row)]))
    table = TrigramTable(np.log(0.1) - total, starts, column.astype(np.int32), np.log(n + 0.1) - np.log(0.1))
    letters: dict[str, np.ndarray] = {}
    for kind in found.filter(pc.equal(found["kind"], "script")).to_pylist():
        letters.setdefault(kind["item"], np.zeros(len(languages)))[at[kind["lang"]]] += kind["n"]
    total = np.maximum(sum(letters.values(), np.zeros(len(languages))), 1)
    scripts = {kind: n / total >= SCRIPT_SHARE for kind, n in letters.items()}
    scripts = {kind: allowed for kind, allowed in scripts.items() if allowed.any()}
    return LanguageModel(languages, {gram: i for i, gram in enumerate(names.to_pylist())}, table, scripts, switch)


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the language with most of the letters, and its share.

    A text that is null or has no letter is ``und`` with score 0, and so is every text where the
    model knows no language. Of equal shares the first language by name wins.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=known.value.slice_bytes()):
            names, shares = label_texts(known.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, work, "doc_id long, lang_pred string, score double")


def language_spans(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, begin, end, lang``, a row per span; places are in characters."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [text_spans(known.value, value) for value in batch.column("text").to_pylist()]
            rows = np.repeat(np.arange(len(spans)), [len(x) for x in spans])
            flat = [span for found in spans for span in found]
            columns = [pa.array([span[i] for span in flat], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), *columns], ["doc_id", "begin", "end", "lang"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, work, "doc_id long, begin long, end long, lang string")


def keep_identified(
    docs: DataFrame, model: LanguageModel, text: str = "text", least_share: float = 0.4
) -> DataFrame:
    """The rows, with all their columns, whose text is in one language for ``least_share`` of its letters.

    Texts without letters go; where the model knows no language, all others stay.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, most_bytes=known.value.slice_bytes()):
            texts = batch.column(text).to_pylist()
            if known.value.languages:
                names, shares = label_texts(known.value, texts)
                kept = [name != UNKNOWN and share >= least_share for name, share in zip(names, shares, strict=True)]
            else:
                kept = [bool(value and _WORD.search(value)) for value in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, work, docs.schema)
