"""Phrases that are more than their parts, per language: an FM-index per shard, counts added up over shards."""

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.fm_index import SEPARATOR, Intervals, ngrams
from postings.llm.workers import map_batches
from postings.shared import settle

#: Bytes of text in a shard, or one text where that has more.
SHARD = 12 << 20
#: Rows of counts that a task adds up over its shards before it sends them on.
HELD = 2_000_000
#: Words that a task of the last map has at least, about, as long as there are tasks for all cores.
TASK_WORDS = 12_000_000
#: The filters of words and of phrases of each length have 2**26 places, 8 MB, whatever the table.
BITS = 26
#: Parts that the phrases of a language are ranked in before the last ranking.
PARTS = 64
UNKNOWN = "und"

_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BYTES = bytes(
    0x0A if b in _PIECE_ENDS else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)


class Words(NamedTuple):
    """The words of a shard: ids from 1 on in text order, 0 between pieces, and the words by id - 1."""

    ids: np.ndarray
    words: pa.Array


def shard_words(texts: list[bytes]) -> Words:
    """Lower-cases A-Z, cuts at the ends of pieces and of texts, and splits pieces at blanks and tabs."""
    data = b"\n".join(texts).translate(_BYTES).replace(b"\n", b" \n ")
    listed = pc.split_pattern(pa.array([b"\n " + data + b" \n"], pa.large_binary()), pattern=b" ")
    coded = listed.flatten().dictionary_encode()
    ids, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    blank, end = (words.index(pa.scalar(mark, words.type)).as_py() for mark in (b"", b"\n"))
    # The pieces' end becomes 0, the words follow from 1 on, and what stands between two blanks goes.
    number = np.full(len(words), -1, np.int64)
    real = np.array([i for i in range(len(words)) if i not in (blank, end)], np.int64)
    number[real] = np.arange(1, len(real) + 1)
    number[end] = SEPARATOR
    ids = number[ids]
    return Words(_joined(ids[ids >= 0]), words.take(pa.array(real)))


def _joined(ids: np.ndarray) -> np.ndarray:
    """Several separators in a row as one."""
    return ids[np.concatenate([[True], (ids[1:] != SEPARATOR) | (ids[:-1] != SEPARATOR)])]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits for each word, from its bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.empty(0)
    sizes = np.diff(offsets)
    if len(words) == 0:
        return np.empty(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
    return _mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], offsets[:-1] - offsets[0]))


def _seed(lang: str) -> np.uint64:
    return word_hashes(pa.array([b"lang " + lang.encode()], pa.large_binary()))[0]


class Places:
    """A set of hashes by their first bits: it may hold more than was put in, never less."""

    def __init__(self, rows: list):
        self.bits = np.zeros(1 << (BITS - 3), np.uint8)
        for number, bits in rows:
            begin = (number - 1) * len(bits)
            self.bits[begin : begin + len(bits)] = np.frombuffer(bits, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = places(hashes)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of each language of a shard; a shard is what a task reads up to ``SHARD`` bytes."""
    texts, size = defaultdict(list), 0
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()), strict=True):
            text = text.as_py()
            if size and size + len(text) > SHARD:
                yield from texts.items()
                texts, size = defaultdict(list), 0
            texts[lang].append(text)
            size += len(text)
    yield from texts.items()


def _count_words(batches):
    """``lang, place, n``: occurrences by the place of the word's hash; without a place those of all words."""
    for lang, texts in _shards(batches):
        ids, words = shard_words(texts)
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        hashes = word_hashes(words) ^ _seed(lang)
        place = pa.array(np.concatenate([places(hashes), [0]]), pa.int64(), mask=np.arange(len(words) + 1) == len(words))
        n = pa.array(np.concatenate([counts, [counts.sum()]]))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), place, n], ["lang", "place", "n"])


class _Shard:
    """The words of a shard that may be frequent; the others end pieces."""

    def __init__(self, lang: str, texts: list[bytes], frequent: list[Places]):
        ids, words = shard_words(texts)
        hashes = word_hashes(words) ^ _seed(lang)
        keep = np.flatnonzero(frequent[0].has(hashes))
        number = np.zeros(len(words) + 1, np.int64)
        number[keep + 1] = np.arange(1, len(keep) + 1)
        self.words, self.hashes = words.take(pa.array(keep)), hashes[keep]
        self.symbols, self.frequent = len(keep) + 1, frequent
        ids = _joined(number[ids])
        self.counts = np.bincount(ids, minlength=self.symbols)[1:]
        self.ids = self.linked(ids) if len(frequent) > 1 else ids

    def linked(self, ids: np.ndarray) -> np.ndarray:
        """Only words that stand in a pair that may be frequent, cut where a pair is not."""
        both = np.flatnonzero((ids[:-1] != SEPARATOR) & (ids[1:] != SEPARATOR))
        after = np.zeros(len(ids), bool)
        after[both] = self.frequent[1].has(self.gram_hashes(np.stack([ids[both], ids[both + 1]], axis=1)))
        stays = after.copy()
        stays[1:] |= after[:-1]
        ends = np.cumsum(1 + ~after[stays])
        text = np.zeros(1 + (int(ends[-1]) if len(ends) else 0), np.int64)
        text[ends - ~after[stays]] = ids[stays]
        return text

    def gram_hashes(self, grams: np.ndarray) -> np.ndarray:
        found = self.hashes[grams[:, 0] - 1]
        for i in range(1, grams.shape[1]):
            found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + self.hashes[grams[:, i] - 1])
        return found

    def may_be_frequent(self, grams: np.ndarray) -> np.ndarray:
        """By the longest part whose places are known; the other parts were looked at before."""
        size = grams.shape[1]
        if size <= len(self.frequent):
            return self.frequent[size - 1].has(self.gram_hashes(grams))
        if size == 2:
            return np.ones(len(grams), bool)
        new = grams[:, :-1] if size % 2 == 0 else grams[:, 1:]
        return self.frequent[size - 2].has(self.gram_hashes(new))

    def ngrams(self, most: int) -> Iterator[Intervals]:
        return ngrams(self.ids, self.symbols, most, self.may_be_frequent)


def _count_places(shared: list, size: int):
    """``place, n``: occurrences of phrases of ``size`` words by the place of their hash."""

    def run(batches):
        frequent = [filters.value for filters in shared]
        for lang, texts in _shards(batches):
            shard = _Shard(lang, texts, frequent)
            *_, grams = shard.ngrams(size)
            place = places(shard.gram_hashes(grams.words))
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(grams.size)], ["place", "n"])

    return run


def _count_phrases(shared: list, most: int):
    """``lang, phrase, words, n`` of the phrases all of whose parts may be frequent."""

    def run(batches):
        frequent = [filters.value for filters in shared]
        held: list[pa.Table] = []
        for lang, texts in _shards(batches):
            held += _shard_counts(_Shard(lang, texts, frequent), lang, most)
            if sum(table.num_rows for table in held) > HELD:
                held = [_added(held)]
                if held[0].num_rows > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=100_000)
                    held = []
        if held:
            yield from _added(held).to_batches(max_chunksize=100_000)

    return run


def _shard_counts(shard: _Shard, lang: str, most: int) -> Iterator[pa.Table]:
    single = np.arange(1, shard.symbols)[:, None]
    longer = ((grams.words, grams.size) for grams in islice(shard.ngrams(most), 1, None))
    for ids, counts in chain([(single, shard.counts)], longer):
        size = ids.shape[1]
        columns = [shard.words.take(pa.array(ids[:, i] - 1)) for i in range(size)]
        phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if size > 1 else columns[0]
        yield pa.table(
            {
                "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrase), np.int64))),
                "phrase": phrase.cast(pa.binary()).cast(pa.string()),
                "words": np.full(len(phrase), size, np.int32),
                "n": counts,
            }
        )


def _added(held: list[pa.Table]) -> pa.Table:
    """The sums of the counts of several shards."""
    added = pa.concat_tables(held).group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")])
    return added.rename_columns(["lang", "phrase", "words", "n"])


def frequent_places(counts: DataFrame, least: int) -> Places:
    """The places with ``least`` occurrences or more, as 2**26 bits that pass through the driver."""
    kept = counts.groupBy("place").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place = F.col("place") + 1
    bits = kept.groupBy(F.bitmap_bucket_number(place).alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return Places(bits.collect())


class Phrases(NamedTuple):
    """``lang, phrase, words, n`` of frequent phrases, and ``lang, n`` of all words."""

    phrases: DataFrame
    totals: DataFrame


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", most: int = 4, least: int = 30
) -> Phrases:
    """The phrases of 1 to ``most`` words that occur ``least`` times or more in a language, exactly counted.

    A phrase lies within a piece; pieces end at ``. , ; : ! ?`` and at line ends, and of course at the end of a
    text. A-Z count as a-z. A null language is ``und``, together with rows that say so; a null or empty text
    has no words. Repeated rows count each. A table without rows gives none.

    As many maps over the texts as ``most``, none of which moves a text. A task indexes its texts shard by
    shard. Each map but the last counts phrases of one length more by 2**26 places of a hash: a place below
    ``least`` holds no frequent one, and no phrase with an infrequent part is frequent. The last counts
    phrases of what is left. The places only spare work. However full they are, counts are the sums over
    all shards. Every task of the last map sends a row for each phrase it has, so its tasks are made larger,
    up to ``TASK_WORDS``, where there are enough of them for the cores.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    words = map_batches(rows, _count_words, "lang string, place long, n long")
    words = words.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    words = settle(words.where(F.col("place").isNull() | (F.col("n") >= least)), "phrase-words")
    share = spark.sparkContext.broadcast
    shared = [share(frequent_places(words.where("place is not null"), least))]
    for size in range(2, most):
        counts = map_batches(rows, _count_places(shared, size), "place long, n long")
        shared.append(share(frequent_places(counts, least)))
    totals = words.where("place is null").select("lang", "n")
    tasks = (totals.agg(F.sum("n")).first()[0] or 0) // TASK_WORDS + 1
    joined = rows.coalesce(max(tasks, 2 * spark.sparkContext.defaultParallelism))
    found = map_batches(joined, _count_phrases(shared, most), "lang string, phrase string, words int, n long")
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = settle(found, "phrases")
    for filters in shared:
        filters.unpersist()
    return Phrases(found, totals)


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def with_extensions(phrases: DataFrame) -> DataFrame:
    """``phrases`` with ``to_left`` and ``to_right``: how often the phrase occurs with the word that most often
    stands before it, and after it; 0 where no longer phrase is there."""
    size = F.col("words") - 1
    inner = F.explode(
        F.array(
            F.struct(F.expr("substring_index(phrase, ' ', 1 - words)").alias("phrase"), F.lit(True).alias("left")),
            F.struct(F.expr("substring_index(phrase, ' ', words - 1)").alias("phrase"), F.lit(False).alias("left")),
        )
    )
    longer = phrases.where("words > 1").select("lang", size.alias("words"), "n", inner.alias("inner"))
    most = longer.groupBy("lang", "words", F.col("inner.phrase").alias("phrase")).agg(
        F.max(F.when(F.col("inner.left"), F.col("n"))).alias("to_left"),
        F.max(F.when(~F.col("inner.left"), F.col("n"))).alias("to_right"),
    )
    joined = phrases.join(most, ["lang", "words", "phrase"], "left")
    return joined.fillna(0, ["to_left", "to_right"])


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of the phrases of two words or more.

    ``score`` is floor(2000000 a / (l + r)) of the cut with the lowest one, the first of several; ``l`` and ``r`` are
    the occurrences of what stands before and after that cut.
    """
    cut = F.explode(F.expr("sequence(1, words - 1)")).alias("k")
    cuts = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), cut)
    cuts = cuts.withColumns(
        {
            "first": F.expr("substring_index(phrase, ' ', k)"),
            "rest": F.expr("substring_index(phrase, ' ', k - words)"),
        }
    )
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    both = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    both = both.withColumn("score", F.expr("cast(cast(a as decimal(20,0)) * 2000000bd div (cast(l as decimal(20,0)) + r) as long)"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"
    )


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    most: int = 4,
    least: int = 30,
    absorbed: int = 80,
    top: int = 2000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Candidates are the phrases of two to ``most`` words with ``a >= least`` occurrences, see ``phrase_counts``
    and ``scored``; ``n`` is the number of all words of the language. A candidate goes if a longer candidate
    that holds it has at least ``absorbed`` hundredths of its occurrences. (Then one with a single word more
    has as many, so the extensions by one word tell.) Order: score, then occurrences, both falling, then the
    bytes of the phrase.

    The phrases of a language are ranked in parts first, so that no task sorts a whole language.
    """
    counts = phrase_counts(docs, lang, text, most, least)
    longest = F.greatest("to_left", "to_right").cast("decimal(20,0)")
    # A single word has no extension that matters, and is no candidate.
    candidates = with_extensions(counts.phrases).where("words > 1")
    absorbed_ones = longest * 100 >= _exact("n") * absorbed
    stays = candidates.where(~absorbed_ones).select("lang", "phrase")
    rows = settle(scored(counts.phrases).join(stays, ["lang", "phrase"]), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    rows = rows.withColumn("rank", first).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    rows = rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return rows.join(counts.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
