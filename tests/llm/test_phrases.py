import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postings.llm import phrases, queries
from postings.llm.fm_index import ngrams
from postings.llm.phrases import collocations, phrase_counts, with_extensions
from tests.compare import assert_same, duckdb_rows, spark_rows
from tests.llm import cases

SCHEMA = "lang string, text string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def counted(rows, most=4):
    found, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    found[lang or "und", tuple(words[i : i + size])] += 1
    return found, totals


def brute_force(rows, least=30, top=2000):
    found, totals = counted(rows)
    found = {key: a for key, a in found.items() if a >= least}
    kept = {}
    for (lang, words), a in found.items():
        if len(words) == 1:
            continue
        inside = lambda longer: any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))  # noqa: B023, E731
        if any(len(w) > len(words) and g == lang and 100 * b >= 80 * a and inside(w) for (g, w), b in found.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = found[lang, words[:k]], found[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = Counter()
    for lang, made in kept.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(made)[:top], 1):
            out[lang, rank, phrase.decode(), -a, left, right, totals[lang], -score] += 1
    return out


def texts(seed, n):
    rng = random.Random(seed)
    common = ["New York City", "of the", "in the end", "São Paulo", "a b a b a", "the the the the the the"]
    words = ["the", "of", "City", "x", "naïve", "Z9", "end", "a", "b"] + [f"w{i}" for i in range(300)]
    made = []
    for _ in range(n):
        parts = [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(40))]
        made.append((rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", "  ", "\t", ", ", ".\n", "\x0b", " "]) for p in parts)))
    return made


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return Counter(map(tuple, collocations(df, **options).collect()))


@pytest.mark.parametrize("shard", [200, 12 << 20])
def test_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD", shard)
    rows = texts(1, 400) + [("en", None), (None, ""), ("en", " \t\n"), ("fr", "one " * 29), ("es", "dos " * 40)]
    rows += [("long", "ab cd " * 60_000 + "y" * 70_000)] + [("en", "said here, three times in a row")] * 35
    got = found(spark, rows, top=25)
    assert got == brute_force(rows, top=25)
    assert {"en", "de", "und", "es", "long"} <= {key[0] for key in got}


def test_more_phrases_than_are_asked_for(spark):
    rows = texts(2, 300)
    whole = found(spark, rows, least=3, top=10_000)
    assert whole == brute_force(rows, least=3, top=10_000)
    assert found(spark, rows, least=3, top=7) == Counter({key: n for key, n in whole.items() if key[1] <= 7})


def test_full_filters_lose_nothing(spark, monkeypatch):
    """With one place for all hashes everything passes, and counts stay exact."""
    rows = texts(3, 200)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = {key: a for key, a in counted(rows)[0].items() if a >= 5}
    monkeypatch.setattr(phrases.Places, "has", lambda self, hashes: np.ones(len(hashes), bool))
    for name in ("filtered", "unfiltered"):
        got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in phrase_counts(df, least=5).phrases.collect()}
        assert got == expected, name
        monkeypatch.undo()


def test_extensions(spark):
    rows = texts(4, 200)
    counts = counted(rows, 4)[0]
    got = with_extensions(phrase_counts(spark.createDataFrame(rows, SCHEMA), least=4).phrases).collect()
    for row in got:
        lang, words = row["lang"], tuple(row["phrase"].split(" "))
        for name, part in (("to_left", slice(1, None)), ("to_right", slice(None, -1))):
            longer = [a for (g, w), a in counts.items() if g == lang and len(w) == len(words) + 1 and w[part] == words and a >= 4]
            assert row[name] == max(longer, default=0)


@pytest.mark.parametrize("symbols", [2, 3, 60])
def test_intervals_of_the_index(symbols):
    rng = np.random.default_rng(symbols)
    text = rng.integers(0, symbols, 3000)
    text[0] = text[-1] = 0
    for size, grams in enumerate(ngrams(text, symbols, 6), 1):
        expected = Counter(tuple(text[i : i + size]) for i in range(len(text) - size + 1) if text[i : i + size].all())
        assert Counter({tuple(w): n for w, n in zip(grams.words.tolist(), grams.size.tolist(), strict=True)}) == expected


def test_hashes_do_not_depend_on_the_slice():
    words = pa.array([b"a", b"ab", b"", b"ba", b"a" * 500], pa.large_binary())
    whole = phrases.word_hashes(words).tolist()
    assert phrases.word_hashes(words.slice(1, 1)).tolist() == whole[1:2]
    assert len(set(whole)) == 5


def test_cases_and_no_rows(spark):
    docs = cases.documents(spark).select("*", *[F.lit("c").alias(n) for n in ("phrase", "words", "n", "place", "a.b")])
    rows = [(row["lang"], row["text"]) for row in docs.collect()]
    assert Counter(map(tuple, collocations(docs, least=3).collect())) == brute_force(rows, least=3)
    assert collocations(cases.empty(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    actual = spark_rows(queries.QUERIES["op13_phrases"](spark, folder))
    assert len(actual[1]) > 200
    assert_same(actual, duckdb_rows(queries.oracles()["op13_phrases"], folder))


def test_the_last_map_sends_no_row_for_each_small_partition(spark, monkeypatch):
    """One text in each of 60 partitions: the rows sent do not grow with partitions beyond the cores'."""
    rows = [("en", "one two three four")] * 60
    docs = spark.createDataFrame(rows, SCHEMA).repartition(60)
    sent, map_batches = [], phrases.map_batches
    monkeypatch.setattr(phrases, "map_batches", lambda df, f, schema: sent.append(map_batches(df, f, schema)) or sent[-1])
    found = phrase_counts(docs)
    assert {(row["phrase"], row["n"]) for row in found.phrases.collect()} >= {("one two three four", 60), ("two", 60)}
    assert sent[-1].count() <= 10 * 2 * spark.sparkContext.defaultParallelism


def test_counts_held_by_a_task_are_added_up_before_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", 20)
    frequent = [phrases.Places([(i, b"\xff" * 4096) for i in range(1, 1 + (1 << (phrases.BITS - 15)))])]
    run = phrases._count_phrases([type("Shared", (), {"value": frequent[0]})], 2)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 40, "text": ["one two three four"] * 40})
    expected = counted([("en", "one two three four")] * 40, most=2)[0]
    for held, rows in ((25, 7), (3, None)):
        monkeypatch.setattr(phrases, "HELD", held)
        found = [tuple(row.values()) for part in run(iter([batch])) for row in part.to_pylist()]
        if rows:
            assert len(found) == rows
        total = Counter()
        for lang, phrase, _, n in found:
            total[lang, tuple(phrase.split(" "))] += n
        assert total == expected
