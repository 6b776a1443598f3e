import random
from collections import Counter

import pytest

from postings.functions.stopwords import (
    EXTRA_STOP_WORDS,
    fixed_stop_words,
    place_words,
    stop_words,
)
from postings.operators.keywords import (
    keywords_global,
    keywords_per_municipality,
    keywords_report,
    word_counts,
)
from tests.ads import ad, frame, rows

ADS = [
    ad("1", "Kock", "kock lund stockholms kock", region="Stockholms län", municipality="Lund"),
    ad("2", "beta alfa", "alfa beta", municipality="Malmö", skills=["gamma", None, "gamma"]),
    ad("3", "fjärran", "fjärran fjärran fjärran"),
    ad("4", None, "", municipality="Malmö"),
    ad("5", "!!!", "the and och 12", municipality="Malmö"),
]


def test_fixed_stop_words():
    words = fixed_stop_words()
    assert len(EXTRA_STOP_WORDS) == 25
    assert {"i'll", "och", "the", "rekryteringsprocess"} <= set(words)
    assert words == sorted(set(words))


def test_place_words(spark):
    ads = frame(spark, [*ADS, ad("6", municipality="", region=None)])
    assert sorted(rows(place_words(ads))) == [("lund",), ("malmö",), ("stockholms län",)]
    split = place_words(ads, split_places=True)
    assert sorted(rows(split)) == [("lund",), ("län",), ("malmö",), ("stockholms",)]
    every = rows(stop_words(ads))
    assert len(every) == len(set(every)) and ("lund",) in every and ("och",) in every


def test_counts(spark):
    counts = {(m, w): n for m, w, n in rows(word_counts(frame(spark, ADS)))}
    # "län" and "lund" are stop words, "stockholms" is not: the region's name has two words.
    assert counts == {
        ("Lund", "kock"): 3,
        ("Lund", "stockholms"): 2,
        ("Malmö", "alfa"): 2,
        ("Malmö", "beta"): 2,
        ("Malmö", "gamma"): 2,
        (None, "fjärran"): 4,
    }
    assert ("Lund", "stockholms") not in {
        (m, w) for m, w, _ in rows(word_counts(frame(spark, ADS), split_places=True))
    }


def test_rankings_and_ties(spark):
    counts = word_counts(frame(spark, ADS))
    assert sorted(rows(keywords_per_municipality(counts, 2))) == [
        ("Lund", 1, "kock", 3),
        ("Lund", 2, "stockholms", 2),
        ("Malmö", 1, "alfa", 2),
        ("Malmö", 2, "beta", 2),
    ]
    expected = [(1, "fjärran", 4), (2, "kock", 3), (3, "alfa", 2), (4, "beta", 2)]
    assert rows(keywords_global(counts, 4)) == expected
    assert rows(keywords_global(word_counts(frame(spark, ADS), by_place=False), 4)) == expected


def test_report(spark):
    report = keywords_report(frame(spark, ADS), n_global=2)
    assert report.columns == ["municipality", "top_words", "top_10_keywords", "top_20_global"]
    found = {row["municipality"]: row for row in report.collect()}
    assert set(found) == {"Lund", "Malmö"}
    assert found["Malmö"]["top_10_keywords"] == "alfa, beta, gamma"
    assert [tuple(e) for e in found["Lund"]["top_words"]] == [("kock", 3), ("stockholms", 2)]
    assert [tuple(e) for e in found["Lund"]["top_20_global"]] == [("fjärran", 4), ("kock", 3)]


def test_report_without_places_is_empty(spark):
    assert rows(keywords_report(frame(spark, [ADS[2]]))) == []


@pytest.fixture(scope="module")
def skewed():
    """Ads of which more than a third are in one municipality, and as many share one word."""
    rng = random.Random(7)
    vocabulary = [f"ord{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    made = []
    for i in range(2000):
        place = "Hot" if rng.random() < 0.4 else rng.choice(["A", "B", "C", None])
        text = " ".join(["het"] * rng.randint(0, 3) + rng.choices(vocabulary, k=12))
        made.append(ad(str(i), text=text, municipality=place))
    return made


def brute_force(ads, stops):
    counts = {}
    for row in ads:
        place, text = row[5][0], row[2][0]
        counts.setdefault(place, Counter()).update(w for w in text.split() if w not in stops)
    return counts


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_skewed_against_brute_force(spark, skewed, threshold):
    counts = brute_force(skewed, {"hot", "a", "b", "c"})
    per_place = {
        place: sorted(words.items(), key=lambda e: (-e[1], e[0]))[:10]
        for place, words in counts.items()
        if place is not None
    }
    total = sum(counts.values(), Counter())
    overall = sorted(total.items(), key=lambda e: (-e[1], e[0]))[:20]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for partitions in (1, 7):
            report = keywords_report(frame(spark, skewed).repartition(partitions)).collect()
            assert {r["municipality"]: [tuple(e) for e in r["top_words"]] for r in report} == per_place
            assert all([tuple(e) for e in r["top_20_global"]] == overall for r in report)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicated_ads_double_the_counts(spark, skewed):
    ads = frame(spark, skewed)
    once = {(m, w): n for m, w, n in rows(word_counts(ads))}
    twice = {(m, w): n for m, w, n in rows(word_counts(ads.union(ads)))}
    assert twice == {key: 2 * n for key, n in once.items()}
