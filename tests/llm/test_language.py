import itertools

import numpy as np
import pytest

from postings.llm import queries
from postings.llm.language import (
    LanguageModel,
    fit_languages,
    identify,
    keep_identified,
    label_texts,
    language_spans,
    text_spans,
    viterbi,
    words_of,
)
from tests.llm import cases

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return fit_languages(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 6, 1, 5])
    scores = rng.normal(size=(lengths.sum(), 3)) * 3
    path = viterbi(scores, lengths, switch=2.0)
    begin = 0
    for n in lengths:
        own = scores[begin : begin + n]

        def value(labels, own=own):
            return sum(own[t, k] for t, k in enumerate(labels)) - 2.0 * sum(
                a != b for a, b in itertools.pairwise(labels)
            )

        best = max((value(p) for p in itertools.product(range(3), repeat=n)), default=0)
        assert value(path[begin : begin + n]) == pytest.approx(best)
        begin += n


def test_words_are_cut_where_the_script_changes():
    assert list(words_of("a1b, été日本x")) == [
        (0, 1, "Latin"), (2, 3, "Latin"), (5, 8, "Latin"), (8, 10, "Han"), (10, 11, "Latin"),
    ]


def test_scripts_narrow_the_candidates():
    table = np.zeros((1, 2))
    latin, cyrillic = np.array([True, False]), np.array([False, True])
    found = LanguageModel(["en", "ru"], {}, table, {"Latin": latin, "Cyrillic": cyrillic}, switch=1.0)
    assert label_texts(found, ["and", "и так", None, "12", ""])[0] == ["en", "ru", "und", "und", "und"]
    assert text_spans(found, "so далее ok") == [(0, 2, "en"), (3, 8, "ru"), (9, 11, "en")]


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op5_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [row for row in rows if row["held_out"]]
    assert np.mean([row["lang"] == row["lang_pred"] for row in held]) > 0.97
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_spans_of_mixed_text(model):
    english, german = "the thing of the one and the other with that ", "der die und das ist nicht mit und der "
    spans = text_spans(model, english * 3 + german * 3)
    assert [span[2] for span in spans] == ["en", "de"]
    assert abs(spans[0][1] - len(english * 3)) < 6


def test_cases(spark, model):
    docs = cases.documents(spark)
    found = identify(docs, model).collect()
    given = {(row["doc_id"], row["text"]) for row in docs.collect()}
    assert len(found) == docs.count()
    by_id = {row["doc_id"]: row for row in found if row["doc_id"] is not None}
    for doc, text in given:
        if doc is not None:
            assert (by_id[doc]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    assert language_spans(docs, model).where("doc_id = 4").first()["lang"] == "de"
    kept = keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {row["doc_id"] for row in kept.collect()} == {
        row["doc_id"] for row in found if row["lang_pred"] != "und" and row["score"] >= 0.4
    }


def test_nothing_to_learn_from(spark):
    docs = cases.documents(spark)
    none = fit_languages(cases.empty(spark))
    assert {row["lang_pred"] for row in identify(docs, none).collect()} == {"und"}
    texts = [row["text"] for row in docs.collect()]
    assert keep_identified(docs, none).count() == sum(any(c.isalpha() for c in t or "") for t in texts)
    assert identify(cases.empty(spark), none).collect() == []


def test_languages_are_no_input(spark, model):
    """Labels and ids of the texts that are labelled may change without changing a prediction."""
    docs = cases.documents(spark)
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1000)
    first, second = ({row["doc_id"]: row["lang_pred"] for row in identify(x, model).where("doc_id is not null").collect()} for x in (docs, other))
    assert {i + 1000: lang for i, lang in first.items()} == second


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrst"
    made = [(f"l{a}{b}", f"{a}{b}{a} {b}{b}{a}{a} {a}{a}{b}") for a in letters for b in letters if a < b] + [
        (f"r{a}{b}", f"z{a}{b} {a}z{b}z z{b}{a}x") for a in letters for b in letters if a < b
    ]
    rows = [(i * 4 + k, text, lang) for i, (lang, text) in enumerate(made) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs)
    learned = docs.where(~queries.held_out(docs["doc_id"])).select("lang").distinct().count()
    assert len(model.languages) == learned > 300
    found = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([row["lang"] == row["lang_pred"] for row in found if row["lang"] in model.languages]) > 0.95
