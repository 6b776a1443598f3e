"""Rows without ids, repeated rows and odd column names: samples stay bounded and results right."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postings.llm import language, toxicity, workers
from postings.llm.language import fit_languages, identify
from postings.llm.toxicity import fit_severity, grade_texts, keep_clean, labelled_sample
from postings.llm.workers import Pieces
from postings.shared import settle

ENGLISH, GERMAN = "the of and to in that it was for with".split(), "der die und das ist nicht mit auf ein zu".split()


def two_languages(n, key):
    rng = random.Random(3)
    made = []
    for i in range(n):
        lang, words = (("en", ENGLISH), ("de", GERMAN))[i % 2]
        made.append((key, " ".join(rng.choices(words, k=12)) + f" x{i}", lang))
    return made


@pytest.mark.parametrize("key", [None, 1])
def test_languages_are_learned_by_row(spark, monkeypatch, key):
    """Id 1 is not held out, and neither are rows without an id."""
    docs = spark.createDataFrame(two_languages(800, key) + [(key, "repeated die und", "de")] * 900, "doc_id long, text string, lang string")
    read = []
    map_batches = language.map_batches
    monkeypatch.setattr(language, "map_batches", lambda df, f, schema: read.append(df.groupBy("lang").count().collect()) or map_batches(df, f, schema))
    model = fit_languages(docs.repartition(5), per_language=50)
    assert {row["lang"]: row["count"] for row in read[0]} == {"en": 50, "de": 50}
    monkeypatch.undo()
    found = docs.select("text", F.col("lang").alias("given")).withColumn("doc_id", F.monotonically_increasing_id())
    found = settle(found, "numbered")
    wrong = identify(found, model).join(found, "doc_id").where("lang_pred != given")
    assert wrong.count() == 0


def test_every_language_has_a_text(spark):
    rows = [(i, f"alpha beta {i}", "big") for i in range(3000)] + [(1, "gamma delta", "small")] * 2
    model = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    assert model.languages == ["big", "small"] and "gam" in model.index


def test_many_words_are_scored_as_one_by_one(spark):
    docs = spark.createDataFrame(two_languages(200, 1) + [(1, "日本語 です", "ja")], "doc_id long, text string, lang string")
    model = fit_languages(docs)
    words = ["the", "nicht", "unknownword", "日本", "é", "a"]
    many = [np.frombuffer(found, "<f4") for found in model._packed(words)]
    for word, found in zip(words, many, strict=True):
        assert found == pytest.approx(np.frombuffer(model._word(word), "<f4"), rel=1e-6)
    model.learn(["the nicht, (nicht) the", None, "x" * 99])
    assert set(model.words) >= {"the", "nicht"}


def labelled(spark, rows, marks):
    return (
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
        spark.createDataFrame(marks, "doc_id long, toxic int"),
    )


def toxic_rows(n=60):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=30) + ["vilest"] * (3 * (i % 3 == 0)))) for i in range(n)]
    return rows, [(i, int(i % 3 == 0)) for i in range(n)]


def test_the_bound_holds_for_repeated_ids(spark):
    rows, marks = toxic_rows()
    docs, labels = labelled(spark, rows + [rows[0]] * 300 + [(3, f"text {i} of one id") for i in range(300)], marks)
    sample = labelled_sample(docs, labels, most_toxic=1, most_clean=1).collect()
    assert Counter(row["grade"] for row in sample) == {0: 1, 1: 1}
    whole = labelled_sample(docs, labels).collect()
    assert len(whole) == len({(row["doc_id"], row["text"]) for row in whole}) == 60 + 300


def test_repeated_rows_do_not_change_the_fit(spark):
    rows, marks = toxic_rows()
    models = []
    for more in ([], [rows[0]] * 200 + [rows[1]] * 50):
        docs, labels = labelled(spark, rows + more, marks)
        models.append(fit_severity(labelled_sample(docs, labels)))
    assert models[0].features == models[1].features
    assert models[0].weights == pytest.approx(models[1].weights) and models[0].thresholds == pytest.approx(models[1].thresholds)
    # Given repeated, the sample itself is as good.
    docs, labels = labelled(spark, rows, marks)
    sample = labelled_sample(docs, labels)
    assert fit_severity(sample.unionByName(sample)).weights == pytest.approx(models[0].weights)


def test_without_a_feature_nothing_is_toxic(spark):
    rng = random.Random(2)
    clean = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for i in range(56)]
    copies = [(100 + i, "only this one toxic text " * 5) for i in range(12)]
    docs, labels = labelled(spark, clean + copies, [(i, 0) for i in range(6)] + [(100 + i, 1) for i in range(12)])
    model = fit_severity(labelled_sample(docs, labels))
    assert grade_texts(docs, model).where("toxic or severity > 0.01").count() == 0
    assert keep_clean(docs, model).count() == 68


def test_columns_of_any_name_through_the_pipeline(spark):
    names = ["a.b", "rank in group", "rank", "rank_", "length", "begin", "it's", "tick`s"]
    rows = [(i, f"the {w} of the garden is green and it was good for all of them {w}", "en") for i, w in enumerate(["cat", "dog", "cat", "cow"])]
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id long, text string, lang string")
    docs = docs.withColumns({name: F.lit(name) for name in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = docs.columns
        docs = settle(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == given, name
    kept = docs.collect()
    assert sorted(row["doc_id"] for row in kept) == [0, 1, 3]
    assert all(row[name] == name for row in kept for name in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


class Model:
    def __init__(self):
        self.made = 0
        self.memory = Pieces(self.make)

    def make(self, piece):
        self.made += 1
        return piece.encode() * 3


def test_memories_share_a_budget_and_those_of_past_tasks_go(monkeypatch):
    task = [1]
    monkeypatch.setattr(workers, "MOST_BYTES", 200_000)
    monkeypatch.setattr(workers, "_task", lambda: task[0])
    one, other = Model(), Model()
    for i in range(20_000):
        assert one.memory[f"word {i}"] == f"word {i}".encode() * 3
        assert one.memory.size + sum(workers._ENTRY + 80 for _ in one.memory.older) < 260_000
    assert one.memory[f"word {19_999}"] and one.made == 20_000
    # Both are used in one task: they share what there is, and neither empties the other.
    assert other.memory["x"] == b"xxx" and one.memory[f"word {19_999}"] and one.made == 20_000
    assert one.memory.room == other.memory.room == 50_000
    one.memory["z" * 65]
    assert "z" * 65 not in one.memory
    # In the next task only the other is used: after one more, the first is empty.
    task[0] = 2
    other.memory["y"]
    assert one.memory
    task[0] = 3
    other.memory["z"]
    assert not one.memory and not one.memory.older and set(other.memory) == {"x", "y", "z"}


def _anonymous() -> int:
    with open("/proc/self/status") as status:
        return next(int(line.split()[1]) for line in status if line.startswith("RssAnon"))


def test_freed_memory_goes_back_between_slices():
    batch = pa.RecordBatch.from_pydict({"text": ["a", "b"]})
    given = workers.slices([batch], most_bytes=1)
    next(given)
    before = _anonymous()
    held = [bytes(600) for _ in range(200_000)]
    # One of the last stays, so the C library cannot cut off the end of its heap.
    last, held = held[-1], None
    next(given)
    assert len(last) == 600 and _anonymous() - before < 40_000


def test_memories_of_steps_that_are_over_go_where_a_step_remembers_nothing(monkeypatch):
    task = [1]
    monkeypatch.setattr(workers, "_task", lambda: task[0])
    memory = Pieces(str.upper)
    assert memory["a"] == "A" and len(memory) == 1
    for number, left in ((2, 1), (3, 0)):
        task[0] = number
        assert list(workers.slices([])) == [] and len(memory) == left


def test_severity_remembers_few_pieces_and_finds_all_features(monkeypatch):
    names = ["abc", "abcd*", "abcdef*", "bcde", "ghij*"]
    model = toxicity.SeverityModel({name: i for i, name in enumerate(names)}, 2.0 ** np.arange(5), np.array([1.0]))
    monkeypatch.setattr(toxicity, "MOST_PIECES", 100)
    expected = {"abc": 1, "ABCDEFG": 6, "abcd": 2, "bcde,": 8, "bcdef": 0, "ghi": 0, "ghijk-bcde": 24, "x": 0}
    for word, value in expected.items():
        assert np.isclose(model.score(word), value * np.log(2))
    model.score(" ".join(map(str, range(5000))))
    assert len(model.pieces) + len(model.pieces.older) <= 201
