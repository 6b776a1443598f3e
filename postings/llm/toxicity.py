"""Severity of toxic texts by cumulative-link ordinal regression on sparse text features.

The chance that the grade of a text is k or more is a logistic function of ``w . x - theta_k``: all
thresholds share the weights, and as the thresholds are in order so are the chances. The expected
severity is the sum of these chances. Features are words and beginnings of words, which are chosen on a
bounded sample of labelled texts; a text's features are the logarithms of one plus their counts.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.workers import Pieces, map_batches, ship, slices
from postings.shared import settle

#: Labelled texts that the regression is fitted on at most: toxic ones, and others.
MOST_TOXIC, MOST_CLEAN = 2500, 5000
#: Features kept, and toxic texts (near copies counted once) that a feature has to occur in.
MOST_FEATURES, LEAST_TEXTS = 2000, 4
#: A feature is kept if it is this many times as frequent in toxic texts, as a logarithm.
LEAST_LOG_RATIO = 1.5
#: Lengths of the beginnings of words that are features beside the whole words.
BEGINNINGS = (4, 5, 6)
#: Grades above 0 that toxic texts without a grade of their own are split into.
GRADES = 3
#: Pieces of text whose features are remembered, about: few have any, and those that are rare are soon worked out.
MOST_PIECES = 100_000
#: Strength of the pull of the weights to zero, per text.
SHRINK = 1e-5

_WORD = regex.compile(r"\p{L}+")


def features_of(word: str) -> list[str]:
    """A lower-case word and its beginnings; the latter are marked as such."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class SeverityModel:
    """Weights of features, and thresholds of the grades 1, 2, ... in ascending order."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    pieces: Pieces | None = field(default=None, repr=False)
    #: All features of a word begin with its first letters, so most words are seen to have none at once.
    starts: set[str] = field(default_factory=set, repr=False)

    def _piece(self, piece: str) -> bytes:
        least, starts = BEGINNINGS[0], self.starts
        found = [
            self.features[name]
            for word in _WORD.findall(piece.lower())
            if word[:least] in starts
            for name in features_of(word)
            if name in self.features
        ]
        return np.array(found, dtype="<i4").tobytes()

    def score(self, text: str | None) -> float:
        if self.pieces is None:
            self.pieces = Pieces(self._piece, most=MOST_PIECES)
            self.starts = {name[: BEGINNINGS[0]] for name in self.features}
        found = np.frombuffer(b"".join(map(self.pieces.__getitem__, (text or "").split())), dtype="<i4")
        if not len(found):
            return 0.0
        numbers, counts = np.unique(found, return_counts=True)
        return float(self.weights[numbers] @ np.log1p(counts))

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """For each score, the chance of grade 1 or more, 2 or more, and so on."""
        return _logistic(np.asarray(scores, dtype=float)[:, None] - self.thresholds)

    def __getstate__(self):
        return {**self.__dict__, "pieces": None}


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    grades: np.ndarray,
    n_features: int,
    shrink: float = SHRINK,
    steps: int = 400,
    rate: float = 0.2,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the likeliest cumulative-link model of a sparse matrix.

    Thresholds are the first one and the logarithms of the steps to the next, so they stay in order.
    Adam on the full gradient, which is the same for every run.
    """
    top = int(grades.max())
    weights, base, gaps = np.zeros(n_features), np.array([1.0]), np.zeros(top - 1)
    params = [weights, base, gaps]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = len(grades)
    for step in range(1, steps + 1):
        thresholds = np.concatenate((base, base + np.cumsum(np.exp(gaps))))
        score = np.bincount(rows, values * weights[columns], minlength=n)
        # Edges of each text's grade: P(grade) = F(upper) - F(lower), F(x) = logistic(theta - score).
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
        lower, upper = _logistic(edges[grades] - score), _logistic(edges[grades + 1] - score)
        chance = np.maximum(upper - lower, 1e-12)
        slope_low, slope_up = lower * (1 - lower), upper * (1 - upper)
        by_score = (slope_up - slope_low) / chance / n
        by_threshold = np.zeros(top)
        for k in range(top):
            by_threshold[k] = (
                -(slope_up / chance)[grades == k].sum() + (slope_low / chance)[grades == k + 1].sum()
            ) / n
        gradients = [
            np.bincount(columns, values * by_score[rows], minlength=n_features) + shrink * weights,
            np.array([by_threshold.sum()]),
            np.array([by_threshold[k + 1 :].sum() for k in range(top - 1)]) * np.exp(gaps),
        ]
        for p, g, m, s in zip(params, gradients, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return weights, np.concatenate((base, base + np.cumsum(np.exp(gaps))))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    grade: str = "toxic",
    most_toxic: int = MOST_TOXIC,
    most_clean: int = MOST_CLEAN,
) -> DataFrame:
    """``doc_id, text, grade`` of a bounded sample of labelled texts, chosen by a hash of id and text.

    At most ``most_toxic`` and ``most_clean`` rows. Rows that repeat id and text count once; several texts under one
    labelled id are texts of their own. An id with several labels counts with the highest; null labels, ids
    and texts are left out. The sample's hashes are broadcast, which the two numbers bound.
    """
    known = labels.select(F.col(key).alias("labelled"), F.col(grade).cast("int").alias("grade"))
    known = known.where("labelled is not null and grade is not null")
    known = known.groupBy("labelled").agg(F.max("grade").alias("grade"))
    # Settled, so that the join is broadcast only where the labels are few.
    known = settle(known.select("labelled", F.greatest("grade", F.lit(0)).alias("grade")), "labels")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    rows = rows.withColumn("name", F.xxhash64("doc_id", "text", F.lit("toxicity")))
    # Ids and hashes are joined; no text moves but those of the sample.
    names = rows.select("doc_id", "name").join(known, F.col("doc_id") == F.col("labelled"))
    names = settle(names.groupBy("name").agg(F.max("grade").alias("grade")), "labelled-names")
    toxic = names.where("grade > 0").orderBy("name").limit(most_toxic)
    clean = names.where("grade <= 0").orderBy("name").limit(most_clean)
    chosen = F.broadcast(toxic.unionByName(clean))
    return rows.join(chosen, "name").dropDuplicates(["name"]).select("doc_id", "text", "grade")


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features by text, and a sketch that near copies of a text mostly share."""
    for batch in slices(batches, most_bytes=1 << 20):
        out: dict[str, list] = {name: [] for name in ("doc_id", "grade", "sketch", "feature", "n")}
        for doc, text, grade in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "grade")), strict=True):
            words = _WORD.findall(text.lower())
            sketch = min((_code(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)
            counts: dict[str, int] = {}
            for word in words:
                for name in features_of(word):
                    counts[name] = counts.get(name, 0) + 1
            out["feature"] += counts
            out["n"] += counts.values()
            out["doc_id"] += [doc] * len(counts)
            out["grade"] += [grade] * len(counts)
            out["sketch"] += [sketch] * len(counts)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int32())
        arrays = [pa.array(values, kind) for values, kind in zip(out.values(), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(out))


def _code(text: str) -> int:
    import zlib

    data = text.encode()
    return zlib.crc32(data) << 31 | zlib.adler32(data) >> 1


def fit_severity(sample: DataFrame, grades: int = GRADES) -> SeverityModel:
    """Learn from ``doc_id, text, grade``, a sample of bounded size.

    Grades 0, 1, ... are taken as they are if any is above 1. If there are only 0 and 1, toxic texts
    are graded by their number of toxic features, split at the quantiles into ``grades`` equal parts.
    Near copies of a text count once. Rows that repeat id and text count once, and different texts under one id
    are texts of their own. Without both kinds of texts, or where no feature tells them apart, the model
    gives severity 0 to all.
    """
    schema = "doc_id long, grade int, sketch long, feature string, n int"
    rows = sample.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text", F.col("grade").cast("int").alias("grade"))
    rows = rows.dropDuplicates(["doc_id", "grade"])
    counts = settle(map_batches(rows, _sample_words, schema), "toxic-counts")
    # Near copies count once, or their odd words would look toxic.
    texts = counts.select("grade", "sketch").distinct()
    kinds = {row["toxic"]: row["n"] for row in texts.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    highest = texts.agg(F.max("grade")).first()[0] or 0
    top = highest if highest > 1 else grades
    none = SeverityModel({}, np.zeros(0), np.full(top, 30.0) + np.arange(top))
    if len(kinds) < 2:
        return none
    once = counts.groupBy("feature", "sketch").agg(F.max("grade").alias("grade"))
    by_feature = once.groupBy("feature").agg(
        F.count_if(F.col("grade") > 0).alias("toxic"), F.count_if(F.col("grade") <= 0).alias("clean")
    )
    ratio = F.log((F.col("toxic") + 0.5) / (kinds[True] + 1)) - F.log((F.col("clean") + 0.5) / (kinds[False] + 1))
    chosen = (
        by_feature.withColumn("ratio", ratio)
        .where((F.col("toxic") >= LEAST_TEXTS) & (F.col("ratio") >= LEAST_LOG_RATIO))
        .orderBy(F.desc(F.col("ratio") * F.col("toxic")), "feature")
        .limit(MOST_FEATURES)
    )
    names = sorted(row["feature"] for row in chosen.select("feature").collect())
    if not names:
        return none
    features = {name: i for i, name in enumerate(names)}
    chosen = F.broadcast(sample.sparkSession.createDataFrame([(x,) for x in names], "chosen string"))
    # The texts' chosen features: a row for each text even where it has none.
    hits = counts.join(chosen, counts["feature"] == F.col("chosen"), "left").groupBy("doc_id", "grade", "sketch").agg(
        F.collect_list(F.when(F.col("chosen").isNotNull(), F.struct("feature", "n"))).alias("hits")
    )
    # Of near copies the first one: an often repeated text would move the thresholds.
    single: dict[tuple, Any] = {}
    for row in sorted(hits.collect(), key=lambda row: (row["doc_id"], row["grade"])):
        single.setdefault((row["sketch"], row["grade"]), row)
    found = list(single.values())
    lengths = [len(row["hits"]) for row in found]
    at = np.repeat(np.arange(len(found)), lengths)
    columns = np.array([features[hit["feature"]] for row in found for hit in row["hits"]], dtype=np.int64)
    values = np.log1p(np.array([hit["n"] for row in found for hit in row["hits"]], dtype=float))
    given = np.array([row["grade"] for row in found])
    if given.max() == 1 and grades > 1:
        evidence = np.array([sum(hit["n"] for hit in row["hits"]) for row in found])
        cuts = np.quantile(evidence[given > 0], np.arange(1, grades) / grades)
        given = np.where(given > 0, 1 + np.searchsorted(cuts, evidence, side="left"), 0)
    weights, thresholds = fit_ordinal(at, columns, values, given, len(features))
    return SeverityModel(features, weights, thresholds)


def grade_texts(docs: DataFrame, model: SeverityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` of every row.

    ``severity`` is the expected grade, ``grade`` the highest that is reached or exceeded with a
    chance of one half, ``toxic`` whether grade 1 is. A null text is graded as an empty one.
    """
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = np.array([known.value.score(value) for value in batch.column("text").to_pylist()])
            chances = known.value.chances(scores)
            columns = [
                pa.array(chances.sum(axis=1)),
                pa.array((chances >= 0.5).sum(axis=1).astype(np.int32)),
                pa.array(chances[:, 0]),
                pa.array(chances[:, 0] >= 0.5),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "severity", "grade", "p_toxic", "toxic"]
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, work, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not toxic."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores = np.array([known.value.score(value) for value in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(known.value.chances(scores)[:, 0] < 0.5))

    return map_batches(docs, work, docs.schema)
