"""Keyword rankings per municipality and overall."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.functions.stopwords import (
    EXTRA_STOP_WORDS,
    LANGUAGES,
    fixed_stop_words,
    place_words,
)
from postings.functions.text import combine, words
from postings.operators.ranking import top_list, top_n_per
from postings.schema import MUNICIPALITY
from postings.shared import settle

# The fields that words are counted in.
TEXT_COLUMNS = (
    "headline",
    "description.conditions",
    "description.text",
    "occupation.label",
    "must_have.skills.label",
    "workplace_address.region",
)


def word_counts(
    ads: DataFrame,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    languages: Sequence[str] = LANGUAGES,
    extra: Iterable[str] = EXTRA_STOP_WORDS,
    split_places: bool = False,
    tag_replacement: str = "",
    by_place: bool = True,
) -> DataFrame:
    """``municipality, word, count`` without stop words; ads without a municipality are a group.

    ``by_place=False`` counts over all ads, ``word, count``.

    The fixed stop words go before the words are counted. The place names, whose number depends on
    the data, are taken out of the counts instead of the words: that side is smaller by orders of
    magnitude, so the anti join is cheap even where it cannot be broadcast.
    """
    # explode_outer: for an inner explode Catalyst would add a filter that tokenises once more.
    tokens = (
        ads.select(
            F.col(MUNICIPALITY).alias("municipality"),
            F.explode_outer(words(combine(text_columns), tag_replacement)).alias("word"),
        )
        .where(F.col("word") != "")
        .where(~F.col("word").isin(fixed_stop_words(languages, extra)))
    )
    keys = ["municipality", "word"] if by_place else ["word"]
    counts = tokens.groupBy(*keys).agg(F.count("*").alias("count"))
    places = place_words(ads, split_places)
    return counts.join(places, "word", "left_anti").select(*keys, "count")


def keywords_per_municipality(counts: DataFrame, n: int = 10) -> DataFrame:
    """``municipality, rank, word, count``: the ``n`` most frequent words of each municipality."""
    placed = counts.where("municipality is not null")
    return top_n_per(placed, ["municipality"], [F.desc("count"), "word"], n).select(
        "municipality", "rank", "word", "count"
    )


def keywords_global(counts: DataFrame, n: int = 20) -> DataFrame:
    """``rank, word, count``: the ``n`` most frequent words over all ads, placed or not."""
    ranked = _global_list(counts, n).select(F.posexplode("top").alias("position", "entry"))
    return ranked.select((F.col("position") + 1).alias("rank"), "entry.word", "entry.count")


def keywords_report(ads: DataFrame, n: int = 10, n_global: int = 20, **options) -> DataFrame:
    """``municipality, top_words, top_10_keywords, top_20_global``, one row per municipality.

    The text is tokenised once: both rankings read the settled counts. ``options`` are those of
    ``word_counts``.
    """
    counts = settle(word_counts(ads, **options), "word-counts")
    ranked = keywords_per_municipality(counts, n)
    lists = ranked.groupBy("municipality").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "count"))).alias("ranked")
    )
    return lists.select(
        "municipality",
        F.transform(
            "ranked", lambda e: F.struct(e["word"].alias("word"), e["count"].alias("count"))
        ).alias("top_words"),
        F.array_join("ranked.word", ", ").alias("top_10_keywords"),
        _global_list(counts, n_global).scalar().alias("top_20_global"),
    )


def _global_list(counts: DataFrame, n: int) -> DataFrame:
    totals = counts.groupBy("word").agg(F.sum("count").alias("count"))
    return top_list(totals, "word", "count", n)
