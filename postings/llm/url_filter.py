"""URLs allowed or blocked: by rules, and where no rule fits by two character models.

The URLs that rules decide teach two variable-order Markov models, one of allowed and one of blocked
URLs. The others are judged by the difference of the two log-likelihoods for each character, against a
threshold calibrated on decided URLs that the models have not seen. Column expressions only.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.shared import settle

#: Marks before and after every URL in the models.
BEGIN, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A host with all its subdomains, and how the path has to begin."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; without ``://`` empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    begin = F.locate("://", url)
    rest = F.substring(url, begin + 3, F.length(url))
    found = F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", group)
    return F.coalesce(F.when(begin > 0, found), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct ``rule, allow``; null where none does.

    Of rules of one length the one with the longer host is taken, and of a rule that both allows and
    blocks the block. The rules become one expression: for lists of some hundreds.
    """
    if not rules:
        return F.lit(None).cast("struct<rule: string, allow: boolean>")
    first = sorted(set(rules), key=lambda r: (-len(r.name), -len(r.host), r.name, r.allow))
    found = None
    for rule in first:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        made = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.allow).alias("allow"))
        found = F.when(fits, made) if found is None else found.when(fits, made)
    return found


def held_back(text: Column, share: int) -> Column:
    """Whether a URL is one of the ``1 / share`` that calibrate and do not teach; the URL alone decides."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % share == 0


def grams(text: Column, order: int) -> Column:
    """For each character and the end mark: that character after the ``order`` characters before it."""
    # Characters in an array: a substring would walk from the beginning of the text each time.
    inner = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("(?s)."), F.lit(0))
    marked = F.concat(F.array(*[F.lit(BEGIN)] * order), inner, F.array(F.lit(END)))

    def after(whole: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(whole) - order - 1)
        return F.transform(places, lambda i: F.concat(*[F.get(whole, i + j) for j in range(order + 1)]))

    # As the one element of an array, or it would be made again for every character.
    return F.flatten(F.transform(F.array(marked), after))


def gram_scores(counts: DataFrame, order: int, symbols: int = 256) -> DataFrame:
    """``gram, score``: ln P(allowed) - ln P(blocked) of the last character after the others, in millionths.

    ``counts`` has ``gram, a, b``: how often each is in allowed and in blocked URLs. The chance of a character
    mixes that after the longest context with that after the next shorter one (Witten and Bell): a context
    seen N times with D different successors weighs N, the shorter one D. A context never seen weighs nothing,
    so the order varies with what is known. Below the shortest all of ``symbols`` are as likely.
    """
    lower = None
    for size in range(1, order + 2):
        ending = F.substring("gram", order + 2 - size, size)
        level = counts.groupBy(ending.alias("s")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        # A context has as many rows as there are characters after it.
        context = Window.partitionBy(F.substring("s", 1, size - 1))
        level = level.select(
            "s", "a", "b",
            *[F.sum(kind).over(context).alias(f"n_{kind}") for kind in "ab"],
            *[F.count_if(F.col(kind) > 0).over(context).alias(f"d_{kind}") for kind in "ab"],
        )
        if lower is None:
            level = level.withColumns({f"q_{kind}": F.lit(1.0 / symbols) for kind in "ab"})
        else:
            shorter = lower.select(F.col("s").alias("shorter"), F.col("p_a").alias("q_a"), F.col("p_b").alias("q_b"))
            level = level.join(shorter, F.substring("s", 2, size) == F.col("shorter"))
        chances = [_mixed(kind).alias(f"p_{kind}") for kind in "ab"]
        lower = level.select("s", *chances)
    score = F.floor(1_000_000 * (F.log("p_a") - F.log("p_b")) + 0.5)
    return lower.select(F.col("s").alias("gram"), score.cast("long").alias("score"))


def _mixed(kind: str) -> Column:
    seen, n, d, q = (F.col(name) for name in (kind, f"n_{kind}", f"d_{kind}", f"q_{kind}"))
    mixed = (seen.cast("double") + d.cast("double") * q) / (n + d).cast("double")
    return F.when(n > 0, mixed).otherwise(q)


def threshold(scored: DataFrame) -> DataFrame:
    """One row ``threshold``: the ratio from which on a URL is allowed; no row where one kind is missing.

    ``scored`` has ``ratio, allow, n``. Taken is the cut with the smallest sum of the shares of allowed URLs
    below it and of blocked ones from it on; it lies amid the gap between two ratios. Of equally good cuts
    the one nearest 0, then the smaller. There are as many rows as ratios, whose range is bounded.
    """
    kinds = scored.groupBy("ratio").agg(
        F.sum(F.when(F.col("allow"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("allow"), 0).otherwise(F.col("n"))).alias("b"),
    )
    below = Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cuts = kinds.select(
        F.floor((F.col("ratio") + F.coalesce(F.lag("ratio").over(Window.orderBy("ratio")), F.col("ratio")) + 1) / 2).alias("threshold"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a_below"),
        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b_below"),
        F.sum("a").over(everything).alias("n_a"),
        F.sum("b").over(everything).alias("n_b"),
    )
    big = lambda name: F.col(name).cast("decimal(19,0)")
    wrong = big("a_below") * big("n_b") + (big("n_b") - big("b_below")) * big("n_a")
    best = cuts.where("n_a > 0 and n_b > 0").orderBy(wrong, F.abs("threshold"), "threshold")
    return best.select("threshold").limit(1)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    order: int = 4,
    held: int = 5,
) -> DataFrame:
    """``<key>, host, path, rule, verdict, ratio, threshold`` for every row.

    ``verdict`` is ``allow`` or ``block``: that of the longest rule that fits, else ``allow`` from the
    threshold on. ``ratio`` is the difference of the log-likelihoods for each character, in hundredths,
    rounded down; it is there for decided URLs too. A fifth (``held``) of the decided URLs calibrate.

    A null URL, or one without ``://``, has an empty host and path; no rule fits, and the models judge the
    empty text. Every row counts, repeated ones too. If there is no allowed or no blocked URL among those
    that calibrate, the threshold is 0, and a ratio of 0 is allowed. A table without rows gives none.

    Models and scores are tables. Equal URLs are scored once, and what joins the many rows of a frequent
    gram or URL is settled, so that Spark knows its size and splits hot keys.
    """
    found = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = rows.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select("*", found.alias("found"), F.concat("host", "path").alias("text"))
    rows = rows.select("key", "host", "path", "text", "found.rule", "found.allow")

    texts = settle(rows.groupBy("text", "allow").agg(F.count("*").alias("n")), "url-texts")
    teaches = F.when(held_back(F.col("text"), held), 0).otherwise(F.col("n"))
    counted = texts.select(
        F.explode(grams(F.col("text"), order)).alias("gram"),
        F.when(F.col("allow"), teaches).otherwise(0).alias("a"),
        F.when(~F.col("allow"), teaches).otherwise(0).alias("b"),
    )
    counts = settle(counted.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-grams")
    scores = settle(gram_scores(counts, order), "url-scores")

    spread = texts.select("text", "allow", "n", F.explode(grams(F.col("text"), order)).alias("gram"))
    summed = spread.join(scores, "gram").groupBy("text", "allow", "n")
    ratio = F.floor(F.sum("score").cast("double") / (F.count("*") * 10_000).cast("double")).cast("long")
    scored = settle(summed.agg(ratio.alias("ratio")), "url-ratios")

    calibrates = scored.where(F.col("allow").isNotNull() & held_back(F.col("text"), held))
    cut = F.coalesce(threshold(calibrates).scalar(), F.lit(0)).cast("long")
    judged = rows.join(scored.select("text", "ratio"), "text", "left").withColumn("threshold", cut)
    allowed = F.coalesce("allow", F.col("ratio") >= F.col("threshold"))
    return judged.select(
        F.col("key").alias(key), "host", "path", "rule",
        F.when(allowed, "allow").otherwise("block").alias("verdict"), "ratio", "threshold",
    )
