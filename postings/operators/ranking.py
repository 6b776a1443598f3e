"""Top-k with fixed tie-breaks."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in the given order, numbered from 1 in ``rank``.

    The filter lets Catalyst keep n rows per key in every input partition before the shuffle, so a
    key holding a large share of the rows costs one task no more than n rows per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def top_list(df: DataFrame, name: str, count: str, n: int) -> DataFrame:
    """One row, one column ``top``: the ``n`` largest counts as an array of (name, count).

    Only the n rows that are left after the distributed top-n are gathered.
    """
    first = top_n(df, [F.desc(count), name], n)
    entry = F.struct((-F.col(count)).alias("order"), F.col(name), F.col(count))
    return first.agg(F.sort_array(F.collect_list(entry)).alias("entries")).select(
        F.transform("entries", lambda e: F.struct(e[name].alias(name), e[count].alias(count))).alias("top")
    )
