"""Writing results."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from postings.sources.collections import CollectionSource, write_collection

_FILE_FORMATS = ("parquet", "json", "csv", "orc", "avro")


def save_result(
    df: DataFrame,
    name: str,
    target: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    **options: str,
) -> None:
    """Write a result under its name.

    File formats go to ``<target>/<name>``. ``fmt="collection"`` replaces a collection of documents under
    ``<target>/<database>/<name>`` once all tasks are done, see ``collections``. Any other format is that of a connector on the session's
    class path and gets the name as its ``collection`` with the options given, for example
    ``save_result(df, "vacancies", fmt="mongodb", database="...", **{"connection.uri": ...})``.
    """
    if fmt == CollectionSource.name():
        if target is None:
            raise ValueError("a collection needs a target folder")
        write_collection(df, mode, **{"uri": target, "collection": name, "database": "postings", **options})
        return
    writer = df.write.format(fmt).mode(mode)
    if fmt in _FILE_FORMATS:
        if target is None:
            raise ValueError(f"{fmt} needs a target folder")
        writer.options(**options).save(f"{target.rstrip('/')}/{name}")
    else:
        writer.options(**{"collection": name, **options}).save()


def save_csv(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column] | None = None,
    single_file: bool = False,
) -> None:
    """Write CSV with a header; quotes are doubled, nulls are empty.

    With an ``order`` the files, in the order of their names, are sorted as a whole. ``single_file``
    asks for one file, which one task writes: for results that the caller knows to be small.
    """
    if single_file:
        df = df.repartition(1)
        df = df.sortWithinPartitions(*order) if order is not None else df
    elif order is not None:
        df = df.orderBy(*order)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def save_sorted_csv(df: DataFrame, path: str) -> None:
    """Write CSV with the columns in name order."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in sorted(df.columns)]
    save_csv(df.select(*quoted), path)
