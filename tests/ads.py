"""Hand-written ads."""

from postings.schema import AD_SCHEMA


def ad(
    id,
    headline=None,
    text=None,
    conditions=None,
    label=None,
    skills=None,
    municipality=None,
    region=None,
    vacancies=None,
    date=None,
):
    """A row of the schema; ``skills`` is a list of labels, or of None for a null skill."""
    skills = None if skills is None else [s if s is None else (s[0] if isinstance(s, tuple) else s,) for s in skills]
    return (id, headline, (text, conditions), (label,), (skills,), (municipality, region), vacancies, date)


def frame(spark, rows):
    return spark.createDataFrame(rows, AD_SCHEMA)


def rows(df):
    return [tuple(row) for row in df.collect()]
