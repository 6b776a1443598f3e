"""Job titles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_title(label: Column) -> Column:
    """The part before the first comma: ``"Programmer, senior"`` becomes ``"Programmer"``."""
    return F.trim(F.split_part(label, F.lit(","), F.lit(1)))
