"""Columns that are computed once for each row, whatever is built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(*columns: Column) -> Column:
    """The named columns as the result of a generator.

    Spark copies a computed column into every place that names it and pushes filters on it below it,
    with a copy of the computation. What a generator makes is computed where it stands.
    """
    return F.inline(F.array(F.struct(*columns)))
