"""Rank rows that are already summed, such as stores within a month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add_rank(frame: DataFrame, name: str, group: list[str], value: str, ident: str) -> DataFrame:
    """Add the place of each row in its group: largest value first, absent ones last, then id.

    One lazy window. A group is sorted in one task, so it is for rows that are sums, of
    which a group holds as many as there are ids. Rows with an absent group are a group.
    """
    window = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last(), F.col(ident).asc_nulls_last())
    return frame.withColumn(name, F.row_number().over(window))
