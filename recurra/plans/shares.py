"""Shares of a total over already grouped, small results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recurra.functions.numbers import pct


def with_share(grouped: DataFrame, column: str, name: str, within: list[str] | None = None) -> DataFrame:
    """Add each row's percentage of the column's total, per ``within`` group or overall.

    Meant for report rows after aggregation; the overall total is an unpartitioned window.
    """
    total = F.sum(column).over(Window.partitionBy(*(within or [])))
    return grouped.withColumn(name, pct(F.col(column), total))
