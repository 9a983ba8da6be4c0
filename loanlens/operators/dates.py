"""Vote on the order of a date column's numbers.

An export writes one order throughout, but a single value often fits two: 03/04/1999
may be March or April. One aggregate counts how many values fit each order; the
one that fits more wins, so a value with a number above 12 decides for the
whole column. Columns whose values all fit both are reported as ambiguous and
read month first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens import functions as LF

#: Texts that some candidate reads; the order matters for those that end with the year.
COUNTS = ("year_first", "packed", "month_first", "day_first", "unread")


def date_order(df: DataFrame, column: str) -> DataFrame:
    """One row: values per candidate, ``date_order`` (month or day) and ``ambiguous``.

    ``month_first`` and ``day_first`` count the values with a final year that are
    dates in that order (many are in both); ``unread`` counts the other texts
    that aren't missing.
    """
    parts = LF.date_parts(column)
    last = LF.year_last(parts)
    month, day = (LF.parse_date(column, day_first=d).isNotNull() & last for d in (False, True))
    read = LF.parse_date(column).isNotNull()
    told = LF.na_to_null(column).isNotNull()
    counts = df.agg(
        F.count_if(read & LF.year_first(parts)).alias("year_first"),
        F.count_if(read & (F.size(parts) == 1)).alias("packed"),
        F.count_if(month).alias("month_first"), F.count_if(day).alias("day_first"),
        F.count_if(month & day).alias("either"), F.count_if(told & ~read & ~day).alias("unread"))
    most = F.when(F.col("day_first") > F.col("month_first"), "day").otherwise("month")
    undecided = (F.col("either") > 0) & (F.col("either") == F.col("month_first")) & (F.col("either") == F.col("day_first"))
    return counts.withColumn("date_order", most).withColumn("ambiguous", undecided)
