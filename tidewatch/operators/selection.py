"""The first rows of an order without sorting them: a cut is found level by level.

``orderBy().limit(n)`` sends the first n rows of every task to one task. Here the order is
read as a number of levels, from coarse to fine: rows are counted per value of the first
level, which gives the value that holds the n-th row; rows of that value alone are counted
at the next level, and so on until the rows to take end where a value ends. The driver sees
one value a level, and taking the rows is a filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordering import running_totals

LETTERS = 6  # bytes of text in a level: 48 bits
NOTHING = -(1 << 63)


def text_level(text: Column, level: int) -> Column:
    """Some bytes of a text as a number in the order of texts; 0 beyond its end."""
    part = F.hex(F.substring(text.cast("binary"), level * LETTERS + 1, LETTERS))
    return F.coalesce(F.conv(F.rpad(part, 2 * LETTERS, "0"), 16, 10).cast("long"), F.lit(0))


def last_levels(ts: Column, key: Column) -> Iterator[Column]:
    """Levels of the order by time and key: days, microseconds, then bytes of the key."""
    yield F.coalesce(F.unix_date(F.to_date(ts)).cast("long"), F.lit(NOTHING))
    yield F.coalesce(F.unix_micros(ts.cast("timestamp")), F.lit(NOTHING))
    level = 0
    while True:
        yield text_level(key, level)
        level += 1


def newest(
    df: DataFrame, n: int, ts: str = "created_at", key: str = "prediction_id", day: str | None = None
) -> DataFrame:
    """The newest ``n`` rows by (time, key); a missing time is the oldest. Starts counting jobs.

    ``day`` names a partition column with the date of ``ts``, if there is one.

    Rows that share the time and the key of the last row to take are taken in part: as many
    as are missing, which does not matter as they are equal in the order.
    """
    if n <= 0:
        return df.limit(0)
    longest = None
    taken, left, level = F.lit(False), n, 0
    same, rows = F.lit(True), df
    for value in last_levels(F.col(ts), F.col(key).cast("string")):
        counts = rows.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
        after = F.col("n_all") - F.col("n_before") - F.col("n")
        found = (
            running_totals(counts, "v", ["n"])
            .select("v", "n", after.alias("newer"), F.col("n_all").alias("total"))
            .where((F.col("newer") < left) & (F.col("newer") + F.col("n") >= left))
            .first()
        )
        if found is None:  # fewer rows than are wanted
            return df.where(taken | same)
        taken, left = taken | (same & (value > found["v"])), left - found["newer"]
        same = same & (value == found["v"])
        if left == found["n"]:
            break
        if level == 0 and found["v"] != NOTHING:  # reaches the scan: days before are not read again
            first = F.lit(date(1970, 1, 1) + timedelta(days=found["v"]))
            df = df.where(F.col(ts) >= first)
            df = df.where(F.col(day) >= first) if day else df
        rows, level = df.where(same), level + 1
        if level >= 3:
            longest = longest or (rows.agg(F.max(F.octet_length(F.col(key).cast("string")))).first()[0] or 0)
            if (level - 2) * LETTERS >= longest:  # equal in the whole order
                return df.where(taken).unionByName(rows.limit(left))
    return df.where(taken | same)
