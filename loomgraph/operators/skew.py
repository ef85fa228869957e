"""A left join against a table with one row per key that holds up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from 1/HEAVY_PARTS of all rows on, so at most HEAVY_PARTS keys can be heavy: that bounds the broadcast.
HEAVY_PARTS = 10_000


def heavy_keys(rows: DataFrame, key: str, total: int, parts: int = HEAVY_PARTS, period: Column | None = None) -> DataFrame:
    """Keys with at least ``total / parts`` of the rows (within one period, if given); never more than ``parts`` keys.

    Counts are combined on the map side, so a hot key costs one row per map task. Null keys are left out.
    ``total`` is the number of rows, or any larger number.
    """
    least = max(2, -(-total // parts))
    by = [F.col(key)] if period is None else [F.col(key), period.alias("period")]
    counted = rows.where(F.col(key).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") >= F.lit(least)).select(key)
    return found if period is None else found.distinct()


def lookup_join(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row per ``key``), heavy keys by broadcast, the rest by shuffle.

    ``heavy`` has the heavy keys, at most HEAVY_PARTS rows (see ``heavy_keys``), and should be cut: it is read four
    times. Rows with a null key come out with nulls from ``table``.
    """
    mark = F.broadcast(heavy.select(key))
    hot_table = F.broadcast(table.join(mark, key, "left_semi"))
    hot = rows.join(mark, key, "left_semi").join(hot_table, key, "left")
    cold_rows = rows.join(mark, key, "left_anti")
    return hot.unionByName(cold_rows.join(table, key, "left"))
