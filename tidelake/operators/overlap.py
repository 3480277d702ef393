"""Interval joins by equality on keys and time buckets, instead of comparing all pairs of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.timeutil import floor_div

#: Most buckets of one width that an interval is placed in; a longer one is placed in buckets so many times as wide.
FAR = 1024


def widths(width: int) -> list[int]:
    """Bucket widths of all levels: enough for any interval of 64-bit integers."""
    out = [width]
    while (1 << 63) // out[-1] > FAR:
        out.append(out[-1] * FAR)
    return out


def placed(df: DataFrame, start: Column, end: Column, width: int, own: str) -> DataFrame:
    """A row for each bucket (level, n) in which the inclusive interval may meet another: its own level (own) is the first
    at which it touches FAR buckets at most; to be found by longer ones it is also in the few of each wider level."""
    end = F.greatest(start, end)
    at = [(i, floor_div(start, w), floor_div(end, w)) for i, w in enumerate(widths(width))]
    level = F.coalesce(*(F.when(z - a < FAR, F.lit(i)) for i, a, z in at), F.lit(len(at) - 1))
    none = F.array().cast("array<struct<level:int,n:bigint>>")

    def buckets(i: int, a: Column, z: Column) -> Column:
        here = F.col(own) <= i
        return F.when(here, F.transform(F.sequence(a, F.when(here, z).otherwise(a)), lambda n: F.struct(F.lit(i).alias("level"), n.alias("n")))).otherwise(none)

    rows = F.concat(*(buckets(*x) for x in at))
    return df.withColumn(own, level).withColumn("bucket", F.explode(rows))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str], width: int, slack: int = 0) -> DataFrame:
    """Pairs of rows with equal keys whose inclusive intervals overlap, give or take `slack`; each pair once.

    left and right share no column names but the keys. Two intervals meet at the longer one's level: short ones in
    buckets of `width`, about their usual length, long ones in wider buckets, so that no interval is expanded over
    more than some thousand. A pair is kept only in the first bucket that both touch.
    """
    (ls, le), (rs, re) = ([F.col(c) for c in b] for b in (left_bounds, right_bounds))
    a = placed(left.where(le >= ls), ls - slack, le + slack, width, "_a_level")
    b = placed(right.where(re >= rs), rs, re, width, "_b_level")
    level, n = F.col("bucket.level"), F.col("bucket.n")
    first = F.coalesce(*(F.when(level == i, F.greatest(floor_div(ls - slack, w), floor_div(rs, w))) for i, w in enumerate(widths(width))))
    once = (level == F.greatest("_a_level", "_b_level")) & (n == first)
    return a.join(b, [*keys, "bucket"]).where((ls - slack <= re) & (le + slack >= rs) & once).drop("bucket", "_a_level", "_b_level")
