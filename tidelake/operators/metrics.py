"""Metric and alert queries over rows instead of scraped counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.timeutil import floor_div

# Upper bounds of the latency buckets in ms.
LATENCY_BUCKETS = (1, 5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000)

#: The same for the time that a flush takes (ms), and for how long a failover lasts (s).
FLUSH_BUCKETS = LATENCY_BUCKETS
FAILOVER_BUCKETS = (1, 5, 10, 30, 60, 120, 300, 600, 1800, 3600)


def histogram(df: DataFrame, by: list[str], value: str, bounds: tuple[int, ...] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative counts: by, le (null: any), n. One aggregation with a counter for each bucket."""
    v = F.col(value)
    counts = df.where(v.isNotNull()).groupBy(*by).agg(F.array(*(F.count_if(v <= b) for b in bounds), F.count("*")).alias("c"))
    names = F.array(*(F.lit(b).cast("long") for b in bounds), F.lit(None).cast("long"))
    return counts.select(*by, F.explode(F.arrays_zip(names.alias("le"), F.col("c").alias("n"))).alias("x")).select(*by, "x.le", "x.n")


def histogram_quantile(hist: DataFrame, by: list[str], q: float) -> DataFrame:
    """The quantile of a cumulative histogram: a straight line inside the first bucket that reaches the rank, the
    highest finite bound if only the open bucket does. A key has a few rows, one for each bucket."""
    w = W.partitionBy(*by).orderBy(F.col("le").asc_nulls_last())
    h = hist.withColumn("total", F.max("n").over(W.partitionBy(*by))).where("total > 0").withColumn("rank", F.col("total") * F.lit(q))
    h = h.withColumn("n0", F.coalesce(F.lag("n").over(w), F.lit(0))).withColumn("le0", F.coalesce(F.lag("le").over(w), F.lit(0)))
    h = h.where("n >= rank").withColumn("first", F.row_number().over(w)).where("first = 1")
    inside = F.col("le0") + (F.col("le") - F.col("le0")) * (F.col("rank") - F.col("n0")) / (F.col("n") - F.col("n0"))
    value = F.when(F.col("le").isNull(), F.col("le0").cast("double")).when(F.col("n") == F.col("n0"), F.col("le").cast("double")).otherwise(inside)
    return h.select(*by, F.lit(q).alias("q"), value.cast("double").alias("value"))


def increase(df: DataFrame, by: list[str], time_ms: str, width_ms: int, amount: Column | None = None) -> DataFrame:
    """Sum of amounts (default: rows) in tumbling windows: by, window_start_ms, increase."""
    start = (floor_div(time_ms, width_ms) * width_ms).alias("window_start_ms")
    return df.where(F.col(time_ms).isNotNull()).groupBy(*by, start).agg(F.sum(amount if amount is not None else F.lit(1).cast("long")).alias("increase"))


def rate(df: DataFrame, by: list[str], time_ms: str, width_ms: int) -> DataFrame:
    """Rows a second in tumbling windows."""
    return increase(df, by, time_ms, width_ms).withColumn("rate", F.col("increase") / F.lit(width_ms / 1000.0)).drop("increase")


def lookback(df: DataFrame, by: list[str], time_s: str, width_s: int, value: str) -> DataFrame:
    """df with lookback: the sum of value over the last width_s seconds up to each row, its own included.

    Blocks of width_s: a row sees its own block and the one before, so each row is sent to two blocks at most
    and no window spans a whole key.
    """
    b = floor_div(time_s, width_s)
    d = df.withColumn("_b", F.explode(F.array(b, b + 1))).withColumn("_own", F.col("_b") == b)
    w = W.partitionBy(*by, "_b").orderBy(time_s).rangeBetween(-(width_s - 1), 0)
    return d.withColumn("lookback", F.sum(value).over(w)).where("_own").drop("_b", "_own")


def or_zero(df: DataFrame, value: Column, name: str) -> DataFrame:
    """One row with the aggregate, 0 if there is nothing to aggregate."""
    return df.agg(F.coalesce(value, F.lit(0)).alias(name))
