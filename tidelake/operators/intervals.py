"""Overlapping and gapped intervals per key, by a sweep over their boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.timeutil import floor_div

_TOP = 2**63 - 1


def covered_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, max_gap: int | None = None, block: int = 3_600_000) -> DataFrame:
    """Continuous covered periods of each key, and the uncovered stretches between them.

    Input: inclusive integer intervals [start, end]. Output: keys, kind ('period' or 'gap'), start, end
    (the names given), also inclusive; a gap is given if it is shorter than max_gap (None: any).

    Sweep line: an interval adds +1 at start and -1 at end + 1. Equal boundaries of a key are summed before
    anything else is shuffled, so repeats and hot keys shrink first. The prefix sum runs in two levels: within
    blocks of `block` units (at most so many distinct boundaries each) and over the blocks' totals. Periods
    start where the count of active intervals leaves 0 and end where it returns; the i-th start and the i-th
    end of a key form a period, the i-th end and the next start a gap. No task ever holds a whole key's rows.

    Defined cases: rows with a null bound or start > end are left out; null keys form a key of their own;
    intervals that meet (start = end + 1) are one; repeated rows change nothing; an empty table gives none;
    other columns are ignored whatever their names; an end of 2^63-1 reads as 2^63-1.
    """
    k = ["_k"]  # one struct: equal where its fields are, nulls too, so joins on it stay plain equalities
    rows = df.select(F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keys))).alias("_k"), F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_e")).where("_s <= _e")
    after = F.when(F.col("_e") == _TOP, F.col("_e")).otherwise(F.try_add("_e", F.lit(1)))
    marks = rows.select(*k, F.explode(F.array(F.struct(F.col("_s").alias("t"), F.lit(1).cast("long").alias("d")), F.struct(after.alias("t"), F.lit(-1).cast("long").alias("d")))).alias("m"))
    marks = marks.groupBy(*k, F.col("m.t").alias("t")).agg(F.sum("m.d").alias("d")).where("d <> 0")
    marks = marks.withColumn("b", floor_div("t", block))

    inner = W.partitionBy(*k, "b").orderBy("t")
    marks = marks.withColumn("run", F.sum("d").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    totals = marks.groupBy(*k, "b").agg(F.sum("d").alias("d"))
    before = W.partitionBy(*k).orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*k, "b", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("base"))
    active = marks.join(totals, [*k, "b"]).withColumn("now", F.col("run") + F.col("base"))

    edges = active.where((F.col("now") == 0) | (F.col("now") == F.col("d"))).withColumn("opens", (F.col("now") != 0).cast("long"))
    edges = edges.withColumn("i", F.sum("opens").over(inner.rowsBetween(W.unboundedPreceding, 0)))
    opened = edges.groupBy(*k, "b").agg(F.sum("opens").alias("o"))
    opened = opened.select(*k, "b", F.coalesce(F.sum("o").over(before), F.lit(0)).alias("first"))
    edges = edges.drop("base").join(opened, [*k, "b"]).withColumn("i", F.col("i") + F.col("first"))

    last = F.when(F.col("t") == _TOP, F.col("t")).otherwise(F.try_subtract("t", F.lit(1)))
    opens, none = F.col("opens") == 1, F.lit(None).cast("long")
    out = edges.select(
        *k,
        F.explode(
            F.array(
                F.struct(F.lit("period").alias("kind"), F.col("i").alias("i"), F.when(opens, F.col("t")).otherwise(none).alias("a"), F.when(opens, none).otherwise(last).alias("z")),
                F.struct(F.lit("gap").alias("kind"), F.when(opens, F.col("i") - 1).otherwise(F.col("i")).alias("i"), F.when(opens, none).otherwise(F.col("t")).alias("a"), F.when(opens, last).otherwise(none).alias("z")),
            )
        ).alias("x"),
    )
    out = out.groupBy(*k, "x.kind", "x.i").agg(F.max("x.a").alias("a"), F.max("x.z").alias("z")).where("a IS NOT NULL AND z IS NOT NULL")
    if max_gap is not None:
        out = out.where((F.col("kind") == "period") | (F.try_subtract("z", "a") < max_gap - 1))
    return out.select("kind", *(F.col(f"_k.k{i}").alias(c) for i, c in enumerate(keys)), F.col("a").alias(start), F.col("z").alias(end))
