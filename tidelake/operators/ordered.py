"""Ordered operators (previous value, running maximum, numbering) that never put a whole key into one task.

Rows are cut into blocks that follow the order (a file, an hour): the work inside a block is a window over
(keys, block); what a block hands to the next is one row each, and only those rows meet in a window over keys.
The large side is shuffled once, by (keys, block). Null keys are keys. Callers select the columns
they need before and after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelake.functions.timeutil import floor_div


def _within(df: DataFrame, keys: list[str], block: str, order: list[str]) -> tuple[DataFrame, WindowSpec, str]:
    """df with its keys and block as one struct (equal where its fields are, nulls too), the window inside it, and its
    name. It stays in the result, so that a further operator on the same keys finds its rows in place."""
    at = "_".join(["_at", *keys, block])
    if at not in df.columns:
        df = df.withColumn(at, F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.col(block).alias("b")))
    return df, W.partitionBy(at).orderBy(*order), at


def _carry(inside: DataFrame, at: str, order: list[str], n_keys: int, what: Callable[[WindowSpec], Column]) -> DataFrame:
    """inside with _b: what(window over the last rows of the key's earlier blocks).

    The last row of a block is kept whole (_end): as both uses of `inside` then need the same columns, one shuffle
    serves both, and the source is read and its payload parsed once, if the caller has selected what it needs.
    """
    ends = inside.groupBy(at).agg(F.max_by(F.struct(*inside.columns), F.struct(*order)).alias("_end"))
    over = W.partitionBy(*(F.col(f"{at}.k{i}") for i in range(n_keys))).orderBy(f"{at}.b")
    return inside.join(ends.select(at, what(over).alias("_b")), at)


def previous(df: DataFrame, keys: list[str], block: str, order: list[str], values: dict[str, str]) -> DataFrame:
    """df with, for each (column: name) of values, the value in the row before in (block, order) of the keys."""
    d, own, at = _within(df, keys, block, order)
    inside = d.withColumn("_p", F.lag(F.struct(*values)).over(own))
    last = F.struct(*(F.col(f"_end.{c}").alias(c) for c in values))
    out = _carry(inside, at, order, len(keys), lambda w: F.lag(last).over(w)).withColumn("_p", F.coalesce("_p", "_b"))
    return out.withColumns({n: F.col(f"_p.{c}") for c, n in values.items()}).drop("_p", "_b")


def running_max(df: DataFrame, keys: list[str], block: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with the greatest value of all rows before."""
    d, own, at = _within(df, keys, block, order)
    inside = d.withColumn("_p", F.max(value).over(own.rowsBetween(W.unboundedPreceding, -1)))
    top = F.greatest(F.col("_end._p"), F.col(f"_end.{value}"))
    out = _carry(inside, at, order, len(keys), lambda w: F.max(top).over(w.rowsBetween(W.unboundedPreceding, -1)))
    return out.withColumn(name, F.greatest("_p", "_b")).drop("_p", "_b")


def running_sum(df: DataFrame, keys: list[str], block: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of value over all rows up to and with this one (numbering: the sum of ones)."""
    d, own, at = _within(df, keys, block, order)
    inside = d.withColumn("_p", F.sum(value).over(own.rowsBetween(W.unboundedPreceding, 0)))
    out = _carry(inside, at, order, len(keys), lambda w: F.sum("_end._p").over(w.rowsBetween(W.unboundedPreceding, -1)))
    return out.withColumn(name, F.coalesce("_p", F.lit(0)) + F.coalesce("_b", F.lit(0))).drop("_p", "_b")


def last_known(df: DataFrame, keys: list[str], block: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with the last non-null value up to and with this row (as-of join of a union of two kinds of rows)."""
    d, own, at = _within(df, keys, block, order)
    inside = d.withColumn("_p", F.last(value, ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, 0)))
    out = _carry(inside, at, order, len(keys), lambda w: F.last("_end._p", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)))
    return out.withColumn(name, F.coalesce("_p", "_b")).drop("_p", "_b")


def lookups(df: DataFrame, keys: list[str], block: str, order: list[str], up_to: dict[str, str], before: dict[str, str]) -> DataFrame:
    """Several last known values in one pass: df with, for each (name: column) of up_to, the last non-null value up to and
    with this row, and for each of before, the last one of the rows before it. What all of them hand from block to
    block is one row, so the rows are shuffled, sorted and joined once however many values there are."""
    d, own, at = _within(df, keys, block, order)
    every = {**{n: (c, 0) for n, c in up_to.items()}, **{n: (c, -1) for n, c in before.items()}}
    inside = d.withColumns({f"_p_{n}": F.last(c, ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, upto)) for n, (c, upto) in every.items()})
    end = {n: F.col(f"_end._p_{n}") if upto == 0 else F.coalesce(F.col(f"_end.{c}"), F.col(f"_end._p_{n}")) for n, (c, upto) in every.items()}
    out = _carry(inside, at, order, len(keys), lambda w: F.struct(*(F.last(e, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias(n) for n, e in end.items())))
    return out.withColumns({n: F.coalesce(f"_p_{n}", f"_b.{n}") for n in every}).drop("_b", *(f"_p_{n}" for n in every))


def silent_before(df: DataFrame, keys: list[str], time: str, width: int, blocks: int = 4096) -> DataFrame:
    """keys, last, next: every pair of successive times of the keys that lie more than width apart, and of each key's first
    time a row with null last. The times are first reduced to the least and the greatest of each stretch of that width,
    inside which nothing is silent for so long; only those are put in order, in blocks of so many stretches."""
    d = df.where(F.col(time).isNotNull()).groupBy(*keys, floor_div(time, width).alias("_w")).agg(F.min(time).alias("next"), F.max(time).alias("_z"))
    d = previous(d.withColumn("_block", floor_div("_w", blocks)), keys, "_block", ["_w"], {"_z": "last"})
    return d.where(F.col("last").isNull() | (F.col("next") - F.col("last") > width)).select(*keys, "last", "next")


def islands(df: DataFrame, keys: list[str], block: str, order: list[str], new: str, aggregates: list) -> DataFrame:
    """Gaps and islands: a row with new = 1 starts an island of its keys; one row for each island (island: its number)."""
    return running_sum(df, keys, block, order, new, "island").groupBy(*keys, "island").agg(*aggregates)
