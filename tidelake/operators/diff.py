"""Differences between two copies of a dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, version: str, fields: list[str]) -> DataFrame:
    """Of each key (null is a key) the row with the greatest version; a null version is the lowest, ties go to
    the greatest fields in the order given. One aggregation with map-side combine, so a key with a third of
    all rows doesn't gather in a task."""
    row = F.struct(F.col(version).alias("_v"), *fields)
    return df.groupBy(F.coalesce(F.col(key), F.lit(0).cast("long")).alias("_key"), F.col(key).isNull().alias("_null")).agg(F.max(row).alias("row"))


def diff_copies(left: DataFrame, right: DataFrame, key: str, version: str, fields: list[str], rules: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Full outer join of the latest rows of two copies on a (null-safe) long key.

    Output, one row for each key that isn't the same on both sides: key, status ('left_only', 'right_only' or
    'differs'), differences: array of (field, left_value, right_value) as strings; for one-sided keys the array
    is empty. rules normalise a field before it is compared; null equals null.

    Both sides are hash-partitioned by the key once, by their aggregation; the join adds no shuffle.
    Defined cases: null keys match each other; superseded versions and repeats don't count; an empty side
    leaves every key one-sided; other columns are ignored, their names may clash.
    """
    rules = rules or {}
    pick = [key, version, *fields]
    a, b = (latest(x.select(*pick), key, version, fields).withColumnRenamed("row", n) for x, n in ((left, "l"), (right, "r")))
    both = a.join(b, ["_key", "_null"], "full_outer")
    one = []
    for f in fields:
        x, y = (rules.get(f, lambda c: c)(F.col(f"{s}.{f}")) for s in ("l", "r"))
        one.append(F.when(~x.eqNullSafe(y), F.struct(F.lit(f).alias("field"), x.cast("string").alias("left_value"), y.cast("string").alias("right_value"))))
    found = F.array_compact(F.array(*one))
    gone = (F.col("l").isNull(), F.col("r").isNull())
    status = F.when(gone[1], "left_only").when(gone[0], "right_only").otherwise("differs")
    out = both.select(F.when(F.col("_null"), F.lit(None)).otherwise(F.col("_key")).alias(key), status.alias("status"), F.when(gone[0] | gone[1], F.array_compact(F.array(F.when(F.lit(False), one[0])))).otherwise(found).alias("differences"))
    return out.where((F.col("status") != "differs") | (F.size("differences") > 0))


def gap_copy_rules() -> dict[str, Callable[[Column], Column]]:
    """Comparison of gap records: names without case and outer blanks, empty detail as null."""
    from tidelake.functions.names import norm

    return {"exchange": norm, "symbol": norm, "stream": norm, "reason": norm, "detail": lambda c: F.when(c != "", c)}
