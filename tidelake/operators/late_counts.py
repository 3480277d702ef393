"""Per-period counts by event time that late and repeated records correct without double counting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.timeutil import floor_div

BITS = ("on_bits", "late_bits", "cut_bits")


def counter_cells(df: DataFrame, keys: list[str], event_ms: Column, received_ms: Column, seen_until: Column, source: Column, version: Column, period_ms: int, cutoff_ms: int) -> DataFrame:
    """The conflict-free counters of df, one row (cell) for each key, period, source and block of 64 versions.

    A cell is a vector of 64 counters, one for each version (sequence number) of its source, that stand at 0
    or 1, in three bitmaps: on time (received_ms not after seen_until), late (after it, before the cut-off),
    cut off (period end + cutoff_ms reached). Merging takes each counter's maximum (bit_or), so a retry, a
    second delivery or another order of arrival gives the same cell. `salt` is a function of the block and
    spreads a hot period over 16 groups.

    Defined cases: rows with null event time are left out; a null seen_until or received time counts as on
    time; null keys are keys; a null source is the source '' and a null version its version 0; repeated rows
    change nothing; an empty table gives no cells; columns of df other than the named are ignored.
    """
    source, version = F.coalesce(source, F.lit("")), F.coalesce(version, F.lit(0).cast("long"))
    p = floor_div(event_ms, period_ms) * F.lit(period_ms)
    limit = F.try_add(p, F.lit(period_ms + cutoff_ms).cast("long"))
    late = F.coalesce(received_ms > seen_until, F.lit(False))
    cut = late & F.coalesce(floor_div(received_ms, 1_000_000) >= limit, F.lit(False))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(version, F.lit(64).cast("long")).cast("int"))
    zero = F.lit(0).cast("long")
    block = floor_div(version, 64)
    rows = df.where(event_ms.isNotNull()).select(
        *keys,
        p.alias("period_ms"),
        F.pmod(block, F.lit(16)).cast("int").alias("salt"),
        source.alias("source"),
        block.alias("block"),
        F.when(late, zero).otherwise(bit).alias("on_bits"),
        F.when(late & ~cut, bit).otherwise(zero).alias("late_bits"),
        F.when(cut, bit).otherwise(zero).alias("cut_bits"),
    )
    return merge_cells(rows, keys=keys)


def merge_cells(*cells: DataFrame, keys: list[str]) -> DataFrame:
    """Merge of counters: commutative, associative and idempotent, so in any order and any number of times."""
    every = reduce(lambda a, b: a.unionByName(b), cells)
    return every.groupBy(*keys, "period_ms", "salt", "source", "block").agg(*(F.bit_or(c).alias(c) for c in BITS))


def period_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the sources' counters: n_on_time, n_corrected, n_cut_off (each message once, by its earliest
    class), n_final = on time + corrected, and whether any late or cut-off row was seen at all."""
    on, late, cut = (F.col(c) for c in BITS)
    n = lambda c: F.sum(F.bit_count(c).cast("long"))
    out = cells.groupBy(*keys, "period_ms").agg(
        n(on).alias("n_on_time"),
        n(late.bitwiseAND(F.bitwise_not(on))).alias("n_corrected"),
        n(cut.bitwiseAND(F.bitwise_not(on.bitwiseOR(late)))).alias("n_cut_off"),
        F.bool_or(late != 0).alias("has_corrected"),
        F.bool_or(cut != 0).alias("has_cut_off"),
    )
    return out.withColumn("n_final", F.col("n_on_time") + F.col("n_corrected"))


def attach_checkpoints(rows: DataFrame, checkpoints: DataFrame, keys: list[str], hour: str, value: str, salt: str, salts: int = 16) -> DataFrame:
    """rows with the greatest `value` of their keys and hour (null without one), salted so that a hot hour is
    spread over `salts` tasks; the checkpoints are reduced to one row for each hour first. Always a merge join:
    what an estimate takes for a small side is `salts` times larger."""
    best = checkpoints.groupBy(*keys, hour).agg(F.max(value).alias(value)).where(F.col(value).isNotNull())
    best = best.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.drop(value).join(best.hint("merge"), [*keys, hour, salt], "left")


def with_known_session(rows: DataFrame, copies: DataFrame, keys: list[str], broker: list[str], by_session: Column, by_broker: Column) -> DataFrame:
    """rows where those with broker coordinates only take the collector_session_id and session_seq of a copy, so that
    all copies of a message have one identity.

    copies: every row that may tell the session of coordinates, in any period. Only equal keys count, as session
    numbers start anew in each stream; of several sessions the least. Null keys are keys. Always a merge join, by coordinates, which
    spreads a hot stream; rows with a session or without coordinates aren't moved.
    """
    session = ["collector_session_id", "session_seq"]
    lost = by_broker & ~F.coalesce(by_session, F.lit(False))
    k = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate([*keys, *broker]))).alias("_k")
    known = copies.where(by_broker & by_session).select(k, F.struct(*session).alias("s")).groupBy("_k").agg(F.min("s").alias("_s"))
    has = F.coalesce(lost, F.lit(False))
    found = rows.where(has).withColumn("_k", k).join(known.hint("merge"), "_k", "left")
    found = found.withColumns({c: F.coalesce(F.col(f"_s.{c}"), F.when(F.col("_s").isNull(), F.col(c))) for c in session}).drop("_k", "_s")
    return rows.where(~has).unionByName(found)
