"""Reconciliation of gaps found in files with gaps that the operational state recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.reasons import EXPLAINS
from tidelake.functions.timeutil import HOUR_MS
from tidelake.operators.overlap import overlapping

TOLERANCE_MS = 2000


def chosen(files: DataFrame, state: DataFrame, tolerance_ms: int = TOLERANCE_MS) -> DataFrame:
    """(file_id, state_id): for each file gap the first state gap (least state_id) of the same stream whose reason
    explains it and whose interval overlaps it, give or take the tolerance. One state gap may explain many.

    files: file_id, names, start_ms, end_ms, reason; state: state_id and the same. Joined by stream and time
    bucket; the first match is a minimum by aggregation.
    """
    pairs = [(a, b) for a, bs in EXPLAINS.items() for b in bs]
    why = F.create_map(*(x for a, bs in EXPLAINS.items() for x in (F.lit(a), F.array(*map(F.lit, bs)))))
    f = files.where(F.col("reason").isin(*{b for _, b in pairs})).select("file_id", *NAMES, F.col("start_ms").alias("fs"), F.col("end_ms").alias("fe"), F.col("reason").alias("file_reason"))
    s = state.where(F.col("reason").isin(*EXPLAINS)).select("state_id", *NAMES, F.col("start_ms").alias("ss"), F.col("end_ms").alias("se"), why[F.col("reason")].alias("reasons"))
    both = overlapping(f, s, list(NAMES), ("fs", "fe"), ("ss", "se"), 6 * HOUR_MS, tolerance_ms)
    return both.where(F.array_contains("reasons", F.col("file_reason"))).groupBy("file_id").agg(F.min("state_id").alias("state_id"))


def unexplained(files: DataFrame, matches: DataFrame) -> DataFrame:
    return files.join(matches, "file_id", "left_anti")


def orphans(state: DataFrame, matches: DataFrame) -> DataFrame:
    """State gaps that no file gap chose (a match that wasn't chosen doesn't count)."""
    return state.join(matches.select("state_id").distinct(), "state_id", "left_anti")


def summary(files: DataFrame, state: DataFrame, matches: DataFrame) -> DataFrame:
    """status and n: explained, unexplained, orphan_state. The audit passes if nothing is unexplained."""
    n = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("status"), "n")
    return n(matches, "explained").unionByName(n(unexplained(files, matches), "unexplained")).unionByName(n(orphans(state, matches), "orphan_state"))
