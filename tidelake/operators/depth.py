"""Order-book chains: replay against snapshots, and the online detectors."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.payload import json_long
from tidelake.functions.timeutil import floor_div
from tidelake.operators import ordered
from tidelake.operators.intervals import covered_and_gaps

HOUR_NS = 3_600_000_000_000
BOOK = ["exchange", "symbol"]


def depth_rows(df: DataFrame) -> DataFrame:
    """Depth diffs (first_u, last_u, prev_u), snapshots (lid) and gaps of both as one table by kind."""
    ids = {"first_u": "$.U", "last_u": "$.u", "prev_u": "$.pu", "lid": "$.lastUpdateId"}
    d = df.where(F.col("stream").isin("depth", "depth_snapshot"))
    kind = F.when(F.col("type") == "gap", "gap").when(F.col("stream") == "depth", "diff").otherwise("snapshot")
    return d.select(*BOOK, kind.alias("kind"), "row_id", "received_at", *(json_long("raw_text", p).alias(n) for n, p in ids.items()), "gap_start_ts", "gap_end_ts")


def replay_any(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Replay with any snapshot of the book as anchor: row_id and the error of each diff that has one.

    In order of received_at: an unsynced diff must span some snapshot (first_u <= lid + 1 <= last_u), else it is
    an error unless it lies in a gap; a synced one must continue the one before (prev_u = last u). A break that
    lies in a gap, or has one between the two diffs, syncs anew on any snapshot; else it is an error. The walk
    goes on from the diff's u in any case. Null ids and times count as 0.

    The walk has two states, synced or not, and a row can only turn it on (by spanning) or, as a break in a gap, begin
    anew. So the last row before that did either decides on a row: lookups over hours, without a walk; spans and gaps
    are lookups too, on the axes of ids and time.
    """
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    order = ["received_at", "row_id"]
    d = rows.where("kind = 'diff'").select(*scope, *(F.lit(None).cast("string").alias(c) for c in ("symbol",) if c not in rows.columns), *([] if "symbol" in scope else [F.col("symbol")]), "row_id", zero("received_at"), zero("first_u"), zero("last_u"), zero("prev_u"))
    lids = rows.where("kind = 'snapshot' AND lid IS NOT NULL").select(*scope, F.col("lid").alias("t"), F.col("lid").alias("hit")).distinct()
    u = d.withColumns({"t": F.col("last_u") - 1, "hit": F.lit(None).cast("long")}).unionByName(lids, allowMissingColumns=True).withColumns({"id_block": floor_div("t", 1 << 20), "asks": F.col("hit").isNull().cast("int")})
    u = ordered.last_known(u, scope, "id_block", ["t", "asks", "row_id"], "hit", "lid").where("asks = 1")
    d = u.select(*d.columns, F.coalesce(F.col("lid") >= F.col("first_u") - 1, F.lit(False)).cast("int").alias("spans"), F.struct("last_u", "received_at").alias("own"))
    # Whether a gap touches the stretch from the diff before (or from the diff itself, for the first): merged gaps lie
    # apart, so the last one that starts by the diff also ends last.
    gaps = rows.where("kind = 'gap' AND gap_start_ts <= gap_end_ts").select(*scope, "gap_start_ts", "gap_end_ts")
    gaps = covered_and_gaps(gaps, scope, "gap_start_ts", "gap_end_ts", block=HOUR_NS).where("kind = 'period'").select(*scope, F.col("gap_start_ts").alias("received_at"), F.col("gap_end_ts").alias("upto"))
    u = d.withColumns({"upto": F.lit(None).cast("long"), "asks": F.lit(1)}).unionByName(gaps.withColumn("asks", F.lit(0)), allowMissingColumns=True).withColumn("block", floor_div("received_at", HOUR_NS))
    d = ordered.lookups(u, scope, "block", ["received_at", "asks", "row_id"], {"gap_upto": "upto"}, {"before": "own"}).where("asks = 1").withColumns({"before_u": F.col("before.last_u"), "before_at": F.col("before.received_at")}).drop("upto", "own", "before")
    off = F.coalesce(F.col("prev_u") != F.col("before_u"), F.lit(False))
    in_gap = F.coalesce(F.col("gap_upto") >= F.col("received_at"), F.lit(False))
    since_gap = F.coalesce(F.col("gap_upto") >= F.col("before_at"), F.lit(False))
    d = d.withColumns({"off": off, "in_gap": in_gap, "since_gap": since_gap})
    d = d.withColumn("turn", F.when(F.col("spans") == 1, 1).when(F.col("off") & F.col("since_gap"), 0))
    d = ordered.lookups(d, scope, "block", ["received_at", "asks", "row_id"], {}, {"synced": "turn"})
    synced = F.coalesce(F.col("synced") == 1, F.lit(False))
    any_lid = lids.select(*scope).distinct().withColumn("has_lid", F.lit(True))
    d = d.where(F.when(synced, F.col("off") & ~F.col("since_gap")).otherwise((F.col("spans") == 0) & ~F.col("in_gap"))).join(any_lid, scope, "left")
    # The texts of replay errors.
    chain = F.format_string("[%s] pu chain break at received_at %d: expected pu=%d, got pu=%d", "symbol", "received_at", "before_u", "prev_u")
    why = F.when(F.col("has_lid"), "First diff does not span any snapshot sync point").otherwise("Depth diff has no preceding snapshot")
    first = F.format_string("[%s] %s: U=%d u=%d at %d", F.col("symbol"), why, F.col("first_u"), F.col("last_u"), F.col("received_at"))
    return d.select(*scope, "row_id", F.when(synced, chain).otherwise(first).alias("error"))


def resync_points(breaks: DataFrame, probes: DataFrame, backup: DataFrame, snapshots: DataFrame, wait_ns: int = 60_000_000_000) -> DataFrame:
    """How each broken book gets in sync again: breaks (exchange, symbol, broken_at) with status, sync_id, synced_at.

    First the producer must be healthy: the first good probe (at, good) from the break on, within wait_ns, else status
    producer_unhealthy. Then the greatest u that the backup has delivered by then (rows of backup: exchange, symbol,
    received_at, last_u) is the sync point (backup); without one the next snapshot (received_at, lid) from then on
    (snapshot); without that snapshot_exhausted. All lookups are as-of passes, hour by hour.
    """
    none = F.lit(None).cast("long")
    b = breaks.select(*BOOK, F.col("broken_at").alias("t")).distinct()

    def following(asked: DataFrame, given: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
        """asked (t) with the value of the first row of given (t) at or after t."""
        u = asked.withColumns({value: none, "asks": F.lit(1)}).unionByName(given.withColumn("asks", F.lit(0)), allowMissingColumns=True)
        u = u.withColumn("rt", -F.col("t")).withColumn("block", floor_div("rt", HOUR_NS))
        d = ordered.last_known(u, keys, "block", ["rt", "asks"], value, name).where("asks = 1")
        return d.select(*asked.columns, name)

    good = probes.where("good").select(F.lit(1).alias("all"), F.col("at").alias("t"), F.col("at").alias("hit")).distinct()
    b = following(b.withColumn("all", F.lit(1)), good, ["all"], "hit", "healthy_at").drop("all")
    b = b.withColumn("ready", F.when(F.col("healthy_at") <= F.col("t") + wait_ns, F.col("healthy_at")))
    ready = b.where("ready IS NOT NULL").select(*BOOK, F.col("t").alias("broken_at"), F.col("ready").alias("t"))
    u = ready.withColumns({"last_u": none, "asks": F.lit(1)}).unionByName(backup.where("received_at IS NOT NULL AND last_u IS NOT NULL").select(*BOOK, F.col("received_at").alias("t"), "last_u").withColumn("asks", F.lit(0)), allowMissingColumns=True).withColumn("block", floor_div("t", HOUR_NS))
    u = ordered.running_max(u, BOOK, "block", ["t", "asks", "last_u"], "last_u", "backup_u").where("asks = 1")
    s = snapshots.where("received_at IS NOT NULL AND lid IS NOT NULL").groupBy(*BOOK, F.col("received_at").alias("t")).agg(F.max("lid").alias("lid"))
    at = following(u.select(*BOOK, "broken_at", "t", "backup_u"), s.withColumn("hit", F.col("t")).drop("lid"), BOOK, "hit", "snapshot_at").join(s.withColumnsRenamed({"t": "snapshot_at"}), [*BOOK, "snapshot_at"], "left")
    out = b.withColumnRenamed("t", "broken_at").join(at.drop("t"), [*BOOK, "broken_at"], "left")
    status = F.when(F.col("ready").isNull(), "producer_unhealthy").when(F.col("backup_u").isNotNull(), "backup").when(F.col("lid").isNotNull(), "snapshot").otherwise("snapshot_exhausted")
    return out.select(*BOOK, "broken_at", status.alias("status"), F.coalesce("backup_u", "lid").alias("sync_id"), F.when(F.col("backup_u").isNotNull(), F.col("ready")).otherwise(F.col("snapshot_at")).alias("synced_at"))


def replay_asof(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Replay with the latest snapshot as anchor: each snapshot starts an epoch, whose first diff must span it;
    later diffs must continue the one before. Diffs before any snapshot are errors. Without Python.

    A break is excused if a gap of the book touches the stretch from the diff before to this one.
    """
    from tidelake.operators.overlap import overlapping

    d = rows.where("received_at IS NOT NULL AND (kind = 'diff' OR (kind = 'snapshot' AND lid IS NOT NULL))").withColumns({"block": floor_div("received_at", HOUR_NS), "is_diff": (F.col("kind") == "diff").cast("int")})
    is_diff = F.col("is_diff") == 1
    d = d.withColumns({"lid": F.when(~is_diff, F.col("lid")), "own": F.struct(F.when(is_diff, F.col("last_u")).alias("u"), F.when(is_diff, F.col("received_at")).alias("at"))})
    # The row before a diff is another diff of its epoch, or the snapshot that begins it.
    d = ordered.lookups(d, scope, "block", ["received_at", "is_diff", "row_id"], {"anchor": "lid"}, {"before": "own"}).where(is_diff).withColumns({"before_u": F.col("before.u"), "before_at": F.col("before.at")})
    spans = (F.col("first_u") <= F.col("anchor") + 1) & (F.col("last_u") >= F.col("anchor") + 1)
    bad = F.when(F.col("anchor").isNull(), "no_snapshot").when(F.col("before_at").isNull() & ~spans, "not_spanning").when(F.col("before_at").isNotNull() & (F.col("prev_u") != F.col("before_u")), "chain_break")
    errors = d.withColumn("error", bad).where("error IS NOT NULL").withColumn("from_at", F.coalesce("before_at", "received_at"))
    gaps = rows.where("kind = 'gap' AND gap_start_ts <= gap_end_ts").select(*scope, "gap_start_ts", "gap_end_ts").distinct()
    excused = overlapping(errors.select(*scope, "row_id", "from_at", "received_at"), gaps, scope, ("from_at", "received_at"), ("gap_start_ts", "gap_end_ts"), 6 * HOUR_NS)
    return errors.join(excused.select("row_id").distinct(), "row_id", "left_anti").select(*scope, "row_id", "error", F.col("before_u").alias("expected"), "prev_u")


class DepthDetector:
    """Online check of one book: what to do with each diff."""

    def __init__(self) -> None:
        self.lid: int | None = None
        self.last_u: int | None = None

    def sync(self, lid: int) -> None:
        self.lid, self.last_u = lid, None

    def diff(self, first_u: int, u: int, pu: int) -> str:
        """no_sync_point, stale (before the snapshot), no_sync_diff_found (it doesn't span the snapshot; the next may),
        pu_chain_break (a new sync is needed), or ok."""
        if self.lid is None:
            return "no_sync_point"
        if self.last_u is None:
            if u < self.lid:
                return "stale"
            if not first_u <= self.lid + 1 <= u:
                return "no_sync_diff_found"
        elif pu != self.last_u:
            self.lid = self.last_u = None
            return "pu_chain_break"
        self.last_u = u
        return "ok"


class DepthBuffer:
    """Holds diffs until the book is in sync, then replays them; beyond `size` the oldest are dropped, which
    gives one dropped stretch to report when the sync comes."""

    def __init__(self, size: int = 5000):
        self.detector = DepthDetector()
        self.waiting: deque = deque()
        self.size = size
        self.dropped: list[tuple[int, int]] = []

    def diff(self, at: int, first_u: int, u: int, pu: int) -> list[tuple[int, str]]:
        said = self.detector.diff(first_u, u, pu)
        if said == "no_sync_point":
            self.waiting.append((at, first_u, u, pu))
            if len(self.waiting) > self.size:
                gone = self.waiting.popleft()[0]
                self.dropped = [(self.dropped[0][0] if self.dropped else gone, gone)]
            return []
        return [(at, said)]

    def sync(self, lid: int) -> Iterator[tuple[int, str]]:
        self.detector.sync(lid)
        for a, z in self.dropped:
            yield z, f"dropped_from:{a}"
        self.dropped = []
        held, self.waiting = self.waiting, deque()
        for x in held:
            yield from self.diff(*x)


def detect_online(rows: DataFrame, scope: list[str], buffer: int = 5000) -> DataFrame:
    """row_id-free log of the online detector over the rows of each scope in order of arrival (row_id): time and
    outcome (ok isn't logged)."""
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in scope)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        book, log = DepthBuffer(buffer), []
        pdf = pdf[pdf["kind"] != "gap"].sort_values("row_id")
        for kind, at, lid, a, u, pu in zip(pdf["kind"], *(pdf[c].astype("Int64").fillna(0).astype("int64") for c in ("received_at", "lid", "first_u", "last_u", "prev_u"))):
            log += list(book.sync(int(lid))) if kind == "snapshot" else book.diff(int(at), int(a), int(u), int(pu))
        return pd.DataFrame([(*key, at, what) for at, what in log if what != "ok"], columns=[*scope, "at", "outcome"])

    return rows.groupBy(*scope).applyInPandas(run, f"{fields}, at bigint, outcome string")
