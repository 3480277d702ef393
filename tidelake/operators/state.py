"""The operational state: latest rows, upserts, high-water marks, files against state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Of each key the row with the greatest order columns (nulls lowest); ties by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.max(F.struct(*order, *rest)).alias("r")
    return df.groupBy(*keys).agg(row).select(*keys, *(F.col(f"r.{c}").alias(c) for c in df.columns if c not in keys))


def high_water(rows: DataFrame) -> DataFrame:
    """Greatest offset of each topic and partition, and where a restart goes on."""
    d = rows.where("_offset >= 0 AND _topic IS NOT NULL").groupBy("_topic", "_partition").agg(F.max("_offset").alias("high_water"))
    return d.withColumn("seek_to", F.col("high_water") + 1)


def upsert_file_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """State after changes: the greatest high-water mark of each (topic, partition_id, file_path), and the size of
    the latest row. Any order and repetition of changes gives the same."""
    both = state.unionByName(changes)
    last = F.max(F.struct("updated_at", "file_byte_size")).alias("l")
    return both.groupBy("topic", "partition_id", "file_path").agg(F.max("high_water_offset").alias("high_water_offset"), last).select("topic", "partition_id", "file_path", "high_water_offset", "l.file_byte_size", "l.updated_at")


def upsert_checkpoint(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Last write wins."""
    return latest_by(state.unionByName(changes), keys, "updated_at")


def files_against_state(files: DataFrame, state: DataFrame) -> DataFrame:
    """Each data file (file_path, size_bytes, has_sidecar) against the state's size of it.

    sealed: with sidecar. uncommitted: neither sidecar nor state. oversized: longer than the state says (the tail
    wasn't committed). short: shorter. missing_file: only the state has it. open: sizes agree, no sidecar yet.
    """
    s = state.groupBy("file_path").agg(F.max_by("file_byte_size", F.struct("updated_at", "file_byte_size")).alias("state_bytes"))
    d = files.join(s, "file_path", "full_outer")
    status = (
        F.when(F.col("size_bytes").isNull(), "missing_file")
        .when(F.col("has_sidecar"), "sealed")
        .when(F.col("state_bytes").isNull(), "uncommitted")
        .when(F.col("size_bytes") > F.col("state_bytes"), "oversized")
        .when(F.col("size_bytes") < F.col("state_bytes"), "short")
        .otherwise("open")
    )
    return d.select("file_path", "size_bytes", "state_bytes", status.alias("status"))


def active_intent(intents: DataFrame, now: Column | None = None) -> DataFrame:
    """The latest created intent that isn't consumed (with now: nor expired), if any."""
    d = intents.where("consumed_at IS NULL")
    if now is not None:
        d = d.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
    return d.orderBy(F.desc("created_at"), "maintenance_id").limit(1)


def prune(ledger: DataFrame, now_ns: int, days: int = 7) -> DataFrame:
    """Ledger rows of the last days; rows without time stay."""
    return ledger.where(F.col("ts_ns").isNull() | (F.col("ts_ns") >= now_ns - days * 86_400_000_000_000))


def component_state(events: DataFrame) -> DataFrame:
    """State of each (component, instance_id) from its events: register (host_boot_id), heartbeat, and shutdown (planned,
    maintenance_id), each with at_ms. Any order and repetition of events gives the same; a shutdown before the last
    register no longer counts."""
    is_ = lambda kind: F.col("event") == kind
    down = F.max(F.when(is_("shutdown"), F.struct("at_ms", "planned", "maintenance_id"))).alias("down")
    d = events.groupBy("component", "instance_id").agg(
        F.max(F.when(is_("register"), F.struct("at_ms", "host_boot_id"))).alias("up"),
        F.max(F.when(is_("register") | is_("heartbeat"), F.col("at_ms"))).alias("last_heartbeat_ms"),
        down,
    )
    gone = F.col("down.at_ms") >= F.coalesce("up.at_ms", "down.at_ms")
    return d.select("component", "instance_id", F.col("up.host_boot_id").alias("host_boot_id"), F.col("up.at_ms").alias("started_ms"), "last_heartbeat_ms", *(F.when(gone, F.col(f"down.{c}")).alias(n) for c, n in (("at_ms", "clean_shutdown_ms"), ("planned", "planned"), ("maintenance_id", "maintenance_id"))))


def clean_shutdowns(checkpoints: DataFrame, ledger: DataFrame, session: str = "last_collector_session_id") -> DataFrame:
    """checkpoints with clean: whether the last entry that the lifecycle journal has of their session is a clean
    shutdown (false for a session that it doesn't know). The journal is reduced to one row for each session first."""
    last = ledger.where("collector_session_id IS NOT NULL").groupBy(F.col("collector_session_id").alias("_session")).agg(F.max(F.struct("ts_ns", (F.col("event") == "clean_shutdown").alias("clean"))).alias("_l"))
    d = checkpoints.join(last, F.col(session) == F.col("_session"), "left")
    return d.select(*[F.col(c) for c in checkpoints.columns], F.coalesce("_l.clean", F.lit(False)).alias("clean"))
