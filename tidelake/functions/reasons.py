"""Gap reasons, and which reason of a state record explains which reason found in the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Wire names of gap reasons.
PERSISTENT = ("collector_restart", "restart_gap", "kafka_producer_outage", "missing_hour")
RUNTIME_ONLY = (
    "ws_disconnect", "pu_chain_break", "session_seq_skip", "recovery_depth_anchor", "buffer_overflow", "snapshot_poll_miss",
    "write_error", "deserialization_error", "handler_error", "checkpoint_lost", "kafka_offset_reset", "kafka_delivery_failed",
    "kafka_consumer_outage", "pg_outage_hold", "disk_full_hold", "cross_source_pu_chain_break", "both_collectors_silent",
)

# Reason of the state record -> reasons of file records that it explains.
EXPLAINS = {
    "collector_restart": ("collector_restart", "restart_gap", "ws_disconnect", "pu_chain_break", "session_seq_skip", "recovery_depth_anchor"),
    "restart_gap": ("restart_gap", "ws_disconnect", "pu_chain_break", "session_seq_skip", "recovery_depth_anchor"),
    "kafka_producer_outage": ("kafka_producer_outage", "kafka_delivery_failed", "kafka_offset_reset", "write_error"),
    "missing_hour": ("missing_hour",),
}


def explains(spark: SparkSession) -> DataFrame:
    """(state_reason, file_reason), 16 rows."""
    return spark.createDataFrame([(a, b) for a, bs in EXPLAINS.items() for b in bs], "state_reason string, file_reason string")


def check_reason(reason: str) -> str:
    """The reason, or an error for an unknown one."""
    if reason not in PERSISTENT + RUNTIME_ONLY:
        raise ValueError(f"unknown gap reason: {reason!r}")
    return reason
