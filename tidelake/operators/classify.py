"""Why a stream restarted: component, cause and planned from the evidence at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Components whose unclean end outranks other evidence, in this order.
PROMOTABLE = ("redpanda", "postgres", "writer")


def classify_restarts(df: DataFrame) -> DataFrame:
    """df with component, cause, planned, evidence (array).

    Input columns (any may be null): previous_boot, current_boot, previous_session, current_session string;
    collector_clean, system_clean boolean; intent_id string, intent_expires_ms, now_ms bigint; host_intent
    boolean (the host ledger has a maintenance intent); died array<string> (components with an unclean die).
    An intent without expiry is valid. A changed boot id outranks all; else an unclean die of one of the
    infrastructure components outranks what the sessions say.
    """
    c = F.col
    false = F.lit(False)
    boot = F.coalesce(c("previous_boot").isNotNull() & ~c("previous_boot").eqNullSafe(c("current_boot")), false)
    same_boot = F.coalesce(c("previous_boot") == c("current_boot"), false)
    session = F.coalesce(c("previous_session") != c("current_session"), false)
    clean, system, host = (F.coalesce(c(x), false) for x in ("collector_clean", "system_clean", "host_intent"))
    valid = c("intent_id").isNotNull() & F.coalesce(c("now_ms") < c("intent_expires_ms"), c("intent_expires_ms").isNull())
    expired = c("intent_id").isNotNull() & ~valid
    died = F.coalesce(c("died"), F.array().cast("array<string>"))
    dead = F.coalesce(*(F.when(~boot & F.array_contains(died, p), p) for p in PROMOTABLE))
    clear = boot | (host & valid) | clean | session | system
    component = F.when(boot, "host").when(host & valid, "system").when(clean | session, "collector").when(system, "writer").otherwise("unknown")
    cause = F.when(boot & ~valid, "host_reboot").when(boot | (host & valid) | clean, "operator_shutdown").when(session, "unclean_exit").when(system, "operator_shutdown").otherwise("unknown")
    planned = valid & (boot | host | clean | (system & ~session))
    say = lambda cond, text: F.when(cond, text)
    evidence = F.array_compact(
        F.array(
            say(boot, "host_boot_id_changed"),
            say(same_boot, "host_boot_id_unchanged"),
            say(session, "collector_session_changed"),
            say(clean, "collector_clean_exit"),
            say(system, "writer_clean_exit"),
            say(valid, "maintenance_intent_valid"),
            say(expired, "maintenance_intent_expired"),
            say(~clear, "no_clear_signal"),
            say(dead.isNotNull(), F.concat(F.lit("component_die:"), dead)),
        )
    )
    return df.select(
        "*",
        F.coalesce(dead, component).alias("component"),
        F.when(dead.isNotNull(), "unclean_exit").otherwise(cause).alias("cause"),
        (planned & dead.isNull()).alias("planned"),
        evidence.alias("evidence"),
    )
