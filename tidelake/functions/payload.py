"""Payload keys read lazily out of raw_text; the text itself is never rewritten."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_long(text: Column | str, path: str) -> Column:
    """The value at a JSON path as a long, null where it is absent or no integer."""
    return F.get_json_object(_c(text), path).try_cast("long")


def natural_key(stream: Column | str, text: Column | str, exchange_ts: Column | str) -> Column:
    """trades a, depth and bookticker u, else exchange_ts; -1 where the key is missing."""
    s, t = _c(stream), _c(text)
    key = F.when(s == "trades", json_long(t, "$.a")).when(s.isin("depth", "bookticker"), json_long(t, "$.u")).otherwise(_c(exchange_ts))
    return F.coalesce(key, F.lit(-1).cast("long"))


def sort_key(stream: Column | str, text: Column | str, exchange_ts: Column | str) -> Column:
    """Order of data rows in an hour: trades a, depth u, else (and as fallback) exchange_ts, 0 at last."""
    s, t = _c(stream), _c(text)
    key = F.when(s == "trades", json_long(t, "$.a")).when(s == "depth", json_long(t, "$.u"))
    return F.coalesce(key, _c(exchange_ts), F.lit(0).cast("long"))


def payload_exchange_ts(stream: Column | str, text: Column | str) -> Column:
    """open_interest time, depth_snapshot none, else E."""
    s, t = _c(stream), _c(text)
    return F.when(s == "open_interest", json_long(t, "$.time")).when(s == "depth_snapshot", F.lit(None).cast("long")).otherwise(json_long(t, "$.E"))


def payload_hash_ok(text: Column | str, sha: Column | str) -> Column:
    """Whether sha is the SHA-256 of the text; null where either is null."""
    return F.sha2(_c(text).cast("binary"), 256) == _c(sha)
