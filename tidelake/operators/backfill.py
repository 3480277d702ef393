"""Backfill of missing hours, and interpolation where nothing can be fetched."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES
from tidelake.functions.timeutil import HOUR_MS, floor_div, next_funding_ms
from tidelake.operators.consolidate import KEYS
from tidelake.runtime import spread

T = TypeVar("T")

#: Payload key of the event time by stream.
TIME_KEYS = {"trades": "$.T", "funding_rate": "$.fundingTime", "open_interest": "$.timestamp"}


def backfill_envelopes(pages: DataFrame, received_at: int, session: str) -> DataFrame:
    """Envelopes for fetched payloads: names, hour_start_ms and raw_text in; rows of [hour, hour + 1 h) only.

    A payload without its time key counts as 0 and so lies outside. session_seq and _offset number an hour's
    payloads from 0 by time and text; _topic and source are 'backfill'.
    """
    from pyspark.sql import Window as W

    ts = F.coalesce(*(F.when(F.col("stream") == s, F.get_json_object("raw_text", k).try_cast("long")) for s, k in TIME_KEYS.items()), F.lit(0).cast("long"))
    d = pages.withColumn("exchange_ts", ts).where(f"exchange_ts >= hour_start_ms AND exchange_ts < hour_start_ms + {HOUR_MS}")
    no = F.row_number().over(W.partitionBy(*KEYS, "hour_start_ms").orderBy("exchange_ts", "raw_text")).cast("long") - 1
    d = d.withColumn("session_seq", no)
    return d.select(
        F.lit(1).alias("v"), F.lit("data").alias("type"), "exchange", "symbol", "stream", F.lit(received_at).cast("long").alias("received_at"), "exchange_ts",
        F.lit(session).alias("collector_session_id"), "session_seq", "raw_text", F.sha2(F.col("raw_text").cast("binary"), 256).alias("raw_sha256"),
        F.lit("backfill").alias("source"), F.lit("backfill").alias("_topic"), F.lit(0).alias("_partition"), F.col("session_seq").alias("_offset"),
    )


class Unavailable(Exception):
    """The source has no data for the hour and never will (as opposed to a request that failed)."""


class RateLimited(Exception):
    """The source asks to wait; retry_after_s seconds if it says so. banned: further requests must stop."""

    def __init__(self, retry_after_s: float | None = None, banned: bool = False):
        super().__init__("banned by the source" if banned else "too many requests")
        self.retry_after_s, self.banned = retry_after_s, banned


def with_retries(call: Callable[[], T], tries: int = 3, first_s: float = 1.0, most_s: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """What call gives, tried again after errors: a wait that doubles, or as long as the source asks for. What is
    unavailable, or a ban, isn't tried again."""
    for attempt in range(tries):
        try:
            return call()
        except Unavailable:
            raise
        except RateLimited as e:
            if e.banned or attempt == tries - 1:
                raise
            sleep(min(most_s, e.retry_after_s if e.retry_after_s is not None else first_s * 2**attempt))
        except Exception:
            if attempt == tries - 1:
                raise
            sleep(min(most_s, first_s * 2**attempt))
    raise ValueError("tries must be 1 or more")


def fetch_pages(missing: DataFrame, provider: Callable[[str, str, str, int, int], Iterable[str]], tries: int = 3, first_s: float = 1.0) -> DataFrame:
    """Payloads for missing hours: provider(exchange, symbol, stream, start_ms, end_ms) runs on the executors, one
    call (and its retries) for each hour. names, hour_start_ms, raw_text, error, unavailable: an hour whose calls fail
    has one row with the error and no text, and so has one that the source hasn't (unavailable)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[tuple] = []
            for r in f.itertuples(index=False):
                at = (r.exchange, r.symbol, r.stream, r.start_ms)
                try:
                    rows += [(*at, x, None, False) for x in with_retries(lambda: list(provider(*at, r.start_ms + HOUR_MS)), tries, first_s)]  # noqa: B023
                except Unavailable as e:
                    rows.append((*at, None, str(e) or "unavailable", True))
                except Exception as e:  # noqa: BLE001 - reported for the hour
                    rows.append((*at, None, str(e) or type(e).__name__, False))
            yield pd.DataFrame(rows, columns=[*NAMES, "hour_start_ms", "raw_text", "error", "unavailable"])

    return spread(missing.select(*NAMES, "start_ms"), "start_ms").mapInPandas(run, "exchange string, symbol string, stream string, hour_start_ms bigint, raw_text string, error string, unavailable boolean")


def poll(targets: DataFrame, provider: Callable[[str, str, str], str], received_at: int, session: str, miss: str, tries: int = 3, first_s: float = 1.0) -> DataFrame:
    """One poll (open interest, depth snapshot) of each target (names): data envelopes with the payload that provider(
    exchange, symbol, stream) gives, its retries included; for a target that gives none a gap envelope of reason
    snapshot_poll_miss, with miss as its text. Runs on the executors."""
    from tidelake.functions.payload import payload_exchange_ts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                try:
                    rows.append((r.exchange, r.symbol, r.stream, with_retries(lambda: provider(r.exchange, r.symbol, r.stream), tries, first_s)))  # noqa: B023
                except Exception:  # noqa: BLE001 - a miss is a row of its own
                    rows.append((r.exchange, r.symbol, r.stream, None))
            yield pd.DataFrame(rows, columns=[*NAMES, "raw_text"])

    d = spread(targets.select(*NAMES).distinct(), "symbol").mapInPandas(run, "exchange string, symbol string, stream string, raw_text string")
    got = F.col("raw_text").isNotNull()
    at = F.lit(received_at).cast("long")
    return d.select(
        F.lit(1).alias("v"), F.when(got, "data").otherwise("gap").alias("type"), *NAMES, at.alias("received_at"), F.when(got, F.coalesce(payload_exchange_ts("stream", "raw_text"), F.lit(0).cast("long"))).alias("exchange_ts"),
        F.lit(session).alias("collector_session_id"), F.lit(-1).cast("long").alias("session_seq"), "raw_text", F.sha2(F.col("raw_text").cast("binary"), 256).alias("raw_sha256"),
        F.when(~got, at).alias("gap_start_ts"), F.when(~got, at).alias("gap_end_ts"), F.when(~got, "snapshot_poll_miss").alias("reason"), F.when(~got, miss).alias("detail"),
    )


def kline_closes(pages: DataFrame, page: str, name: str) -> DataFrame:
    """pages with t (opening time in ms) and the closing price of each candle of a page: a JSON array of arrays that
    begin with time, open, high, low, close as numbers or texts. Candles that aren't so are left out."""
    candles = F.explode(F.from_json(page, "array<array<string>>"))
    d = pages.select(*[c for c in pages.columns if c != page], candles.alias("_c"))
    d = d.withColumns({"t": F.get("_c", F.lit(0)).try_cast("long"), name: F.get("_c", F.lit(4)).try_cast("double")})
    return d.where(F.col("t").isNotNull() & F.col(name).isNotNull()).drop("_c")


def summary(done: DataFrame) -> DataFrame:
    """One row over the hours of a backfill (status, records): attempted, written, records, empty, unavailable, failed,
    and not_backfillable ones, which aren't attempted."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return done.agg(F.count_if(F.col("status") != "not_backfillable").alias("attempted"), F.count_if(F.col("status") == "backfilled").alias("written"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"), n("empty"), n("unavailable"), n("failed"), n("not_backfillable"))


def fetch_by_id(page: Callable[[int], list[tuple[int, str]]], first: int, last: int, page_size: int = 1000) -> Iterator[tuple[int, str]]:
    """(id, payload) of ids first..last from pages that start at an id; a short page is the last one."""
    at = first
    while at <= last:
        got = page(at)
        for i, text in got:
            if i > last:
                return
            yield i, text
        if len(got) < page_size:
            return
        at = got[-1][0] + 1


def interpolate_grid(pairs: DataFrame, keys: list[str], fields: list[str], step_ms: int = 1000) -> DataFrame:
    """Straight lines between successive readings: a row for every full step inside (t0, t1], from the step after
    floor(t0) up to floor(t1).

    pairs: keys, t0, t1 (ms) and for each field <f>0 and <f>1 (double). Output: keys, t, fields, next_funding.
    """
    first = floor_div("t0", step_ms) * step_ms + step_ms
    last = floor_div("t1", step_ms) * step_ms
    d = pairs.where(first <= last).withColumn("t", F.explode(F.sequence(first, last, F.lit(step_ms).cast("long"))))
    part = (F.col("t") - F.col("t0")).cast("double") / (F.col("t1") - F.col("t0")).cast("double")
    line = lambda f: (F.col(f"{f}0") + (F.col(f"{f}1") - F.col(f"{f}0")) * part).alias(f)
    return d.select(*keys, "t", *(line(f) for f in fields), next_funding_ms("t").alias("next_funding"))


def price_text(c: Column) -> Column:
    return F.format_string("%.8f", c)
