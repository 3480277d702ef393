"""Epoch arithmetic on longs: ns and ms stay integers, nothing is rounded through a timestamp."""

from __future__ import annotations

import calendar
import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 86_400_000
FUNDING_MS = 28_800_000


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c: Column | str, by: int) -> Column:
    """Floor division of a long, also below zero."""
    c = _c(c)
    rest = F.pmod(c, F.lit(by).cast("long"))
    return F.call_function("div", F.try_subtract(c, rest), F.lit(by).cast("long")).cast("long")


def ns_to_ms(c: Column | str) -> Column:
    return floor_div(c, 1_000_000)


def ns_date(c: Column | str) -> Column:
    return F.to_date(F.timestamp_seconds(floor_div(c, 1_000_000_000)))


def ns_hour(c: Column | str) -> Column:
    return F.pmod(floor_div(c, HOUR_MS * 1_000_000), F.lit(24)).cast("int")


def latency_ms(received_ns: Column | str, exchange_ms: Column | str) -> Column:
    """Received minus exchange time in ms, not below zero."""
    return F.greatest(F.lit(0).cast("long"), F.try_subtract(ns_to_ms(received_ns), _c(exchange_ms)))


def next_funding_ms(ms: Column | str) -> Column:
    """The next 8-hour boundary, strictly after."""
    return (floor_div(ms, FUNDING_MS) + 1) * FUNDING_MS


def seconds_literal(text: str) -> int:
    """'5m' or '30s' in seconds; anything else raises."""
    m = re.fullmatch(r"(\d+)([ms])", text.strip())
    if not m:
        raise ValueError(f"not an interval of minutes or seconds: {text!r}")
    return int(m[1]) * (60 if m[2] == "m" else 1)


def _ms(t: dt.datetime) -> int:
    return calendar.timegm(t.timetuple()) * 1000 + t.microsecond // 1000


def period(kind: str, value: str | None = None, since: str | None = None, until: str | None = None) -> tuple[int, int]:
    """(first, last) ms, both inclusive, of a day, ISO week (2024-W05), hour (2024-01-31T05) or since..until."""
    if kind == "day":
        start = dt.datetime.strptime(value or "", "%Y-%m-%d")
        return _ms(start), _ms(start) + DAY_MS - 1
    if kind == "week":
        year, week = (value or "").upper().split("-W")
        start = dt.datetime.combine(dt.date.fromisocalendar(int(year), int(week), 1), dt.time())
        return _ms(start), _ms(start) + 7 * DAY_MS - 1
    if kind == "hour":
        start = dt.datetime.strptime(value or "", "%Y-%m-%dT%H")
        return _ms(start), _ms(start) + HOUR_MS - 1
    if kind == "range":
        a, b = (dt.datetime.fromisoformat((x or "").replace("Z", "+00:00")) for x in (since, until))
        a, b = (x.astimezone(dt.timezone.utc).replace(tzinfo=None) if x.tzinfo else x for x in (a, b))
        if _ms(b) < _ms(a):
            raise ValueError("until lies before since")
        return _ms(a), _ms(b)
    raise ValueError(f"unknown period: {kind!r}")


def dates_in_scope(start_ms: int, end_ms: int) -> list[str]:
    """The UTC dates that an inclusive span touches."""
    return [(dt.datetime(1970, 1, 1) + dt.timedelta(days=d)).strftime("%Y-%m-%d") for d in range(start_ms // DAY_MS, end_ms // DAY_MS + 1)]


def scope_dates(start_ms: Column | str, end_ms: Column | str) -> Column:
    """The same as an array of dates."""
    day = lambda c: F.date_from_unix_date(floor_div(c, DAY_MS).cast("int"))
    return F.sequence(day(start_ms), F.greatest(day(start_ms), day(end_ms)))


def session_id(collector: Column | str, ts_ns: Column | str) -> Column:
    """collector_2021-02-01T00:00:00Z: the name of a collector's session that began then."""
    return F.concat(_c(collector), F.lit("_"), F.date_format(F.timestamp_seconds(floor_div(ts_ns, 1_000_000_000)), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def next_daily_run(now_ns: int, hour: int = 2, minute: int = 30) -> int:
    """Epoch ns of the next hour:minute UTC, strictly after now."""
    day = DAY_MS * 1_000_000
    at = now_ns // day * day + (hour * 60 + minute) * 60 * 1_000_000_000
    return at if at > now_ns else at + day
