"""Raw exchange frames: the payload as it stands in the frame, and where it belongs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Suffix of a stream key -> stream.
STREAM_KEYS = {"aggTrade": "trades", "depth": "depth", "bookTicker": "bookticker", "markPrice": "funding_rate", "forceOrder": "liquidations"}


def value_at(text: str, start: int) -> str | None:
    """The JSON value that begins at or after start, byte for byte; null if it doesn't end.

    Objects and arrays by balance of brackets outside strings, strings by their quotes, else up to the next
    comma or closing bracket."""
    n = len(text)
    while start < n and text[start] in " \t\r\n":
        start += 1
    if start >= n:
        return None
    depth, quoted, i = 0, False, start
    while i < n:
        c = text[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
                if not depth:
                    return text[start : i + 1]
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            if not depth:
                return text[start:i].rstrip()
            depth -= 1
            if not depth:
                return text[start : i + 1]
        elif c == "," and not depth:
            return text[start:i].rstrip()
        i += 1
    return None if depth or quoted else text[start:].rstrip()


def _data(text: str | None) -> str | None:
    """Value of the top-level key data."""
    if text is None:
        return None
    depth, quoted, i, begun = 0, False, 0, 0
    while i < len(text):
        c = text[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
                rest = text[i + 1 :].lstrip() if depth == 1 and text[begun : i + 1] == '"data"' else ""
                if rest.startswith(":"):
                    return value_at(text, text.index(":", i + 1) + 1)
        elif c == '"':
            quoted, begun = True, i
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
        i += 1
    return None


def _all_data(frame: pd.Series) -> pd.Series:
    return frame.map(_data)


_USUAL = r'(?s)^\s*\{\s*"stream"\s*:\s*"[^"\\]*"\s*,\s*"data"\s*:\s*(.*\S)\s*\}\s*$'


def raw_data(frame: Column) -> Column:
    """The payload of combined frames, character for character (no re-serialisation). A frame of the two keys stream and
    data in this order, which is checked by its parsed keys, gives what stands between them and the last brace;
    only other frames are walked by Python."""
    usual = F.json_object_keys(frame).eqNullSafe(F.array(F.lit("stream"), F.lit("data")))
    fast = F.when(usual, F.nullif(F.regexp_extract(frame, _USUAL, 1), F.lit("")))
    return F.coalesce(fast, F.pandas_udf(_all_data, StringType())(F.when(fast.isNull(), frame)))


def stream_key_columns(key: Column) -> tuple[Column, Column]:
    """(symbol in lower case, stream or null) of a key like btcusdt@aggTrade or !forceOrder@arr."""
    parts = F.split(key, "@")
    names = F.create_map(*(x for k, v in STREAM_KEYS.items() for x in (F.lit(k), F.lit(v))))
    every = key.startswith("!")
    name = F.when(every, F.substring_index(F.substring(key, 2, 1000), "@", 1)).otherwise(F.get(parts, F.lit(1)))
    return F.when(~every, F.lower(F.get(parts, F.lit(0)))), F.try_element_at(names, name)


def route_frames(df: DataFrame, frame: str, subscribed: list[str] | DataFrame) -> DataFrame:
    """df with stream, symbol, raw_text of each combined frame. Frames of all symbols (liquidations) take the symbol
    of the payload and are dropped unless it is subscribed (a list, or a table with a column symbol in lower
    case); a symbol's own frames come because it is subscribed. Unknown streams are dropped."""
    d = df.withColumns({"raw_text": raw_data(F.col(frame)), "_key": F.get_json_object(frame, "$.stream")})
    symbol, stream = stream_key_columns(F.col("_key"))
    payload_symbol = F.lower(F.coalesce(F.get_json_object("raw_text", "$.o.s"), F.get_json_object("raw_text", "$.s")))
    d = d.withColumns({"stream": stream, "symbol": F.coalesce(symbol, payload_symbol)})
    d = d.where(F.col("stream").isNotNull() & F.col("raw_text").isNotNull())
    own = ~F.col("_key").startswith("!")
    if isinstance(subscribed, DataFrame):
        known = subscribed.select("symbol").distinct()
        return d.where(own).unionByName(d.where(~own).join(known, "symbol", "left_semi")).drop("_key")
    return d.where(own | F.col("symbol").isin([s.lower() for s in subscribed])).drop("_key")
