"""Names of exchanges, symbols, streams and reasons, and the paths that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\r\n"
NAMES = ("exchange", "symbol", "stream")


def norm(c: Column | str) -> Column:
    """Lower case without outer blanks: two spellings of one name become equal."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS)))


def norm_names(df: DataFrame, cols: tuple[str, ...] = NAMES) -> DataFrame:
    return df.withColumns({c: norm(F.col(c)) for c in cols})


#: archive/<exchange>/<symbol>/<stream>/<date>/<file>, whatever precedes the last five parts.
_PARTS = r"(?:^|/)([^/]+)/([^/]+)/([^/]+)/\s*(\d{4}-\d{2}-\d{2})\s*/([^/]+)$"
_HOUR = r"^hour-(\d{1,2})(?:\.(late|backfill)-(\d+))?\.jsonl\.zst$"


def path_columns(path: Column | str) -> dict[str, Column]:
    """exchange, symbol, stream, utc_date, file, kind, hour_no, seq of an archive path.

    kind is base, late, backfill, daily or other (companions, temporary files, foreign paths);
    hour_no (int) and seq (long) are null where the file has none. A null path gives kind other.
    """
    p = F.col(path) if isinstance(path, str) else path
    part = lambda i: F.regexp_extract(p, _PARTS, i)
    file = F.trim(part(5), F.lit(BLANKS))
    hour = lambda i: F.regexp_extract(file, _HOUR, i)
    number = lambda c: F.when(c != "", c).cast("int")
    kind = (
        F.when(file == F.concat(part(4), F.lit(".jsonl.zst")), "daily")
        .when((hour(1) != "") & (hour(1).try_cast("int") <= 23), F.when(hour(2) == "", "base").otherwise(hour(2)))
        .otherwise("other")
    )
    return {
        "exchange": norm(part(1)),
        "symbol": norm(part(2)),
        "stream": norm(part(3)),
        "utc_date": part(4),
        "file": file,
        "kind": F.coalesce(kind, F.lit("other")),
        "hour_no": number(hour(1)),
        "seq": F.when(hour(3) != "", hour(3).try_cast("long")),
    }
