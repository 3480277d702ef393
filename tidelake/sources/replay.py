"""Recorded exchange frames as a stream: a Python data source that stands in for sockets.

    spark.dataSource.register(ReplaySource)
    spark.readStream.format("frames_replay").option("path", FILE).option("batch", 500).load()
"""

from __future__ import annotations

from collections.abc import Iterator
from io import BufferedReader

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tidelake.sources.sink import open_seekable


class ReplaySource(DataSource):
    """Lines of a file (each a frame) as (line_no, frame), `batch` of them in a micro-batch, in order and repeatable: an
    offset is a line number and the byte at which it begins, so each micro-batch reads its own bytes only, and a
    restarted query goes on where its checkpoint says. The path may be a URI of a shared folder."""

    @classmethod
    def name(cls) -> str:
        return "frames_replay"

    def schema(self) -> str:
        return "line_no bigint, frame string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return ReplayReader(self.options["path"], int(self.options.get("batch", "500")))


class ReplayReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, batch: int):
        self.path = path
        self.batch = batch

    def initialOffset(self) -> dict:  # noqa: N802
        return {"line": 0, "byte": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, at = [], start["byte"]
        with self._open(at) as f:
            for n in range(start["line"], start["line"] + self.batch):
                line = f.readline()
                if not line:
                    break
                at += len(line)
                rows.append((n, line.decode("utf-8", "replace").rstrip("\r\n")))
        return iter(rows), {"line": start["line"] + len(rows), "byte": at}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        with self._open(start["byte"]) as f:
            for n in range(start["line"], end["line"]):
                yield n, f.readline().decode("utf-8", "replace").rstrip("\r\n")

    def _open(self, at: int) -> BufferedReader:
        f = BufferedReader(open_seekable(self.path))
        f.seek(at)
        return f
