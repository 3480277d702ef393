"""The conflict-free period counters kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.late_counts import counter_cells, merge_cells
from tidelake.runtime import list_dirs, remove_path


class CounterTable:
    """Counter cells below a folder, one part for each micro-batch (or compaction); reading merges all parts.

    A micro-batch writes the cells of its own rows under its number and so replaces what an earlier try of it
    wrote. As merging takes maxima, rows that come again in another batch, or parts that are read while their
    compaction is already there, count once. No state is kept in the stream, so no row is ever too late to be
    taken in; lateness and cut-off are classes of the counters.
    """

    def __init__(self, spark: SparkSession, base: str, keys: list[str], period_ms: int, cutoff_ms: int):
        self.spark, self.base, self.keys, self.period_ms, self.cutoff_ms = spark, base.rstrip("/"), keys, period_ms, cutoff_ms

    def cells(self, rows: DataFrame, event_ms: Column, received: Column, seen_until: Column, source: Column, version: Column) -> DataFrame:
        return counter_cells(rows, self.keys, event_ms, received, seen_until, source, version, self.period_ms, self.cutoff_ms)

    def follow(self, stream: DataFrame, checkpoint: str, event_ms: str, received: str, seen_until: str, source: str, version: str):
        """Starts the query over what the stream has now; columns by name."""
        c = [F.col(x) for x in (event_ms, received, seen_until, source, version)]

        def write(batch: DataFrame, number: int) -> None:
            self.cells(batch, *c).write.mode("overwrite").parquet(f"{self.base}/part={number}")

        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def read(self) -> DataFrame:
        """All cells, merged."""
        return merge_cells(self.spark.read.parquet(self.base).drop("part"), keys=self.keys)

    def compact(self, upto: int) -> None:
        """One part (numbered -1 - upto) for all parts up to a number, which are then removed. A reader meanwhile may see
        both, which counts once; run it between micro-batches, as readers list the parts they read."""
        old = [x for x in list_dirs(self.spark, self.base) if x.startswith("part=") and int(x[5:]) <= upto and int(x[5:]) != -1 - upto]
        d = self.spark.read.option("basePath", self.base).parquet(*[f"{self.base}/{x}" for x in old]).drop("part")
        merge_cells(d, keys=self.keys).write.mode("overwrite").parquet(f"{self.base}/part={-1 - upto}")
        for x in old:
            remove_path(self.spark, f"{self.base}/{x}")
