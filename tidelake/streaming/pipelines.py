"""Structured Streaming forms of ingest: deduplication, hourly buckets, archiving with late files, coverage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.names import NAMES, norm_names
from tidelake.functions.timeutil import HOUR_MS, floor_div, ns_date, ns_hour
from tidelake.operators import coverage, ordered
from tidelake.runtime import drop_cut, list_dirs, scratch, write_cut
from tidelake.streaming import exactly_once
from tidelake.streaming.exactly_once import read_stream

KEYS = list(NAMES)


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], source: str, starting: str = "earliest", max_offsets: int = 500) -> DataFrame:
    """Envelopes of Kafka topics with their broker coordinates; source is primary or backup. Needs the connector.

    A tail consumer starts at 'latest'; several sources are united by unionByName."""
    d = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting).option("maxOffsetsPerTrigger", max_offsets).option("failOnDataLoss", "false").load()
    return d.select(F.col("value").cast("string").alias("line"), F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), F.col("offset").alias("_offset"), F.lit(source).alias("source"))


def kafka_max(spark: SparkSession, servers: str, topic: str, symbol: str, since_ms: int, path: str = "$.u") -> DataFrame:
    """Greatest id of a symbol's messages since a time, as one batch read. Needs the connector."""
    d = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingTimestamp", str(since_ms)).load()
    raw = F.get_json_object(F.col("value").cast("string"), "$.raw_text")
    return d.where(F.lower(F.col("key").cast("string")) == symbol.lower()).agg(F.max(F.get_json_object(raw, path).try_cast("long")).alias("max_id"))


def to_kafka(df: DataFrame, servers: str, checkpoint: str, prefix: str = ""):
    """Envelopes to their stream's topic, keyed by symbol. Needs the connector."""
    out = df.select(F.concat(F.lit(prefix), "exchange", F.lit("."), "stream").alias("topic"), F.col("symbol").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
    return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("checkpointLocation", checkpoint).start()


def drain(df: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """Runs what the stream has now into a table in the shared folder, exactly once, and reads that."""
    base = scratch(spark, "stream")
    q = df.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def dedup_offsets(spark: SparkSession, path: str, watermark: str = "6 hours") -> DataFrame:
    """Data rows of an envelope stream with each broker message once (row_id and coordinates), by exactly_once: copies of
    any age are found, no row is dropped for being late. Rows without coordinates, with offsets below 0 or without a
    time of arrival aren't any broker's copies and pass."""
    names = ["row_id", "_topic", "_partition", "_offset"]
    d = read_stream(spark, path).where("type = 'data'")
    broker = exactly_once.identifier("broker", F.col("_topic"), F.col("_partition"), F.when(F.col("_offset") >= 0, F.col("_offset")))
    gone = exactly_once.repeated_rows(spark, d, "row_id", "received_at", [broker], watermark=watermark)
    return exactly_once.exactly_once(spark.read.parquet(path).where("type = 'data'").select(*names), gone, "row_id")


def hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """Tumbling hours of arrival by stream. A micro-batch writes the counts of its own rows under its number, so a retry
    replaces them; reading adds the parts up. No state is kept, so nothing has to expire and no row is too late."""
    base = scratch(spark, "hours")
    d = norm_names(read_stream(spark, path)).where("type = 'data' AND received_at IS NOT NULL")

    def write(batch: DataFrame, number: int) -> None:
        hour = (floor_div("received_at", HOUR_MS * 1_000_000) * HOUR_MS).alias("hour_start_ms")
        batch.groupBy(*KEYS, hour).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    d.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("exchange string, symbol string, stream string, hour_start_ms bigint, n bigint, batch bigint").parquet(f"{base}/out")
    return out.groupBy(*KEYS, "hour_start_ms").agg(F.sum("n").alias("n"))


def archive(df: DataFrame, base: str, checkpoint: str, sealed_before_ns: int | Callable[[], int | None] | None = None, trigger: str = "30 seconds", files_of_hour: int = 1):
    """Continuous archive in Parquet by exchange, symbol, stream, date and hour; rows of an hour that is already
    sealed go to its late part and are never dropped. One folder for each batch and kind, so a retry replaces it, and
    files_of_hour files for each hour in it. sealed_before_ns may be a function, which each batch asks anew."""
    folder = [*KEYS, "date", "hour", "part"]

    def write(batch: DataFrame, batch_id: int) -> None:
        sealed = sealed_before_ns() if callable(sealed_before_ns) else sealed_before_ns
        late = F.lit(False) if sealed is None else F.coalesce(F.col("received_at") < sealed, F.lit(False))
        d = norm_names(batch).withColumns({"date": ns_date("received_at"), "hour": ns_hour("received_at"), "part": F.when(late, "late").otherwise("base")})
        d = d.withColumn("_salt", F.pmod(F.xxhash64("received_at"), F.lit(files_of_hour))).repartition(*folder, "_salt").drop("_salt")
        d.write.mode("overwrite").partitionBy(*folder).option("compression", "zstd").parquet(f"{base}/batch={batch_id}")

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if trigger == "once" else w.trigger(processingTime=trigger)).start()


class ParkedGaps:
    """Gap envelopes of a stream parked for a grace, as in coverage.suppress_covered: covered once the other source
    delivers on the stream after the gap's start, uncovered when the grace is over by the clock, which is the latest
    arrival on any stream, so a stream that falls silent keeps no gap back. One that isn't parked is given at once.

    Each micro-batch reads the state that the one before wrote (the sources' last arrivals, the parked gaps) and writes
    its own result and state under its number, so a retry replaces both; nothing is held in memory and no row is
    dropped for being late. Whole envelopes come out, with covered; equal starts of a source are one gap with the
    first one's fields and the greatest end. flush gives what is still parked as uncovered.

    rows: exchange, symbol, stream, type, source, received_at, gap_start_ts, gap_end_ts, reason and any other columns.
    """

    def __init__(self, spark: SparkSession, base: str, grace_ns: int = 10_000_000_000):
        self.spark, self.base, self.grace_ns = spark, base.rstrip("/"), grace_ns

    def follow(self, rows: DataFrame, checkpoint: str):
        """Starts the query over what the stream has now."""
        return rows.writeStream.foreachBatch(self._step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def read(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.base}/out").drop("batch", "_parked")

    def flush(self) -> DataFrame:
        last = max((int(x.split("=")[1]) for x in list_dirs(self.spark, f"{self.base}/parked")), default=None)
        if last is not None:
            d = self.spark.read.parquet(f"{self.base}/parked/batch={last}")
            d.drop("_parked").withColumn("covered", F.lit(False)).write.mode("overwrite").parquet(f"{self.base}/out/batch={last + 1}")
        return self.read()

    def _step(self, batch: DataFrame, number: int) -> None:
        keys = [*KEYS, "source"]
        data = batch.where("type = 'data' AND source IS NOT NULL AND received_at IS NOT NULL").select(*keys, "received_at")
        new = batch.where("type = 'gap' AND gap_start_ts IS NOT NULL").withColumn("_parked", F.lit(False))
        last = data
        top = batch.agg(F.max("received_at").alias("received_at"))
        if number:
            seen = self.spark.read.parquet(f"{self.base}/last/batch={number - 1}")
            last = seen.where("source IS NOT NULL").unionByName(data)
            top = top.unionByName(seen.where("source IS NULL").select("received_at"))
            new = new.unionByName(self.spark.read.parquet(f"{self.base}/parked/batch={number - 1}"))
        rest = [c for c in new.columns if c not in (*keys, "gap_start_ts", "gap_end_ts")]
        one = F.min_by(F.struct(*rest), F.struct("received_at", "gap_end_ts")).alias("r")
        gaps = new.groupBy(*keys, "gap_start_ts").agg(one, F.max("gap_end_ts").alias("gap_end_ts")).select(*keys, "gap_start_ts", "gap_end_ts", "r.*")
        gaps = gaps.withColumn("gap_no", F.xxhash64(*keys, "gap_start_ts"))
        clock = top.agg(F.max("received_at")).first()[0]
        judged = coverage.suppress_covered(gaps, last, self.grace_ns, parked="_parked")
        waits = F.col("parked") & ~F.col("covered") & (F.col("received_at") + self.grace_ns >= F.lit(clock))
        judged = write_cut(judged.withColumn("_waits", F.coalesce(waits, F.lit(False))), "judged", self.spark)
        judged.where("NOT _waits").select(*batch.columns, "covered").write.mode("overwrite").parquet(f"{self.base}/out/batch={number}")
        judged.where("_waits").select(*batch.columns).withColumn("_parked", F.lit(True)).write.mode("overwrite").parquet(f"{self.base}/parked/batch={number}")
        now = self.spark.range(1).select(*(F.lit(None).cast("string").alias(c) for c in keys), F.lit(clock).cast("long").alias("received_at"))
        last.groupBy(*keys).agg(F.max("received_at").alias("received_at")).unionByName(now).write.mode("overwrite").parquet(f"{self.base}/last/batch={number}")
        drop_cut(judged)


# Most rows that a producer holds back by stream.
BUFFER_CAPS = {"depth": 80_000, "trades": 10_000}
BUFFER_CAP = 10_000


def within_caps(pending: DataFrame, keys: list[str], order: list[str], block: str, caps: dict[str, int] | None = None) -> DataFrame:
    """pending rows (sent ones are gone already) with dropped: whether a producer's buffer of the stream's size had no
    room for the row. The numbering runs over blocks, so no key lies in one task."""
    limit = F.create_map(*(x for k, v in (caps or BUFFER_CAPS).items() for x in (F.lit(k), F.lit(v))))
    d = ordered.running_sum(pending.withColumn("_one", F.lit(1).cast("long")), keys, block, order, "_one", "_n")
    return d.withColumn("dropped", F.col("_n") > F.coalesce(F.try_element_at(limit, F.col("stream")), F.lit(BUFFER_CAP))).drop("_one", "_n", "_at_" + "_".join([*keys, block]))


def overflow_gaps(rows: DataFrame, keys: list[str], time: str, block_width: int) -> DataFrame:
    """A buffer_overflow gap for each run of dropped rows of a stream: from the first dropped to the first that was
    taken again (null: still overflowing), and how many were dropped."""
    w = coverage.condition_windows(rows, keys, time, "dropped", block_width)
    taken = rows.where(~F.col("dropped")).select(*keys, F.col(time).alias("t"), F.col(time).alias("hit"))
    u = w.select(*keys, F.col("end").alias("t"), F.lit(None).cast("long").alias("hit"), "start", "n").unionByName(taken.withColumns({"start": F.lit(None).cast("long"), "n": F.lit(None).cast("long")}))
    u = u.withColumn("rt", -F.col("t")).withColumns({"block": floor_div("rt", block_width), "is_window": F.col("hit").isNull().cast("int")})
    u = ordered.last_known(u, keys, "block", ["rt", "is_window"], "hit", "back")
    # Fixed value: the text of overflow gaps.
    text = F.format_string("Producer buffer was full; %d messages dropped for %s/%s", "n", "stream", "symbol")
    return u.where("start IS NOT NULL").select(*keys, F.col("start").alias("gap_start_ts"), F.col("back").alias("gap_end_ts"), F.lit("buffer_overflow").alias("reason"), text.alias("detail"))
