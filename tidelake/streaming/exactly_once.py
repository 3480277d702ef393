"""Exactly one copy of each message out of an at-least-once delivery, by a keyed state of seen identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators.components import min_labels
from tidelake.runtime import list_dirs, make_dir, path_exists, remove_path, scratch, write_cut

OUT = "kind string, h1 long, h2 long, row_id long, owner long"
STATE = "h1 binary, h2 binary, owner binary, seen_ms binary"
FOLD = 200_000  # rows of a shard that are taken into its state at once
COLUMNS = ("h1", "h2", "row_id", "seen_ms")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def identifier(kind: str, *parts: Column) -> Column:
    """128-bit identity of the parts, null if any part is null. Two independent 64-bit hashes of the values."""
    whole = parts[0].isNotNull()
    for p in parts[1:]:
        whole = whole & p.isNotNull()
    h1 = F.xxhash64(F.lit(kind), *parts)
    h2 = F.xxhash64(F.lit("second"), *reversed(parts), F.lit(kind))
    return F.when(whole, F.struct(h1.alias("h1"), h2.alias("h2")))


def _fold(hot: list[np.ndarray], parts: list[pd.DataFrame]) -> tuple[list[np.ndarray], tuple, tuple]:
    """The sorted identifiers of a shard with new rows taken in: (identifiers, links, identifiers that are new)."""
    new = [np.concatenate([f[c].to_numpy(np.int64) for f in parts]) for c in COLUMNS]
    n = len(hot[0])
    h1, h2, row, ms = (np.concatenate([a, b]) for a, b in zip(hot, new))
    fresh = np.arange(len(h1)) >= n
    order = np.lexsort((row, fresh, h2, h1))  # of an identifier the state's entry first, else its least row
    h1, h2, row, ms, fresh = h1[order], h2[order], row[order], ms[order], fresh[order]
    first = np.ones(len(h1), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    at = np.flatnonzero(first)
    owner = row[at][np.cumsum(first) - 1] if len(at) else row
    extra = fresh & ~first & (row != owner)
    opened = fresh & first
    ms = np.maximum.reduceat(ms, at) if len(at) else ms[:0]
    return [h1[at], h2[at], row[at], ms], (h1[extra], h2[extra], row[extra], owner[extra]), (h1[opened], h2[opened], row[opened], row[opened])


def _seen(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterable[pd.DataFrame]:
    """One shard of the state store in one micro-batch: sorted identifiers with the row that owns each.

    link: a row whose identifier an earlier row owns. opened: an identifier that the state doesn't hold, with its
    first row as owner. Identifiers that the watermark has passed leave the state; one that comes again after that
    is opened again, which the lookup finds.
    """
    hot = [np.frombuffer(x, np.int64) for x in state.get] if state.exists else [np.zeros(0, np.int64) for _ in COLUMNS]
    waiting: list[pd.DataFrame] = []
    rows = 0

    def take() -> Iterator[pd.DataFrame]:
        nonlocal hot, waiting, rows
        hot, links, opened = _fold(hot, waiting)
        waiting, rows = [], 0
        for kind, (a, b, r, o) in (("link", links), ("opened", opened)):
            if len(r):
                yield pd.DataFrame({"kind": kind, "h1": a, "h2": b, "row_id": r, "owner": o})

    for f in frames:
        if len(f):
            waiting.append(f)
            rows += len(f)
        if rows >= FOLD:
            yield from take()
    if waiting:
        yield from take()
    keep = hot[3] >= state.getCurrentWatermarkMs()
    state.update(tuple(x[keep].tobytes() for x in hot))


def message_links(spark: SparkSession, stream: DataFrame, row_id: str, received_ns: str, identifiers: list[Column], watermark: str = "6 hours", shards: int = 256, checkpoint: str | None = None) -> DataFrame:
    """(row_id, owner) for each row that shares an identifier with an owner, of a streaming DataFrame.

    Runs what is available and returns all links so far; with `checkpoint` a later call goes on where this one ended.

    The state (RocksDB, unless the session names another store) holds the identifiers whose last copy isn't older
    than the watermark, in `shards` sorted blocks, and nothing else: it is as large as what arrives within the
    watermark, whatever came before. `shards` should leave a block some 100,000 identifiers; it can't change with a
    checkpoint. Each identifier that enters the state is written out with its first row (opened). One that comes
    again after it left is opened a second time; the lookup, an equi-join of what a run opened with what all runs
    opened (whose files are never changed), links the two, so late copies of any age are found and none is dropped.
    State, offsets and output commit together for each micro-batch: the output is exactly once, whatever is
    restarted. Rows of a hot identifier pass through its shard in portions; their number needs no memory.
    """
    base = checkpoint or scratch(spark, "exactly-once")
    run = _next_run(spark, base, shards)
    ms = F.coalesce(F.call_function("div", F.col(received_ns), F.lit(1_000_000).cast("long")), F.lit(0).cast("long"))
    ids = stream.where(F.col(row_id).isNotNull()).select(F.col(row_id).cast("long").alias("row_id"), ms.alias("seen_ms"), F.timestamp_millis(ms).alias("at"), F.explode(F.array_compact(F.array(*identifiers))).alias("i"))
    ids = ids.select("row_id", "seen_ms", "at", "i.h1", "i.h2", F.pmod("i.h1", F.lit(shards).cast("long")).alias("shard")).withWatermark("at", watermark)
    kept = ids.groupBy("shard").applyInPandasWithState(_seen, OUT, STATE, "append", "NoTimeout").withColumn("run", F.lit(run))
    with state_store(spark):
        q = kept.writeStream.format("parquet").partitionBy("kind", "run").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.schema(f"{OUT}, run int").parquet(f"{base}/out")
    opened = out.where("kind = 'opened'").select("h1", "h2", "owner", "run")
    new = opened.where(F.col("run") == run)
    firsts = new.groupBy("h1", "h2").agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
    late = new.join(firsts.where("first <> last").select("h1", "h2", "first"), ["h1", "h2"]).where("owner <> first").select(F.col("owner").alias("row_id"), F.col("first").alias("owner"))
    if run:
        before = opened.where(F.col("run") < run).select("h1", "h2", "owner").join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).where("owner <> first")
        late = late.unionByName(before.groupBy(F.col("first").alias("row_id")).agg(F.min("owner").alias("owner")))
    late.write.mode("overwrite").parquet(f"{base}/late/run={run}")
    every = spark.read.schema("row_id long, owner long, run int").parquet(f"{base}/late")
    return out.where("kind = 'link'").select("row_id", "owner").unionByName(every.where(F.col("run") <= run).select("row_id", "owner"))


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """RocksDB as the state store of queries started inside, unless the session names one."""
    name = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.getAll.get(name) or spark.sparkContext.getConf().get(name)
    if not given:
        spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if not given:
            spark.conf.unset(name)


def _next_run(spark: SparkSession, base: str, shards: int) -> int:
    """The number of the run that begins: runs whose lookup was written are over. The folder of run 0 names the shards."""
    done = [x for x in list_dirs(spark, f"{base}/late") if path_exists(spark, f"{base}/late/{x}/_SUCCESS")]
    told = list_dirs(spark, f"{base}/shards")
    if told and told != [str(shards)]:
        raise ValueError(f"the checkpoint has {told[0]} shards, not {shards}")
    if not told:
        make_dir(spark, f"{base}/shards/{shards}")
    return len(done)


def repeated_rows(spark: SparkSession, stream: DataFrame, row_id: str, received_ns: str, identifiers: list[Column], **options) -> DataFrame:
    """(row_id, kept): every row that isn't the least of its message, with the one that is.

    Two rows are one message if they share any identifier, directly or through further rows.
    Defined cases: a row without any identifier is a message of its own; a null received_ns is as late as can
    be; rows with null row_id are left out; a row that comes twice with the same row_id is one row; other
    columns are ignored; an empty stream gives none.
    """
    given = options.pop("checkpoint", None)
    base = given or scratch(spark, "exactly-once")
    links = write_cut(message_links(spark, stream, row_id, received_ns, identifiers, checkpoint=base, **options), "links", spark)
    if given is None:
        remove_path(spark, base)  # nothing goes on from it
    return min_labels(links, "row_id", "owner").select(F.col("node").alias("row_id"), F.col("label").alias("kept"))


def exactly_once(rows: DataFrame, repeated: DataFrame, row_id: str) -> DataFrame:
    """Exactly one row of each message: rows without those of repeated_rows, and one of rows that have a row_id twice.
    Rows with null row_id are messages of their own and stay. Both joins are by row_id, which spreads any hot message."""
    known = F.col(row_id).isNotNull()
    gone = repeated.select(F.col("row_id").alias("_gone"))
    one = rows.where(known).dropDuplicates([row_id]).join(gone, F.col(row_id) == F.col("_gone"), "left_anti")
    return one.unionByName(rows.where(~known))


def read_stream(spark: SparkSession, path: str, batch_bytes: int = 64 << 20) -> DataFrame:
    """A Parquet folder or file as a stream of micro-batches of about so many bytes of files."""
    schema = spark.read.parquet(path).schema
    path = path.rstrip("/")
    # A pattern that matches just this path: without one the source takes folders only.
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(f"{path[:-1]}[{path[-1]}]")


def as_arrivals(rows: DataFrame, order: str, batches: int = 4) -> tuple[DataFrame, str]:
    """(stream, folder): rows as a stream of so many micro-batches in the order in which they were stored. They are
    written once, with the columns they have; the folder may be removed after the stream has run."""
    spark = rows.sparkSession
    at = scratch(spark, "arrivals")
    rows.repartitionByRange(batches, order).sortWithinPartitions(order).write.parquet(at)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(at), at


def envelope_identifiers() -> list[Column]:
    """An envelope's identities: session and sequence number of its stream, and broker coordinates."""
    from tidelake.functions.names import NAMES, norm

    seq = F.when(F.col("session_seq") >= 0, F.col("session_seq"))
    off = F.when(F.col("_offset") >= 0, F.col("_offset"))
    return [identifier("session", *(norm(c) for c in NAMES), F.col("collector_session_id"), seq), identifier("broker", F.col("_topic"), F.col("_partition"), off)]
