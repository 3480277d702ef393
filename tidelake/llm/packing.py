"""Filling of fixed-capacity sequences with documents, by conflict-constrained best fit."""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_TOKENS = 8_000_000
NO_ID = -(2**63)
OUT = "budget_name string, sequence_id long, doc_id long, piece int, start_token long, n_tokens long"


class Bins:
    """Open bins by the room they have left; each carries a bitmap of its sources and one of its clusters."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, dict[int, list[int]]] = {}  # room -> bitmap of sources -> bins
        self.rooms = 0  # bit r: some bin has room r
        self.clusters: list[int] = []

    def find(self, size: int, source: int, cluster: int, least: int = 0) -> tuple[int, int] | None:
        """The bin that the item goes into and the room it had; None if no bin takes it.

        Successor search over the rooms from `least` up: the tightest bin with no item of the cluster (0: any)
        takes it; among equally tight ones one without the source, if there is any.
        """
        first = max(size, least)
        left = self.rooms >> first
        while left:
            room = first + (left & -left).bit_length() - 1
            kinds = self.by_room[room]
            for fresh in (True, False):
                for sources in [s for s in kinds if (s & source == 0) == fresh]:
                    bins = kinds[sources]
                    for i in range(len(bins) - 1, -1, -1):
                        b = bins[i]
                        if not self.clusters[b] & cluster:
                            bins[i] = bins[-1]
                            bins.pop()
                            if not bins:
                                del kinds[sources]
                                if not kinds:
                                    del self.by_room[room]
                                    self.rooms &= ~(1 << room)
                            self.put(b, room - size, sources | source, cluster)
                            return b, room
            left &= left - 1
        return None

    def open(self, size: int, source: int, cluster: int) -> int:
        self.clusters.append(0)
        self.put(len(self.clusters) - 1, self.capacity - size, source, cluster)
        return len(self.clusters) - 1

    def put(self, b: int, room: int, sources: int, cluster: int) -> None:
        self.clusters[b] |= cluster
        if room:
            self.by_room.setdefault(room, {}).setdefault(sources, []).append(b)
            self.rooms |= 1 << room


def pack(items: Iterable[tuple[int, int, int, int]], capacity: int, relaxed: bool = False) -> list[tuple[int, int, int, int, int]]:
    """(doc_id, size, source, cluster) into (bin, doc_id, piece, start, size); no item of 0 size.

    Best fit: first the items of clusters with several members, largest first, then all others, largest first, which
    fill what room is left. Two items of a cluster never share a bin; where every bin with room holds the cluster, a
    new one is opened. Sources only decide between equally tight bins.

    relaxed: no second pass for others; and where no bin without the cluster has room, a new one is opened only while
    there are fewer bins than the tokens need; beyond that the item goes into the tightest bin of all. So no room is
    lost to a text that has more copies than there are bins.
    """
    out, rest, n_full, total = [], [], 0, 0
    for doc, size, source, cluster in items:
        full, tail = divmod(size, capacity)
        for p in range(full):
            out.append((n_full, doc, p, p * capacity, capacity))
            n_full += 1
        if tail:
            rest.append((tail, cluster, doc, full, source))
            total += tail
    copies = Counter(x[1] for x in rest)
    rest.sort(key=lambda x: (not relaxed and copies[x[1]] == 1, -x[0], x[1], x[2]))
    needed = math.ceil(total / capacity) if relaxed else math.inf
    bits: dict[int, int] = {}
    sources: dict[int, int] = {}
    bins = Bins(capacity)
    run, from_room, apart = None, 0, True
    for size, cluster, doc, full, source in rest:
        bit = bits.setdefault(cluster, 1 << len(bits)) if copies[cluster] > 1 else 0
        src = sources.setdefault(source, 1 << len(sources))
        if run != (cluster, size):
            # Of a run of equal copies each search goes on at the room where the one before ended: tighter bins
            # hold the text already; and once no bin is free of it, none will be for the rest of the run.
            run, from_room, apart = (cluster, size), 0, True
        got = bins.find(size, src, bit, from_room) if apart else None
        if got:
            b, from_room = got[0], got[1] if bit else 0
        else:
            apart = not bit
            b = bins.open(size, src, bit) if not bit or len(bins.clusters) < needed else None
            if b is None:
                got = bins.find(size, src, 0)
                b = got[0] if got else bins.open(size, src, bit)
                if got:
                    bins.clusters[b] |= bit
        out.append((n_full + b, doc, full, full * capacity, size))
    return out


def pack_documents(sizes: DataFrame, budgets: DataFrame, shard_tokens: int = SHARD_TOKENS, relaxed: bool = False) -> DataFrame:
    """Every document's place in the sequences of every budget.

    Input: sizes (doc_id, n_tokens, source, cluster), written beforehand as it is read twice; budgets
    (budget_name, capacity_tokens). Output: budget_name, sequence_id, doc_id, piece, start_token, n_tokens.

    The documents are spread by a hash of doc_id over shards of about shard_tokens tokens; each shard is packed
    by itself into the tightest sequence that holds nothing of the same cluster (see pack, also for relaxed). A shard
    wastes about one sequence; at 8,000,000 tokens and 8,192 a sequence that is 0.1 %. Members of one cluster (exact
    copies, or near-duplicates if cluster says so), however many, spread over all shards like any other documents; a
    text with more copies than sequences takes a sequence for each copy, unless relaxed.

    Defined cases: a document of more than the capacity is cut into full sequences and a rest; documents of no
    tokens (null or empty text) have one row with null sequence_id, piece 0 and n_tokens 0; a null source is a
    source; a null cluster is a text without copies; a null doc_id stays null (the least long stands for it
    meanwhile); budgets with null or non-positive capacity are left out, and any number of budgets is taken; repeated doc_ids are packed as items of
    their own; an empty table gives no rows.
    """
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_tokens))
    b = budgets.where("capacity_tokens > 0").select("budget_name", "capacity_tokens").distinct()
    caps = [(r[0], r[1]) for r in b.collect()]
    if not caps:
        return sizes.sparkSession.createDataFrame([], OUT)
    every = F.explode(F.from_json(F.lit(json.dumps([{"budget_name": n, "capacity": c} for n, c in caps])), "array<struct<budget_name:string,capacity:int>>"))
    doc = F.coalesce("doc_id", F.lit(NO_ID).cast("long")).alias("doc_id")
    cluster = F.coalesce("cluster", F.xxhash64(F.lit("own"), "doc_id")).alias("cluster")
    rows = sizes.select(doc, F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), F.coalesce(F.xxhash64("source"), F.lit(0)).alias("source"), cluster, F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)).alias("shard"), every.alias("b"))
    rows = rows.select("doc_id", "n_tokens", "source", "cluster", "shard", "b.*")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, shard, capacity = key
        placed = pack(zip(pdf["doc_id"].tolist(), pdf["n_tokens"].tolist(), pdf["source"].tolist(), pdf["cluster"].tolist()), int(capacity), relaxed)
        out = pd.DataFrame(placed, columns=["sequence_id", "doc_id", "piece", "start_token", "n_tokens"])
        out["sequence_id"] += int(shard) << 32
        out.insert(0, "budget_name", name)
        return out

    # A partition for each shard and budget: adaptive execution would put many shards into one task by their bytes.
    spread = rows.where("n_tokens > 0").repartition(min(10_000, shards * len(caps)), "budget_name", "shard", "capacity")
    packed = spread.groupBy("budget_name", "shard", "capacity").applyInPandas(run, OUT)
    none = rows.where("n_tokens <= 0").select("budget_name", F.lit(None).cast("long").alias("sequence_id"), "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start_token"), F.lit(0).cast("long").alias("n_tokens"))
    out = packed.unionByName(none)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
