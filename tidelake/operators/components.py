"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.runtime import drop_cut, write_cut


def min_labels(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node that isn't the least of its component; label is the least node.

    Rounds of large-star and small-star contraction (Kiveris et al., "Connected Components in MapReduce and
    Beyond", 2014): each takes minima by aggregation and a join with them, no adjacency list is ever collected;
    the number of rounds grows with the logarithm of the chains' length. Each round is written to the shared
    folder, which cuts the lineage. Only two sums reach the driver.

    Defined cases: null ends and self-edges are left out; repeated edges count once; no edges give no rows.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    now = write_cut(now, "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        new = write_cut(_small_star(_large_star(now)), "edges")
        after = _state(new)
        drop_cut(now)
        now = new
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("the contraction did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _state(e: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(e.agg(F.count("*"), F.sum(h)).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the least of its neighbourhood."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))  # of a node with smaller neighbours; else it is the least itself
    j = e.join(least.withColumnRenamed("u", "v"), "v", "left")
    return j.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    j = e.join(least, "u")
    return j.select("u", F.col("m").alias("v")).union(j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
