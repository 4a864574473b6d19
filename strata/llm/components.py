"""Connected components of an edge table, as Spark joins.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each round links every vertex to the
smallest neighbour it knows. All rounds run on the cluster; only a count and a
checksum per round come to the driver. A hub's neighbours are never gathered:
the smallest one is a partially aggregated minimum, joined back on the hub."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch


def components(scratch: Scratch, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`edges` (a, b: long) to (node, component): the smallest node reachable.

    Only nodes with an edge appear. Self-loops, repeats and either direction are
    allowed; null ends are left out; an empty table gives an empty one.
    Raises if `max_rounds` (far above log² of any table) do not suffice."""
    e = _clean(edges.select("a", "b").dropna())
    cur = scratch.write(e, "edges")
    state = None
    for _ in range(max_rounds):
        large = _star(cur, larger=True)
        small = scratch.write(_star(large, larger=False), "edges")
        now = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(cur)
        cur = small
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not converge")
    # a fixed point is a set of stars: (member a, centre b) with b < a
    members = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(centres)


def _clean(e: DataFrame) -> DataFrame:
    return (e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a <> b").distinct())


def _star(e: DataFrame, larger: bool) -> DataFrame:
    """Large-star: link strictly larger neighbours of each vertex to its smallest
    known vertex. Small-star: link smaller neighbours and the vertex itself to it."""
    both = e.select("a", "b")
    if larger:
        both = both.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select("a", F.least("a", "m").alias("m"))
    j = both.join(low, "a")
    if larger:
        out = j.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return _clean(out)
