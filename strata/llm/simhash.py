"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

1. A map over whole texts makes the fingerprints (numpy bit counts over XXH64
   of the word shingles). Only (doc_id, fingerprint) is kept.
2. Distinct fingerprints are dealt into tiles of one population count each and
   bounded size. Two fingerprints within the radius differ in population count
   by at most the radius, so only such tile pairs are compared: exclusive-or
   and bit counts in numpy, inside the pair once more skipping blocks whose
   population counts of the upper and lower half differ beyond the radius.
3. A tile pair gives a spanning forest of its links, never all its pairs; the
   forests are united by connected components.

Every pair within the radius is compared or provably beyond it, so no link is
lost. The work of step 2 grows with the square of the distinct fingerprints.

Defined cases: null and empty texts and texts without a word have fingerprint 0
and link like any other; repeated rows each come back; a null doc_id comes back
with its fingerprint and takes part under the smallest long; other columns of
the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, forest, map_columns
from strata.llm.components import components

SEED = 42
#: fingerprints in a tile; a tile pair compares at most the square of it, and a tile is sent to each of its partners
TILE = 65_536
#: fingerprints in a block of a tile
BLOCK = 1_024


def fingerprint(text: str | None, shingle: int) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([h(b" ".join(words), SEED)], dtype=np.uint64)
        counts, n = np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        n = len(words) - shingle + 1
        stops = (ends[shingle - 1:] - 1).tolist()
        counts = np.zeros(64, np.int64)
        for i in range(0, n, 1 << 16):
            part = slice(i, min(n, i + (1 << 16)))
            hashes = np.array([h(line[a:b], SEED) for a, b in zip(starts[part].tolist(), stops[part])], np.uint64)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, mark: Column | None = None) -> DataFrame:
    """doc_id, fp (the unsigned 64-bit fingerprint as a long) and `mark`, a long of the row (0 if none is given)."""
    mark = F.lit(0).cast("long") if mark is None else mark

    def run(cols: dict) -> dict:
        fp = np.array([fingerprint(t, shingle) for t in cols["text"]], np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "fp": fp, "mark": cols["mark"]}

    return map_columns(docs.select("doc_id", "text", mark.alias("mark")), run, "doc_id long, fp long, mark long")


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.bitwise_count(fp & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.bitwise_count(fp >> np.uint64(32)).astype(np.int64), low


def compare(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between fingerprints of a and b (None: within a), as index pairs into a + b."""
    both = a if b is None else np.concatenate((a, b))
    parent = np.arange(len(both))

    def blocks(fp: np.ndarray, shift: int) -> list[tuple]:
        high, low = _halves(fp)
        order = np.lexsort((low, high))
        out = []
        for i in range(0, len(order), BLOCK):
            o = order[i:i + BLOCK]
            out.append((fp[o], o + shift, high[o[0]], high[o[-1]], low[o].min(), low[o].max()))
        return out

    left = blocks(a, 0)
    right = left if b is None else blocks(b, len(a))
    for i, (fa, ia, h0, h1, l0, l1) in enumerate(left):
        for fb, ib, g0, g1, m0, m1 in (right[i:] if b is None else right):
            if max(0, g0 - h1, h0 - g1) + max(0, m0 - l1, l0 - m1) > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(fa[:, None] ^ fb[None, :]) <= radius)
            if len(x):
                parent = forest(len(both), ia[x], ib[y], parent)
    moved = np.flatnonzero(parent != np.arange(len(both)))
    return list(zip(moved.tolist(), parent[moved].tolist()))


def links(scratch: Scratch, fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (a, b) whose components are those of all links within `radius` bits
    among the distinct rows (fp, node). Ends are nodes."""
    spark = fps.sparkSession
    fps = fps.select("fp", "node", F.bit_count("fp").cast("int").alias("pc"))
    # at most 65 rows come to the driver
    tiles = {r["pc"]: -(-r["n"] // tile) for r in fps.groupBy("pc").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not tiles:
        return spark.createDataFrame([], "a long, b long")
    first, total = {}, 0
    for pc in sorted(tiles):
        first[pc], total = total, total + tiles[pc]
    schema = "pc int, first int, n int"
    law = F.broadcast(spark.createDataFrame([(p, first[p], tiles[p]) for p in tiles], schema))
    rows = fps.join(law, "pc").withColumn(
        "t", F.col("first") + F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    blob = scratch.write(rows.groupBy("t", "pc").agg(F.collect_list("fp").alias("fps"),
                                                     F.collect_list("node").alias("nodes")), "tiles")
    # partners: the same tile, later tiles of the same count, tiles of the next `radius` counts
    reach = {p: max(first[q] + tiles[q] for q in tiles if p <= q <= p + radius) for p in tiles}
    span = F.broadcast(spark.createDataFrame([(p, min(first[q] for q in tiles if p - radius <= q), first[p], reach[p])
                                              for p in tiles], "pc int, low int, start int, stop int"))
    t = blob.join(span, "pc")
    pairs = t.select("t", F.explode(F.sequence(F.col("low"), F.col("stop") - 1)).alias("other"), "fps", "nodes")
    pairs = pairs.select(F.least("t", "other").alias("i"), F.greatest("t", "other").alias("j"), "t", "fps", "nodes")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        sides = [(np.asarray(f, np.int64).view(np.uint64), np.asarray(n, np.int64))
                 for f, n in zip(pdf["fps"], pdf["nodes"])]
        own = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        if not own and len(sides) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        found = compare(sides[0][0], None if own else sides[1][0], radius)
        nodes = sides[0][1] if own else np.concatenate((sides[0][1], sides[1][1]))
        u, v = np.array([x for x, _ in found], int), np.array([y for _, y in found], int)
        return pd.DataFrame({"a": nodes[u], "b": nodes[v]})

    return pairs.groupBy("i", "j").applyInPandas(run, T.StructType(
        [T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, fp (long), component_id (smallest doc_id reachable by links)."""
    scratch = Scratch(docs.sparkSession)
    fps = scratch.write(fingerprints(docs, shingle), "simhash")
    low = F.coalesce(F.min("doc_id"), F.lit(-(1 << 63)))
    distinct = scratch.write(fps.groupBy("fp").agg(low.alias("node")), "distinct")
    edges = scratch.write(links(scratch, distinct, radius, tile), "links")
    comp = scratch.write(components(scratch, edges), "components")
    named = distinct.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each group the one of smallest doc_id stays.

    Groups are those of the texts, whatever their ids: unlike texts without an id, or that
    share one, are documents of their own. Of a group's texts of smallest doc_id (a null
    is the smallest) one stays, and of equal rows of it one."""
    scratch = Scratch(docs.sparkSession)
    fps = scratch.write(fingerprints(docs, shingle, F.xxhash64("text")), "simhash")
    distinct = scratch.write(fps.select("fp", F.col("fp").alias("node")).distinct(), "distinct")
    edges = scratch.write(links(scratch, distinct, radius), "links")
    comp = components(scratch, edges).select(F.col("node").alias("fp"), "component")
    # a third of all texts may be alike: each task sends one row of a group
    first = fps.groupBy("fp").agg(F.min(F.struct("doc_id", "mark")).alias("first")).join(comp, "fp", "left").groupBy(
        F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    kept = scratch.write(first.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark")), "kept")
    own = docs.withColumn("_own", F.xxhash64("text"))
    out = own.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_mark")),
                   "left_semi")
    one = Window.partitionBy("doc_id", "_own").orderBy(F.col("text").asc_nulls_first())
    return out.withColumn("_nth", F.row_number().over(one)).filter("_nth = 1").select(*docs.columns)


def simhash_hex(c: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(c)), 16, "0"))
