"""Embedding near-duplicates by a forest of random-projection trees.

1. Equal vectors collapse into one with a count.
2. Trees are fitted on a bounded sample: each node splits along a random direction
   at the sample's middle, and the ranks around the middle spill into both sides.
   Every vector is placed into its leaves of every tree.
3. A leaf compares its vectors by exact cosine in double precision and gives a
   spanning forest of its links. A leaf that outgrew the sample's resolution is cut
   into tiles whose pairs are compared, so none is capped.
4. Connected components unite the leaves' links. Links are then counted inside each
   component, exactly and in tiles, so a pair that fell into no common leaf counts
   when its component was found. Pairs are never written out.

A link is missed only if its ends share no leaf and no chain of found links.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing; vectors of different length do not link; repeated
rows each come back and count as links of each other; rows of one vec_id with
different vectors count as one node; a null vec_id counts as the smallest long in
component_id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, forest as join_all
from strata.llm.components import components

#: trees, share of a node's ranks that spill, vectors wanted in a leaf, bound of the fitting sample, tile
TREES, SPILL, LEAF, SAMPLE, TILE = 5, 0.2, 1_024, 50_000, 2_048
BLOCK = 512


def unit(raw: list[bytes], dtype: str) -> np.ndarray:
    """Rows of unit length in double precision, from vectors of one length."""
    v = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def prepared(emb: DataFrame) -> tuple[DataFrame, str]:
    """vec_id and raw (the components as bytes; null if the vector links with nothing)."""
    kind = emb.schema["embedding"].dataType
    dtype = "<f4" if isinstance(getattr(kind, "elementType", None), T.FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for x in batch.column(1):
                v = np.array(x.as_py() or [], dtype=np.float64)  # a null component becomes NaN
                raw.append(v.astype(dtype).tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    cols = emb.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    return cols.mapInArrow(run, "vec_id long, raw binary"), dtype


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    return np.random.default_rng([11, tree, node]).standard_normal(dim)


def fit(v: np.ndarray, tree: int, scale: float, leaf: int, spill: float) -> dict[int, tuple[float, float]]:
    """Thresholds (low, high) of the inner nodes of one tree; children of k are 2k and 2k + 1."""
    out, todo = {}, [(1, np.arange(len(v)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) * scale <= leaf or len(rows) < 16:
            continue
        x = v[rows] @ direction(tree, node, v.shape[1])
        low, high = np.quantile(x, [0.5 - spill / 2, 0.5 + spill / 2])
        left, right = rows[x <= high], rows[x >= low]
        if len(left) == len(rows) or len(right) == len(rows):
            continue  # nothing to part; tiles compare it
        out[node] = (float(low), float(high))
        todo += [(2 * node, left), (2 * node + 1, right)]
    return out


def leaves(v: np.ndarray, tree: int, law: dict[int, tuple[float, float]]) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows of v) of one tree."""
    todo = [(1, np.arange(len(v)))]
    while todo:
        node, rows = todo.pop()
        if node not in law:
            yield node, rows
            continue
        x = v[rows] @ direction(tree, node, v.shape[1])
        low, high = law[node]
        todo += [(2 * node, rows[x <= high]), (2 * node + 1, rows[x >= low])]


def _tiled(rows: DataFrame, key: list[str], tile: int) -> DataFrame:
    """Each row once for every pair (i, j) of its group's tiles that holds its own tile."""
    n = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    d = rows.join(n, key).withColumn("tile", F.pmod(F.xxhash64("node", "raw"), F.col("tiles")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return d.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})


def _sides(pdf: pd.DataFrame, dtype: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers and links of a tile pair, block by block: (ia, ib, x, y, same)."""
    v = unit(list(pdf["raw"]), dtype)
    tile, i, j = pdf["tile"].to_numpy(), pdf["i"].iloc[0], pdf["j"].iloc[0]
    a, b = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    for p in range(0, len(a), BLOCK):
        for q in range(p if i == j else 0, len(b), BLOCK):
            ia, ib = a[p:p + BLOCK], b[q:q + BLOCK]
            yield ia, ib, v[ia] @ v[ib].T, i == j and p == q


def links(scratch: Scratch, distinct: DataFrame, dtype: str, threshold: float, trees: int, leaf: int, sample: int,
          spill: float, tile: int) -> DataFrame:
    """Edges (a, b) of nodes: spanning forests of the links found in the leaves."""
    spark = distinct.sparkSession
    n = distinct.count()
    step = max(1, n // sample)
    fitted = [r["raw"] for r in distinct.filter(F.pmod(F.xxhash64("raw"), F.lit(step)) == 0)
              .limit(2 * sample).select("raw").collect()]
    width = np.dtype(dtype).itemsize
    law: dict[int, list[dict]] = {}
    for dim in {len(x) // width for x in fitted}:
        own = [x for x in fitted if len(x) == dim * width]
        law[dim] = [fit(unit(own, dtype), t, n / len(fitted), leaf, spill) for t in range(trees)]
    law_b = spark.sparkContext.broadcast(law)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, raw = np.array(batch.column(0).to_pylist(), np.int64), np.array(batch.column(1).to_pylist(), object)
            size = np.array([len(x) // width for x in raw])
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                v = unit(list(raw[at]), dtype)
                for tree, nodes in enumerate(law_b.value.get(int(dim), [{}])):
                    for leaf_id, rows in leaves(v, tree, nodes):
                        k = len(rows)
                        if k:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([int(dim)] * k, pa.int32()), pa.array([tree] * k, pa.int32()),
                                 pa.array([leaf_id] * k, pa.int64()), pa.array(node[at[rows]], pa.int64()),
                                 pa.array(list(raw[at[rows]]), pa.binary())], ["dim", "tree", "leaf", "node", "raw"])

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].to_numpy()
        parent = np.arange(len(pdf))
        for ia, ib, cosine, _ in _sides(pdf, dtype):
            x, y = np.nonzero(cosine >= threshold)
            parent = join_all(len(pdf), ia[x], ib[y], parent)
        moved = np.flatnonzero(parent != np.arange(len(pdf)))
        return pd.DataFrame({"a": node[moved], "b": node[parent[moved]]})

    placed = scratch.write(distinct.select("node", "raw").mapInArrow(
        place, "dim int, tree int, leaf long, node long, raw binary"), "leaves")
    key = ["dim", "tree", "leaf"]
    return _tiled(placed, key, tile).groupBy(*key, "i", "j").applyInPandas(find, "a long, b long")


def link_counts(scratch: Scratch, members: DataFrame, dtype: str, threshold: float, tile: int) -> DataFrame:
    """(node, n): the rows that a node's vector links with, its own rows aside; members: node, raw, rows, component."""
    buckets = 4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, sums = [], []
        for _, own in pdf.groupby(["component", "size", "i", "j"], sort=False):
            own = own.reset_index(drop=True)
            rows, n = own["rows"].to_numpy(), np.zeros(len(own), np.int64)
            for ia, ib, cosine, diagonal in _sides(own, dtype):
                hit = cosine >= threshold
                if diagonal:
                    np.fill_diagonal(hit, False)
                n[ia] += hit @ rows[ib]
                if not diagonal:
                    n[ib] += rows[ia] @ hit
            nodes.append(own["node"].to_numpy())
            sums.append(n)
        return pd.DataFrame({"node": np.concatenate(nodes), "n": np.concatenate(sums)})

    d = members.withColumn("size", F.length("raw"))
    d = _tiled(d, ["component", "size"], tile)
    d = d.withColumn("bucket", F.pmod(F.xxhash64("component", "i", "j"), F.lit(buckets)))
    return (d.select("bucket", "component", "size", "i", "j", "tile", "node", "raw", "rows").groupBy("bucket")
            .applyInPandas(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")))


def near_duplicates(emb: DataFrame, threshold: float = 0.9, trees: int = TREES, leaf: int = LEAF,
                    sample: int = SAMPLE, spill: float = SPILL, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    scratch = Scratch(emb.sparkSession)
    rows, dtype = prepared(emb)
    rows = scratch.write(rows, "vectors")
    low = F.coalesce(F.min("vec_id"), F.lit(-(1 << 63)))
    distinct = scratch.write(rows.filter("raw is not null").groupBy("raw").agg(
        low.alias("node"), F.count(F.lit(1)).alias("rows")), "distinct")
    edges = scratch.write(links(scratch, distinct, dtype, threshold, trees, leaf, sample, spill, tile), "links")
    comp = scratch.write(components(scratch, edges), "components")
    members = distinct.join(comp.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n")).drop("_n")
    counts = scratch.write(link_counts(scratch, members, dtype, threshold, tile), "counts")
    known = (distinct.join(counts, "node", "left").join(comp, "node", "left")
             .select("raw", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    out = rows.join(known, "raw", "left")
    own = F.coalesce("vec_id", F.lit(-(1 << 63)))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", own).alias("component_id")).withColumn(
        "kept", F.col("component_id") == own)
