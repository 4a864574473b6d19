"""Centroid clustering of integer vectors with Ptolemaic pivot bounds.

1. Vectors with `dim` finite components become integers floor(scale * x). The first
   centroids are the `k` vectors whose ids have the smallest hashes; the pivots are the
   `pivots` vectors next in that order. Each vector's distances to the pivots are
   computed once and stored with it.
2. For pivots p, s Ptolemy's inequality gives
       d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s).
   A round takes the largest bound over all pivot pairs, compares a vector exactly with
   the centroid of the lowest bound, and then with those alone whose bound does not
   exceed that distance. Bounds are lowered by more than doubles can err, so no nearest
   centroid and no tie is lost; distances that decide are 64-bit integers.
3. A task returns per centroid the sum of its vectors by component; Spark adds them as
   decimals, the driver sees k x dim sums and sends k centroids back. Vectors are read
   from the stored table each round and never shuffled.

Defined cases: vectors that are null, of another length, or hold null or non-finite
components are left out; other columns are ignored; equal ids or vectors are all kept
(centroids are chosen by hash, then id, then vector; a null id hashes as `seed:` and
comes last among equal hashes); with fewer vectors than k there are fewer centroids;
ties go to the smaller number; an empty table gives an empty result. An integer of
2**27 or more in size raises, as squared distances must fit 64 bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

PIVOTS, WIDEST = 6, 1 << 27
#: what products and roots of doubles may be off by, relatively, with room to spare
OFF = 1e-13
#: vectors that a task computes with at a time
ROWS = 8192


def integers(emb: DataFrame, dim: int, scale: int) -> DataFrame:
    """vec_id and v (little-endian 32-bit integers) of the vectors that are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, ids = batch["embedding"], batch["vec_id"]
            right = pc.fill_null(pc.equal(pc.list_value_length(vec), dim), False)
            vec, ids = vec.filter(right), ids.filter(right)
            x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            whole = np.isfinite(x).all(axis=1)  # nulls became nan
            v = np.floor(scale * x[whole])
            if len(v) and np.abs(v).max() >= WIDEST:
                raise ValueError("a component is too large for 64-bit squared distances")
            raw = np.ascontiguousarray(v.astype("<i4"))
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(whole)).cast(pa.int64()), pa.array([r.tobytes() for r in raw], pa.binary())],
                names=["vec_id", "v"])

    src = emb.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return src.mapInArrow(run, "vec_id long, v binary")


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of int32 x to rows of y, pair by pair."""
    d = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", d, d)


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add `d`: the distances to the pivots as doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["v"], "<i4", pivots.shape[1])
            d = np.stack([np.sqrt(squared(x, p)) for p in pivots], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in d], pa.binary())],
                                             names=["vec_id", "v", "d"])

    return vectors.mapInArrow(run, "vec_id long, v binary, d binary")


class Assigner:
    """Nearest centroids by Ptolemaic bounds; `checked` counts the exact distances."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray):
        self.centroids, self.checked = centroids, 0
        gap = np.sqrt(np.stack([squared(pivots, p) for p in pivots]).astype(float))
        p, s = np.triu_indices(len(pivots), 1)
        apart = gap[p, s] > 0
        self.p, self.s = p[apart], s[apart]
        self.gap = gap[self.p, self.s]
        self.own = np.stack([np.sqrt(squared(centroids, q).astype(float)) for q in pivots], axis=1)

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """No more than the distance of each row to each centroid."""
        low = np.zeros((len(d), len(self.centroids)))
        for p, s, gap in zip(self.p, self.s, self.gap):
            for c, own in enumerate(self.own):
                one, two = d[:, p] * own[s], d[:, s] * own[p]
                np.maximum(low[:, c], (np.abs(one - two) - OFF * (one + two)) / gap, out=low[:, c])
        return low * (1 - OFF)

    def nearest(self, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid."""
        low = self.bounds(d)
        first = low.argmin(axis=1)
        best, at = squared(x, self.centroids[first]), first.copy()
        self.checked += len(x)
        low *= low
        for c, centroid in enumerate(self.centroids):
            rows = np.flatnonzero((low[:, c] <= best * (1 + OFF)) & (first != c))
            own = squared(x[rows], centroid)
            self.checked += len(rows)
            closer = (own < best[rows]) | (own == best[rows]) & (c < at[rows])
            best[rows[closer]], at[rows[closer]] = own[closer], c
        return at, best


def _batches(batches: Iterator[pa.RecordBatch], dim: int, pivots: int):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, _matrix(part["v"], "<i4", dim), _matrix(part["d"], "<f8", pivots)


def sums(vectors: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[dict]]:
    """Vectors in each centroid's cluster, and their componentwise sums (by component)."""
    dim, k = centroids.shape[1], len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = Assigner(pivots, centroids)
        for _, x, d in _batches(batches, dim, len(pivots)):  # sums of 8192 vectors stay below 2**41
            at, _ = told.nearest(x, d)
            for c in np.unique(at):
                own = x[at == c]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.int32()), pa.array([len(own)], pa.int64()),
                     pa.array([own.sum(axis=0, dtype=np.int64).tolist()], pa.list_(pa.int64()))],
                    names=["cluster", "n", "total"])

    rows = vectors.select("v", "d").mapInArrow(run, "cluster int, n long, total array<long>")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    got = (rows.select("cluster", "n", F.posexplode("total").alias("j", "x")).groupBy("cluster", "j")
           .agg(wide("n").alias("n"), wide("x").alias("x")).collect())  # k x dim rows
    counts, totals = np.zeros(k, object), [{} for _ in range(k)]
    for r in got:
        counts[r["cluster"]] = int(r["n"])
        totals[r["cluster"]][r["j"]] = int(r["x"])
    return counts, totals


def clusters(emb: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3,
             pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """(vec_id, cluster, distance) of every vector kept, the final centroids, and the stored vectors."""
    spark = emb.sparkSession
    scratch = Scratch(spark)
    vectors = scratch.write(integers(emb, dim, scale), "integers")
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.orderBy(by, F.col("vec_id").asc_nulls_last(), "v").limit(k + pivots).collect()
    schema = "vec_id long, cluster int, distance long"
    if not chosen:
        return spark.createDataFrame([], schema), np.zeros((0, dim), np.int64), vectors
    chosen = np.stack([np.frombuffer(bytes(r["v"]), "<i4") for r in chosen]).astype(np.int64)
    centroids, pivot = chosen[:k], chosen[k:] if len(chosen) > k + 1 else chosen
    cached = scratch.write(with_pivots(vectors, pivot), "pivots")
    for _ in range(rounds):
        counts, totals = sums(cached, pivot, centroids)
        centroids = np.array([[t[j] // int(n) for j in range(dim)] if n else list(old)
                              for n, t, old in zip(counts, totals, centroids)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = Assigner(pivot, centroids)
        for part, x, d in _batches(batches, dim, len(pivot)):
            at, best = told.nearest(x, d)
            yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(at, pa.int32()), pa.array(best, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return scratch.write(cached.mapInArrow(run, schema), "clusters"), centroids, cached


def cluster_digest(emb: DataFrame, **how) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector kept."""
    rows, centroids, _ = clusters(emb, **how)
    spark = emb.sparkSession
    got = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # k rows
    inertia = sum(int(r["own"]) for r in got)
    each = spark.createDataFrame(
        [(r["cluster"], int(r["own"]), inertia,
          hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in got],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
