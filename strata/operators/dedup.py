"""Deduplication: exact (keep first / last / most complete), anchored time
window, and fuzzy (character-bigram similarity) — plus result metrics.

Exact: ``row_number() = 1`` per key; Spark plans it as a WindowGroupLimit
that keeps only the top row per key *before* the shuffle, so a key holding a
third of the table costs one row per map task on the wire.

Window (greedy, anchored at kept events): an event is kept iff no kept event
of the same key lies in the previous N hours.  Exact and distributed:
  1. equal (key, ts) collapse to their first event (later ties are always
     removed), partial aggregation;
  2. every node gets ``nxt`` = first node of its key strictly after ts + N,
     found with running-min windows over (key, time chunk) — chunks split a hot
     key — and a fallback over per-chunk minima for probes that land in empty
     stretches;
  3. the kept nodes are exactly the chain head → nxt → nxt …; it is found by
     pointer doubling (log2(chain length) join rounds on unique node ids, no
     pairs, lineage cut by reliable checkpoints).

Fuzzy (greedy in input order inside blocks of equal 5-char key prefixes): a
row is removed iff an earlier *kept* row of its block is similar (mean over
key columns of bigram Jaccard ≥ t).  Identical normalised keys collapse first
(only the first copy can ever survive).  A block is cut into chunks by set size;
pairs of chunks whose sizes allow a similarity of t are dealt over the tasks, which
take all overlaps of two chunks at once from the packed token sets.  The greedy
order is resolved in rounds: a row with
no undecided or kept earlier neighbour is kept, a row with a kept earlier
neighbour is removed, and chains are followed by pointer doubling.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import bigram_jaccard, norm_key, with_scalars
from strata.session import cut_lineage, drop_table


def _default_keys(df: DataFrame, keys: list[str] | None) -> list[str]:
    ks = [k for k in (keys or []) if k in df.columns]
    return ks or [c for c in df.columns if not c.startswith("_")]


#: hashes of repeated keys that may be broadcast
_FEW_MARKS = 1_000_000


def dedup_exact(df: DataFrame, keys: list[str] | None, order: list[str], keep: str = "first",
                probe: bool = True, few: int = _FEW_MARKS) -> DataFrame:
    """One row per key (nulls compare equal).  ``order`` names the arrival-order
    columns (a total order gives reproducible results); keep the first, the
    last, or the row with the fewest nulls (ties → arrival order).

    With ``probe`` a first pass shuffles a 64-bit hash of each key alone.  Rows whose hash no other
    row has stay where they are; only the others are ranked, by their true keys.  Where more than
    ``few`` hashes repeat, all rows are ranked.  ``df`` is read again after that pass and must
    give the same rows; leave the probe out where that costs more than to shuffle the rows."""
    ks = _default_keys(df, keys)
    asc = [F.col(c).asc_nulls_first() for c in order]
    if keep == "first":
        o = asc
    elif keep == "last":
        o = [F.col(c).desc_nulls_last() for c in order]
    elif keep == "most_complete":
        nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
        o = [nulls.asc()] + asc
    else:
        raise ValueError(keep)
    w = Window.partitionBy(*ks).orderBy(*o)
    ranked = lambda rows: rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if not probe or not ks:
        return ranked(df)
    mark = F.xxhash64(*ks).alias("_mark")
    repeated = cut_lineage(df.groupBy(mark).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark"),
                           "repeated_keys")
    n = repeated.limit(few + 1).count()
    if n == 0:
        return df
    if n > few:
        return ranked(df)
    same = F.xxhash64(*[df[k] for k in ks]) == repeated["_mark"]
    return df.join(F.broadcast(repeated), same, "left_anti").unionByName(
        ranked(df.join(F.broadcast(repeated), same, "left_semi")))


def dedup_metrics(df: DataFrame, deduped: DataFrame, keys: list[str] | None, strategy: str = "exact") -> DataFrame:
    """input, output, found (members of duplicate groups for exact; removed rows
    otherwise), removed, rate %."""
    ks = _default_keys(df, keys)
    from strata.functions.numeric import ratio_round
    if strategy == "exact":
        g = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_k"))
        found = g.agg(F.coalesce(F.sum(F.when(F.col("_k") > 1, F.col("_k")).otherwise(0)), F.lit(0)).alias("found"),
                      F.sum("_k").alias("input"))
    else:
        found = df.agg(F.count(F.lit(1)).alias("input")).withColumn("found", F.lit(None).cast("bigint"))
    out = deduped.agg(F.count(F.lit(1)).alias("output"))
    j = with_scalars(found, out)
    removed = F.col("input") - F.col("output")
    return j.select(F.lit(strategy).alias("strategy"), F.col("input").alias("total_input"),
                    F.col("output").alias("total_output"),
                    F.coalesce(F.col("found"), removed).alias("duplicates_found"),
                    removed.alias("duplicates_removed"),
                    F.when(F.col("input") > 0, ratio_round(removed * 100, F.col("input"), 2))
                    .otherwise(F.lit(0.0)).alias("dedup_rate_pct"))


def dedup_samples(df: DataFrame, keys: list[str] | None, k: int = 3, per_group: int = 2) -> DataFrame:
    """Up to ``k`` duplicate groups (smallest keys first) with their size and
    ``per_group`` sample rows of key values — the report's sample section."""
    ks = _default_keys(df, keys)
    groups = (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("count")).where("count > 1")
              .orderBy(*[F.col(c).asc_nulls_first() for c in ks]).limit(k))
    return groups.select(*ks, "count", F.least(F.col("count"), F.lit(per_group)).alias("sample_rows"))


# --------------------------------------------------------------------------
# anchored time-window dedup
# --------------------------------------------------------------------------

def dedup_window(df: DataFrame, keys: list[str], ts_col: str, id_col: str, hours: float = 24.0,
                 chunk_seconds: float | None = None) -> DataFrame:
    """Greedy anchored window dedup (see module doc).  Returns the kept rows.

    ``id_col`` must be unique; it orders events with equal timestamps."""
    n_sec = float(hours) * 3600.0
    chunk = float(chunk_seconds or max(n_sec / 16.0, 1.0))
    win, ch = int(n_sec * 1_000_000), int(chunk * 1_000_000)
    base = df.select(F.to_json(F.struct(*[F.col(k) for k in keys])).alias("_key"),
                     F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_t"), F.col(id_col).alias("_id"))
    # 1. collapse equal (key, ts): only the first event of a tie can survive
    nodes = (base.where(F.col("_t").isNotNull()).groupBy("_key", "_t").agg(F.min("_id").alias("_id"))
             .withColumn("_c", F.floor(F.col("_t") / ch)))
    nodes = cut_lineage(nodes)
    # 2. nxt = first node of the key strictly after t + N
    probes = nodes.select("_key", F.col("_t").alias("_src"), (F.col("_t") + win).alias("_pos"))
    probes = probes.withColumn("_c", F.floor(F.col("_pos") / ch))
    u = (nodes.select("_key", "_c", F.col("_t").alias("_pos"), F.lit(1).alias("_kind"),
                      F.col("_t").alias("_node"), F.lit(None).cast("bigint").alias("_src"))
         .unionByName(probes.select("_key", "_c", "_pos", F.lit(0).alias("_kind"),
                                    F.lit(None).cast("bigint").alias("_node"), "_src")))
    # running min from the future inside (key, chunk); at an equal position the
    # probe sorts before the node, so only nodes strictly after it count
    wd = (Window.partitionBy("_key", "_c").orderBy(F.col("_pos").desc(), F.col("_kind").asc())
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    in_chunk = (u.withColumn("_nx", F.min("_node").over(wd))
                .where(F.col("_kind") == 0).select("_key", "_src", "_c", "_nx"))
    # probes with nothing after them in their chunk: first node of a later chunk
    cmin = nodes.groupBy("_key", "_c").agg(F.min("_t").alias("_m"))
    pc = in_chunk.where(F.col("_nx").isNull()).select("_key", "_c").distinct()
    cu = (cmin.select("_key", "_c", "_m", F.lit(1).alias("_k"))
          .unionByName(pc.select("_key", "_c", F.lit(None).cast("bigint").alias("_m"), F.lit(0).alias("_k"))))
    wc = (Window.partitionBy("_key").orderBy(F.col("_c").desc(), F.col("_k").asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    later = (cu.withColumn("_later", F.min("_m").over(wc)).where(F.col("_k") == 0)
             .select("_key", "_c", "_later"))
    jump = cut_lineage(in_chunk.join(later, ["_key", "_c"], "left")
                       .select("_key", F.col("_src").alias("_t"),
                               F.coalesce(F.col("_nx"), F.col("_later")).alias("_j")))
    # 3. chain head → nxt → … by pointer doubling
    span = nodes.groupBy("_key").agg(((F.max("_t") - F.min("_t")) / win).alias("_s")).agg(F.max("_s")).first()[0]
    levels = max(1, math.ceil(math.log2((span or 0) + 2)) + 1)
    tables = [jump]
    for _ in range(levels - 1):
        a, b = tables[-1].alias("a"), tables[-1].alias("b")
        tables.append(cut_lineage(
            a.join(b, (F.col("a._key") == F.col("b._key")) & (F.col("a._j") == F.col("b._t")), "left")
             .select(F.col("a._key").alias("_key"), F.col("a._t").alias("_t"), F.col("b._j").alias("_j"))))
    # the kept set is small (≤ one node per key per window); it is cut every
    # few levels only, the jump tables (one row per node) are cut at each level
    kept = nodes.groupBy("_key").agg(F.min("_t").alias("_t"))
    for i, lvl in enumerate(reversed(range(levels))):
        s, t = kept.alias("s"), tables[lvl].alias("t")
        step = (s.join(t, (F.col("s._key") == F.col("t._key")) & (F.col("s._t") == F.col("t._t")))
                .select(F.col("s._key").alias("_key"), F.col("t._j").alias("_t")).where(F.col("_t").isNotNull()))
        kept = kept.unionByName(step).distinct()
        if i % 4 == 3:
            kept = cut_lineage(kept)
    kept_ids = cut_lineage(kept.join(nodes, ["_key", "_t"]).select("_id"))
    for table in {id(t): t for t in (nodes, *tables)}.values():
        drop_table(table)
    # null timestamps: kept only when the key has no timestamped event, and only the first
    first = base.withColumn("_r", F.row_number().over(
        Window.partitionBy("_key").orderBy(F.col("_t").asc_nulls_last(), F.col("_id"))))
    null_kept = first.where((F.col("_r") == 1) & F.col("_t").isNull()).select("_id")
    keep_ids = kept_ids.unionByName(null_kept).withColumnRenamed("_id", id_col)
    return df.join(keep_ids, id_col, "left_semi")


# --------------------------------------------------------------------------
# fuzzy dedup
# --------------------------------------------------------------------------

def _tokens(text: str) -> np.ndarray:
    """Bigram set of a string as sorted numbers (two code points each), with stand-ins so that Jaccard on
    it equals the per-column similarity rule for short strings: '' → {-1}, one char → {that char}."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if len(points) < 2:
        return points if len(points) else np.array([-1], np.int64)
    return np.unique((points[:-1] << 21) | points[1:])


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted numbers as bytes: their differences, the bytes of equal weight together, deflated."""
    return zlib.compress(np.diff(tokens, prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def _token_array(packed: pd.Series) -> pd.Series:
    return packed.map(_unpack)


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of each left with each right set: a product of incidence matrices,
    taken over ``columns`` tokens at a time.  Whole numbers below 2**24 are exact in it."""
    sets = left + right
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(token) > 1
    row, token = row[shared[token]], (np.cumsum(shared) - 1)[token[shared[token]]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(token, [start, start + columns])
        hits = np.zeros((len(sets), min(columns, int(shared.sum()) - start)), np.float32)
        hits[row[lo:hi], token[lo:hi] - start] = 1
        out += hits[:len(left)] @ hits[len(left):].T
    return out


#: rows of a block's chunk (twice as many at most): a pair of chunks is matched at once, in matrices of about 50 MB
_CHUNK = 1000
#: pairs of rows that are compared with the threshold and given on at a time
_CELLS = 1 << 18


def _chunk_plan(reps: DataFrame, threshold: float, bounded: bool, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Where the rows of a block go: (_blk, _sz) → first chunk number and parts; (_blk, chunk) → pairs of chunks.

    Chunks hold rows of like set size, about ``chunk`` of them; a size that more rows have is dealt over
    parts.  Where ``bounded``, pairs of chunks whose sizes differ by more than the threshold are left out."""
    sizes = reps.groupBy("_blk", "_sz").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_blk").orderBy("_sz").rowsBetween(Window.unboundedPreceding, -1))
    sizes = cut_lineage(sizes.withColumn("_all", F.sum("_n").over(Window.partitionBy("_blk"))).select(
        "_blk", "_sz", "_n", "_all", F.floor(F.coalesce(before, F.lit(0)) / chunk).alias("_base"),
        F.ceil(F.col("_n") / chunk).alias("_parts")).where("_all > 1").drop("_all"))
    number = F.when(F.col("_parts") == 1, F.struct("_base", F.lit(-1).cast("bigint").alias("_part"))) \
        .otherwise(F.struct("_base", F.col("_part")))
    chunks = cut_lineage(sizes.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
                         .groupBy("_blk", number.alias("_chunk")).agg(F.min("_sz").alias("_lo"), F.max("_sz").alias("_hi")))
    a, b = chunks.alias("a"), chunks.alias("b")
    near = F.least("a._hi", "b._hi") >= F.greatest("a._lo", "b._lo") * threshold - 1e-9
    pairs = a.join(b, "_blk").where((F.col("a._chunk") <= F.col("b._chunk")) & (near if bounded else F.lit(True))).select(
        "_blk", F.col("a._chunk").alias("_ca"), F.col("b._chunk").alias("_cb"))
    sides = pairs.select("_blk", F.col("_ca").alias("_chunk"), "_ca", "_cb", F.lit(0).alias("_side")).unionByName(
        pairs.where("_ca != _cb").select("_blk", F.col("_cb").alias("_chunk"), "_ca", "_cb", F.lit(1).alias("_side")))
    return sizes.select("_blk", "_sz", "_base", "_parts"), cut_lineage(sides)


def fuzzy_candidates(reps: DataFrame, keys: list[str], threshold: float, chunk: int = _CHUNK) -> DataFrame:
    """Exact set of pairs (a before b, same block) with mean similarity ≥ t.

    ``reps`` comes from ``fuzzy_reps``: ``_pos`` (order), ``_blk`` (block key) and the packed token
    set per key column.  A block is cut into chunks of rows of like set size; each pair of chunks
    is one group, which finds all overlaps by a product of matrices, so no token and no pair below
    the threshold is ever shuffled or stored.  Rows with the same set share their overlaps, and
    pairs leave a group some at a time, as copies make most of them."""
    packed = [f"_pk_{k}" for k in keys]
    rows = reps.where(F.col("_pos").isNotNull()).select("_pos", "_blk", "_sz", *packed)
    where, sides = _chunk_plan(rows, threshold, len(keys) == 1, chunk)
    part = F.when(F.col("_parts") == 1, F.lit(-1).cast("bigint")).otherwise(F.pmod(F.xxhash64("_pos"), "_parts"))
    tiles = (rows.join(where, ["_blk", "_sz"]).withColumn("_chunk", F.struct("_base", part.alias("_part")))
             .join(sides, ["_blk", "_chunk"]).select("_blk", "_ca", "_cb", "_side", "_pos", *packed))
    n_keys = len(keys)
    pos_type = rows.schema["_pos"].dataType.simpleString()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        pos, side = table["_pos"].to_numpy(), table["_side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = table["_ca"][0].as_py() == table["_cb"][0].as_py()  # a chunk with itself
        right = left if alone else right
        if not len(left) or not len(right):  # a part that no row was dealt to
            return
        alike = []  # by key column: similarity of each pair of distinct sets, and the sets of the rows
        for c in packed:
            coded = table[c].combine_chunks().dictionary_encode()
            sets, of = [_unpack(x.as_py()) for x in coded.dictionary], coded.indices.to_numpy()
            (ours, at), (theirs, to) = np.unique(of[left], return_inverse=True), np.unique(of[right], return_inverse=True)
            sizes = np.array([len(s) for s in sets])
            inter = _overlaps([sets[i] for i in ours], [sets[i] for i in theirs]).astype(np.float64)
            alike.append((inter / (sizes[ours][:, None] + sizes[theirs][None, :] - inter), at, to))
        step = max(1, _CELLS // len(right))
        for start in range(0, len(left), step):
            sim = sum(m[at[start:start + step]][:, to] for m, at, to in alike) / n_keys
            i, j = np.nonzero(sim >= threshold)
            value, i, j = sim[i, j], pos[left[start + i]], pos[right[j]]
            if not alone:  # either may come first
                i, j = np.where(i < j, i, j), np.where(i < j, j, i)
            first = i < j
            yield pa.RecordBatch.from_arrays([pa.array(i[first], table["_pos"].type), pa.array(j[first], table["_pos"].type),
                                              pa.array(value[first])], ["_a", "_b", "similarity"])

    return tiles.groupBy("_blk", "_ca", "_cb").applyInArrow(links, f"_a {pos_type}, _b {pos_type}, similarity double")


def fuzzy_reps(df: DataFrame, keys: list[str], order_col: str, collapse: bool = True) -> DataFrame:
    """Rows prepared for matching: block key and packed token sets per key column, stored for
    reuse (``_pk_<k>``; ``_tk_<k>`` shows them as arrays).  ``collapse`` keeps one row per distinct
    normalised key tuple (its first arrival), told by a digest, so no text is shuffled."""
    names = [f"_n_{k}" for k in keys]
    packed = [f"_pk_{k}" for k in keys]
    norm = df.select(F.col(order_col).alias("_pos"), *[norm_key(F.col(k)).alias(n) for k, n in zip(keys, names)])
    norm = norm.select("_pos", F.concat_ws("|", *[F.substring(n, 1, 5) for n in names]).alias("_blk"), *names,
                       F.sha2(F.concat_ws("|", *[F.sha2(n, 256) for n in names]), 256).alias("_key"))

    def pack(batches):
        for batch in batches:
            sets = [[_tokens(x.as_py()) for x in batch.column(n)] for n in names]
            size = pa.array([len(s) for s in sets[0]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("_pos", "_blk", "_key")], size,
                 *[pa.array([_pack(s) for s in one], pa.binary()) for one in sets]],
                ["_pos", "_blk", "_key", "_sz", *packed])

    pos_type = norm.schema["_pos"].dataType.simpleString()
    reps = norm.mapInArrow(pack, f"_pos {pos_type}, _blk string, _key string, _sz bigint, "
                           + ", ".join(f"{p} binary" for p in packed))
    if collapse:
        reps = reps.groupBy("_key", "_blk", "_sz", *packed).agg(F.min("_pos").alias("_pos"))
    reps = cut_lineage(reps.select("_pos", "_blk", "_sz", *packed))
    tokens = F.pandas_udf(_token_array, "array<bigint>")
    return reps.withColumns({f"_tk_{k}": tokens(F.col(p)) for k, p in zip(keys, packed)})


def fuzzy_links(df: DataFrame, key: str, id_col: str, threshold: float) -> DataFrame:
    """Rows that share a normalised key form a class, whose id is its smallest ``id_col``.

    One ``member`` row tells each row's class (a: class, b: row), one ``link`` row each pair
    of classes of the same block with similarity ≥ t.  Copies are not expanded into pairs, so
    the result grows with the rows and the links of unlike keys."""
    rows = df.select(F.col(id_col).alias("_id"), norm_key(F.col(key)).alias("_name"))
    classes = cut_lineage(rows.groupBy("_name").agg(F.min("_id").alias("_class")))
    links = fuzzy_candidates(fuzzy_reps(classes, ["_name"], "_name", collapse=False), ["_name"], threshold)
    side = lambda n: classes.select(F.col("_class").alias(f"{n}_id"), F.col("_name").alias(f"_{n}"))
    member = rows.join(classes, "_name").select(
        F.lit("member").alias("kind"), F.col("_class").alias("a_id"), F.col("_id").alias("b_id"),
        F.col("_name").alias("a_name"), F.col("_name").alias("b_name"), F.lit(1.0).alias("similarity"))
    link = links.join(side("a"), "_a").join(side("b"), "_b").select(
        F.lit("link").alias("kind"), "a_id", "b_id", F.col("_a").alias("a_name"), F.col("_b").alias("b_name"), "similarity")
    return member.unionByName(link)


def _settle_alone(edges: DataFrame) -> DataFrame:
    """Removed rows of a small graph, decided one after the other in one task."""
    def run(batches):
        kept: dict = {}
        rows = sorted((b, a) for batch in batches for a, b in zip(batch["_a"], batch["_b"]))
        for b, a in rows:  # all edges of b follow one another, and every a < b is decided
            kept[b] = kept.get(b, True) and not kept.setdefault(a, True)
        yield pd.DataFrame({"_b": [k for k, v in kept.items() if not v]})

    return edges.coalesce(1).mapInPandas(run, f"_b {edges.schema['_b'].dataType.simpleString()}")


def _chain_kept(edges: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes (_a) that chains from ``heads`` decide to keep.

    A node with one earlier neighbour is the opposite of it.  Pointer doubling finds the
    node where each run of such opposites starts, and whether its length is odd: runs that
    start at a head are decided at once, in rounds that grow with the logarithm of a run."""
    ptr = cut_lineage(edges.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_a").alias("_up"))
                      .where("_n = 1").select(F.col("_b").alias("_a"), "_up", F.lit(1).alias("_odd")))
    while True:
        nxt = ptr.select(F.col("_a").alias("_up"), F.col("_up").alias("_far"), F.col("_odd").alias("_o"))
        moved = cut_lineage(ptr.join(nxt, "_up", "left").select(
            "_a", F.coalesce("_far", "_up").alias("_up"),
            F.col("_odd").bitwiseXOR(F.coalesce("_o", F.lit(0))).alias("_odd"),
            F.col("_far").isNotNull().alias("_moved")))
        drop_table(ptr)
        ptr = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return ptr.where("_odd = 0").join(heads.withColumnRenamed("_a", "_up"), "_up", "left_semi").select("_a")


def settle_greedily(edges: DataFrame, alone: int = 100_000) -> DataFrame:
    """Nodes (_b) that a greedy pass in order removes, from distinct edges (_a before _b).

    Nodes without an earlier neighbour are kept, which removes their later neighbours, and
    so on until no edge between undecided nodes is left.  A round that decides less than
    half of the edges lets the next one follow chains to their ends.  A remainder of at
    most ``alone`` edges is settled in one task; that changes the plan, not the result."""
    removed = []
    left, chains = edges.count(), False
    while left > alone:
        later = edges.select(F.col("_b").alias("_a")).distinct()
        kept = cut_lineage(edges.select("_a").distinct().join(later, "_a", "left_anti"))
        if chains:
            kept = cut_lineage(kept.unionByName(_chain_kept(edges, kept)))
        gone = cut_lineage(edges.join(kept, "_a", "left_semi").select("_b").distinct())
        removed.append(gone)
        rest = cut_lineage(edges.join(kept, "_a", "left_anti").join(gone, "_b", "left_anti")
                           .join(gone.select(F.col("_b").alias("_a")), "_a", "left_anti"))
        drop_table(edges)
        before, left, edges = left, rest.count(), rest
        if left >= before:
            raise RuntimeError("fuzzy dedup made no progress")
        chains = left > before / 2
    removed.append(_settle_alone(edges))
    return reduce(DataFrame.unionByName, removed)


def dedup_fuzzy(df: DataFrame, keys: list[str], order_col: str, threshold: float = 0.85,
                alone: int = 100_000) -> DataFrame:
    """Greedy fuzzy dedup; returns the kept rows of ``df`` (see ``settle_greedily``)."""
    reps = fuzzy_reps(df, keys, order_col)
    edges = cut_lineage(fuzzy_candidates(reps, keys, threshold).select("_a", "_b"))
    gone = settle_greedily(edges, alone)
    keep = reps.select(F.col("_pos").alias(order_col)).join(
        gone.select(F.col("_b").alias(order_col)), order_col, "left_anti")
    return df.join(keep, order_col, "left_semi")


# fixed values: timestamp columns the window strategy looks for, first present wins
WINDOW_TS_CANDIDATES = ["timestamp", "_ingested_at", "created_at", "event_time"]


def deduplicate(df: DataFrame, strategy: str = "exact", key_columns: list[str] | None = None,
                order: list[str] | None = None, keep: str = "first", window_hours: float = 24.0,
                similarity_threshold: float = 0.85, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Strategy dispatch → (deduplicated rows, one-row metrics).

    fuzzy without usable key columns and window without a timestamp column fall
    back to exact; ``order`` (arrival order) and ``id_col`` (unique row id) make
    the order-dependent strategies reproducible."""
    order = order or [c for c in df.columns if not c.startswith("_")]
    keys = [k for k in (key_columns or []) if k in df.columns]
    ts = next((c for c in WINDOW_TS_CANDIDATES if c in df.columns), None)
    if strategy == "fuzzy" and keys and id_col:
        out = dedup_fuzzy(df, keys, id_col, similarity_threshold)
    elif strategy == "window" and ts and id_col:
        out = dedup_window(df, keys or [c for c in df.columns if not c.startswith("_") and c != id_col],
                           ts, id_col, window_hours)
    else:
        strategy, out = "exact", dedup_exact(df, keys or None, order, keep)
    return out, dedup_metrics(df, out, keys or None, strategy)
