"""K-d tree sharding by distributed weighted medians, in DataFrame operations only.

Every document is a point of metadata (by default size, bytes per character and
mean line length, which equal texts share) with the size of its text as weight.
A level of the tree splits each node along the dimension that is widest in it, at
the weighted median, until there are as many leaves as shards.

A point's place along a dimension is a key of five 12-bit digits: the value's
level, two digits of the text's hash, two of the row's. The median is found digit
by digit: one aggregation per round gives the weights of 4096 intervals of each
node, so no rows are sorted or gathered, and at most 4096 rows per node reach the
driver. Equal texts share the first three digits, so a group of copies stays
whole where the cut may move to its border (by at most `tolerance` of the node);
a larger group is split by the last two digits. The tree is then a CASE
expression: documents are not joined with it.

Defined cases: a null text has size 1 and the checksum of the empty text;
repeated rows share all digits and stay together; a null doc_id is a value like
any other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, numbered, text_or_empty

DIGIT = 12
LEVELS = 1 << DIGIT
DIGITS = 5
#: digits that equal texts share
GROUP_DIGITS = 3


@dataclass
class Node:
    dim: str = ""
    cut: int = 0
    low: "Node | int" = 0
    high: "Node | int" = 0


def _levelled(value: Column, top: float) -> Column:
    """0 to 4095 along a logarithmic scale that ends at `top`."""
    x = F.log1p(F.greatest(value.cast("double"), F.lit(0.0))) / F.lit(math.log1p(top))
    return F.least(F.floor(x * (LEVELS - 1)), F.lit(LEVELS - 1)).cast("long")


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the metadata dimensions d0 to d2 and the tail of the key."""
    text = text_or_empty()
    size = F.octet_length(text).cast("long")
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    h, own = F.xxhash64(text), F.xxhash64(F.struct(F.col("doc_id"), F.lit("row")))
    tail = (F.shiftrightunsigned(h, 40) * (LEVELS ** 2)) + F.shiftrightunsigned(own, 40)
    return docs.select(
        "doc_id", (size + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        _levelled(size, 2.0 ** 31).alias("d0"),
        _levelled((size / F.greatest(F.length(text), F.lit(1)) - 1) * 1000, 3000).alias("d1"),
        _levelled(size / lines, 2.0 ** 31).alias("d2"), tail.alias("tail"))


def key(dim: str) -> Column:
    return F.col(dim) * (LEVELS ** (DIGITS - 1)) + F.col("tail")


def _medians(p: DataFrame, dims: dict[int, str], share: dict[int, float], tolerance: float) -> dict[int, int]:
    """For each node the key at which its weight up to there is `share` of the node's."""
    along = F.coalesce(*[F.when(F.col("node") == n, key(d)) for n, d in dims.items()])
    at = {n: 0 for n in dims}          # digits fixed so far
    done: dict[int, int] = {}
    before, total = {}, {}
    for r in range(DIGITS):
        width = LEVELS ** (DIGITS - 1 - r)
        todo = [n for n in dims if n not in done]
        if not todo:
            break
        inside = F.coalesce(*[F.when(F.col("node") == n, F.lit(at[n])) for n in todo])
        q = p.filter(F.col("node").isin(todo)).select("node", "size", along.alias("key"), inside.alias("at"))
        q = q.filter(F.expr(f"key >= at and key < at + {width * LEVELS}L"))
        q = q.groupBy("node", F.expr(f"cast((key - at) div {width}L as int)").alias("digit"))
        weights: dict[int, list] = {n: [] for n in todo}
        for row in q.agg(F.sum("size").alias("w")).collect():  # at most 4096 rows a node
            weights[row["node"]].append((row["digit"], row["w"]))
        for n in todo:
            if r == 0:
                before[n], total[n] = 0, sum(w for _, w in weights[n])
            goal, run = total[n] * share[n], before[n]
            for digit, w in sorted(weights[n]):
                if run + w >= goal or digit == max(weights[n])[0]:
                    break
                run += w
            low, high = at[n] + digit * width, at[n] + (digit + 1) * width
            near, border = min((goal - run, low), (abs(run + w - goal), high))
            last = r == DIGITS - 1
            if last or r == GROUP_DIGITS - 1 and near <= tolerance * total[n]:
                done[n] = border
            at[n], before[n] = low, run
    return done


def tree(p: DataFrame, shards: int, dims: list[str], tolerance: float) -> Node | int:
    """Split until there are `shards` leaves; `p` is a stored table of points."""
    leaves: dict[int, list] = {0: [shards, None, None]}  # node: leaves to make, parent, side
    root: Node | int = 0
    path: Column = F.lit(0)
    fresh = 1
    while open_ := {n: v for n, v in leaves.items() if v[0] > 1}:
        q = p.withColumn("node", path)
        spread = q.filter(F.col("node").isin(list(open_))).groupBy("node").agg(
            *[f(F.col(d)).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]).collect()
        widest = {r["node"]: max(dims, key=lambda d, r=r: r[f"max_{d}"] - r[f"min_{d}"]) for r in spread}
        if not widest:
            break
        cuts = _medians(q, widest, {n: (open_[n][0] // 2) / open_[n][0] for n in widest}, tolerance)
        nodes = {}
        for n, cut in cuts.items():
            count, parent, side = leaves.pop(n)
            node = Node(widest[n], cut, fresh, fresh + 1)
            nodes[n] = node
            leaves[fresh] = [count // 2, node, "low"]
            leaves[fresh + 1] = [count - count // 2, node, "high"]
            fresh += 2
            if parent is None:
                root = node
            else:
                setattr(parent, side, node)
        for n in set(open_) - set(cuts):  # a node without rows
            leaves[n][0] = 1
        path = _walk(root, lambda leaf: F.lit(leaf))
    order = {}
    _walk(root, lambda leaf: F.lit(order.setdefault(leaf, len(order))))
    return _renamed(root, order)


def _renamed(node: Node | int, order: dict[int, int]) -> Node | int:
    if isinstance(node, int):
        return order.get(node, 0)
    return Node(node.dim, node.cut, _renamed(node.low, order), _renamed(node.high, order))


def _walk(node: Node | int, leaf) -> Column:
    if not isinstance(node, Node):
        return leaf(node)
    low, high = _walk(node.low, leaf), _walk(node.high, leaf)
    return F.when(key(node.dim) < F.lit(node.cut), low).otherwise(high)


def shard_documents(docs: DataFrame, shards: int = 16, target_bytes: int | None = None,
                    tolerance: float = 0.001) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard).

    `target_bytes` instead of `shards` sets the number of leaves from the total size."""
    scratch = Scratch(docs.sparkSession)
    p = scratch.write(points(docs), "points")
    if target_bytes:
        shards = max(1, math.ceil((p.agg(F.sum("size")).first()[0] or 0) / target_bytes))
    top = tree(p, shards, ["d0", "d1", "d2"], tolerance)
    placed = p.select("doc_id", "size", "text_crc32", _walk(top, lambda n: F.lit(n)).cast("int").alias("shard"))
    return numbered(placed, ["shard"], [F.col("doc_id"), F.col("text_crc32")],
                    F.struct("doc_id", "text_crc32"), "slot")
