"""Gradient-boosted trees for a binary label: Newton steps on the logistic loss, binned
features, level-wise trees.

Trees grow from the sums of gradients in each node, feature and bin. The sums are whole
numbers of a small unit, so they don't depend on how the examples are parted: `Examples.sums`
takes them from arrays, `spread` from the tasks of a table of any length, with the same trees.
Models that differ by the weights of the examples (folds) grow side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: most bins of a feature, unit of the sums, examples that are summed at a time
BINS, UNIT, ROWS = 33, 2.0 ** 32, 1 << 15


@dataclass
class Boosted:
    """Trees as arrays: node k has children 2k+1 and 2k+2; feature -1 marks a leaf."""
    base: float = 0.0
    trees: list = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree[2][_leaves(x, tree)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def _leaves(x: np.ndarray, tree: tuple) -> np.ndarray:
    feature, cut, _ = tree
    at = np.zeros(len(x), np.int64)
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        right = x[np.arange(len(x)), np.maximum(f, 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)


class Examples:
    """Binned examples, their weights (models × rows) and the margins that the rounds so far give them.

    A round is a tree for each model, whose cuts are bins."""

    def __init__(self, code: np.ndarray, y: np.ndarray, weight: np.ndarray, base: np.ndarray):
        self.code, self.y, self.weight, self.done = code, y, weight, 0
        self.margin = np.repeat(np.asarray(base, np.float64)[:, None], len(y), axis=1)

    def follow(self, rounds: list) -> None:
        for trees in rounds[self.done:]:
            for m, tree in enumerate(trees):
                self.margin[m] += tree[2][_leaves(self.code, tree)]
        self.done = len(rounds)

    def sums(self, rounds: list, trees: list, level: int) -> np.ndarray:
        """Gradients and their derivatives by model, node of the level, feature and bin, in units."""
        self.follow(rounds)
        width, size = self.code.shape[1], 2 ** level * self.code.shape[1] * BINS
        out = np.zeros((len(trees), size, 2), np.int64)
        for m, tree in enumerate(trees):
            p = 1 / (1 + np.exp(-self.margin[m]))
            parts = np.rint(UNIT * self.weight[m] * np.stack([self.y - p, p * (1 - p)]))
            at = _leaves(self.code, tree) - (2 ** level - 1)
            own = np.flatnonzero(at >= 0)
            for start in range(0, len(own), ROWS):
                rows = own[start:start + ROWS]
                cell = ((at[rows, None] * width + np.arange(width)) * BINS + self.code[rows]).ravel()
                for k in (0, 1):
                    out[m, :, k] += np.bincount(cell, np.repeat(parts[k, rows], width), size).astype(np.int64)
        return out.reshape(len(trees), 2 ** level, width, BINS, 2)


def spread(table: DataFrame, read: Callable[[pa.Table], Examples]) -> Callable[[list, list, int], np.ndarray]:
    """`Examples.sums` over all tasks of a table: each reads its part and follows the rounds anew."""
    def sums(rounds: list, trees: list, level: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                got = read(pa.Table.from_batches(held)).sums(rounds, trees, level)
                yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()]), pa.array([list(got.shape)])], ["sums", "shape"])

        out = 0
        for r in table.mapInArrow(run, "sums binary, shape array<long>").collect():
            out = out + np.frombuffer(r["sums"], np.int64).reshape(r["shape"])
        return out

    return sums


def _split(tree: tuple, k: int, sums: np.ndarray, rate: float, smooth: float) -> None:
    feature, cut, value = tree
    total = sums[0].sum(axis=0)
    if not total.any():  # nothing is here
        return
    worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + smooth)
    left = np.cumsum(sums, axis=1)[:, :-1]
    right = total - left
    gain = worth(left) + worth(right) - worth(total)
    gain[(left[..., 1] < 1e-3) | (right[..., 1] < 1e-3)] = 0
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    value[k] = rate * total[0] / (total[1] + smooth)
    if gain[f, b] > 1e-6:
        feature[k], cut[k], value[k] = f, b, 0.0
        for child, s in ((2 * k + 1, left[f, b]), (2 * k + 2, right[f, b])):
            value[child] = rate * s[0] / (s[1] + smooth)


def grow(sums: Callable[[list, list, int], np.ndarray], cuts: list[np.ndarray], base: np.ndarray, rounds: int = 60,
         depth: int = 3, rate: float = 0.3, smooth: float = 1.0) -> tuple[list[Boosted], list]:
    """The models, and their rounds over bins."""
    size, done = 2 ** (depth + 1) - 1, []
    for _ in range(rounds):
        trees = [(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for _ in base]
        for level in range(depth):
            for tree, nodes in zip(trees, sums(done, trees, level) / UNIT):
                for k, node in enumerate(nodes, 2 ** level - 1):
                    _split(tree, k, node, rate, smooth)
        done.append(trees)
    told = lambda f, b: np.array([cuts[i][j] if i >= 0 else 0.0 for i, j in zip(f, b)])
    return [Boosted(float(start), [(t[m][0], told(t[m][0], t[m][1]), t[m][2]) for t in done])
            for m, start in enumerate(base)], done


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: a bin over b holds what is greater than cut b."""
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


def log_odds(share: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(share, 1e-6) / np.maximum(1 - share, 1e-6))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.3,
        smooth: float = 1.0, bins: int = BINS - 1) -> Boosted:
    """One model of examples in memory."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[:-1], method="lower")) for f in range(x.shape[1])]
    base = log_odds(np.array([(weight * y).sum() / weight.sum()]))
    return grow(Examples(binned(x, cuts), y, weight[None, :], base).sums, cuts, base, rounds, depth, rate, smooth)[0][0]
