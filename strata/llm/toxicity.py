"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

1. Fit, on a bounded sample of labelled rows (`positives` and `negatives`, the
   smallest hashes of their ids, up to `most_bytes` of text): every word of the sample
   is a term, its weight is (1 + ln tf) * idf, idf = 1 + ln((N + 1) / (df + 1)). With
   `by_label` the idf is multiplied by max(1, |z|), the standard errors by which the
   term's share differs between the labels; without it the cosine is that of plain
   TF-IDF, which on the test data finds about half of the toxic rows (README). Examples
   become unit vectors; equal ones are kept once with the weight of their labels, which
   also undoes the sample's label shares.
2. The index is a block-max inverted index made by the executors: examples are numbered
   so that texts with the same commonest words are neighbours, a posting list is cut at
   every `BLOCK` numbers, and each piece knows its largest weight. A query adds up the
   largest weights by block, scores the blocks of the highest bounds in double precision
   and stops where no bound reaches the k-th cosine: the same neighbours as by comparing
   all. The driver passes on compressed postings, bounded by the sample.
3. The neighbours' labels vote with the fourth power of their cosine. An isotonic map,
   fitted on the examples with each left out of its own vote, calibrates the vote;
   the nearest examples' ids are the evidence (`evidence` ids, of the nearest vectors).
4. Scoring is a map over whole texts; the index is as large as the sample allows.

Defined cases: a null or empty text, or one without any term of the sample, gets the
share of toxic rows among such examples; without labelled rows every score is 0;
of a doc_id's labels the largest counts, null labels do not; of a doc_id's texts
the first in order trains, all are scored; equal cosines are all kept; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_columns

#: bounds of the sample, and the neighbours that vote
POSITIVES, NEGATIVES, MOST_BYTES, NEIGHBOURS = 2_000, 4_000, 256 << 20, 20
POWER, EVIDENCE = 4, 3
#: examples of a block of postings, blocks that a query scores first, rows per
#: posting of a term held in full, and queries whose shares are computed together
BLOCK, FIRST, DENSE, TOGETHER = 64, 4, 16, 32
#: weight of the overall share of toxic rows in a vote, and what sums of doubles may be off by
PRIOR_WEIGHT, OFF = 0.05, 1e-12
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class BlockMax:
    """Postings by term in blocks of examples, each block with its largest weight.

    Terms in at least a DENSE-th of the rows are held as full rows of a matrix: their share
    of all cosines is one product, and a block's bound is the largest such share in it
    plus the largest weights of the other terms."""

    def __init__(self, df: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int):
        """df: postings of each term; row, weight: the postings by term and row."""
        self.rows, self.blocks = rows, -(-rows // BLOCK)
        term = np.repeat(np.arange(len(df)), df)
        often = np.flatnonzero(df * DENSE >= max(rows, DENSE * DENSE))
        self.line = np.full(len(df), -1, np.int32)
        self.line[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), self.blocks * BLOCK))
        full = self.line[term] >= 0
        self.matrix[self.line[term[full]], row[full]] = weight[full]
        term, row, weight = term[~full], row[~full], weight[~full]
        block = row // BLOCK
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(row) else row
        self.row, self.weight = row.astype(np.int32), weight
        self.start = np.append(first, len(row)).astype(np.int64)
        self.block = block[first].astype(np.int32)
        self.most = np.maximum.reduceat(weight, first) if len(row) else weight
        self.edges = np.concatenate(([0], np.cumsum(np.bincount(term[first], minlength=len(df)))))
        self.scored = self.seen = 0  # blocks scored, and blocks that share a term with a query

    @staticmethod
    def _spans(low: np.ndarray, count: np.ndarray) -> np.ndarray:
        return np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())

    def shares(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the terms held in full give to the cosines of the queries with all rows."""
        q = np.zeros((len(queries), len(self.matrix)))
        for own, (t, w) in zip(q, queries):
            line = self.line[t]
            own[line[line >= 0]] = w[line >= 0]
        return q @ self.matrix

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, size: np.ndarray,
                share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows by descending cosine that together hold k examples (with all of the last cosine, and a
        row that holds none any more), and their cosines; share: the query's row of `shares`."""
        cosine = self.shares([(t, w)])[0] if share is None else share
        rest = self.line[t] < 0
        t, w = t[rest], w[rest]
        low, count = self.edges[t], self.edges[t + 1] - self.edges[t]
        piece = self._spans(low, count)
        q = np.repeat(w, count)
        at = self.block[piece]
        bound = cosine.reshape(-1, BLOCK).max(axis=1) + np.bincount(at, self.most[piece] * q, self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        self.seen += len(order)
        cosine = cosine[:self.rows]
        known = np.zeros(self.blocks, bool)
        done, last = 0, 0.0
        while done < len(order):
            take = order[done:] if done else order[:FIRST]
            take = take[bound[take] * (1 + OFF) >= last - OFF]
            if not len(take):
                break
            now = np.zeros(self.blocks, bool)
            now[take] = True
            known |= now
            mine = now[at]
            own = piece[mine]
            n = self.start[own + 1] - self.start[own]
            post = self._spans(self.start[own], n)
            cosine += np.bincount(self.row[post], self.weight[post] * np.repeat(q[mine], n), self.rows)
            done += len(take)
            self.scored += len(take)
            last = self._kth(np.where(np.repeat(known, BLOCK)[:self.rows], cosine, 0.0), k, size)
        near = np.flatnonzero(np.repeat(known, BLOCK)[:self.rows] & (cosine > 0 if not last else cosine >= last - OFF))
        by = np.lexsort((near, -cosine[near]))
        return near[by], cosine[near[by]]

    def _kth(self, cosine: np.ndarray, k: int, size: np.ndarray) -> float:
        """The cosine at which the rows so far hold k examples; 0 if they do not."""
        top = np.argpartition(-cosine, k)[:k + 1] if len(cosine) > k + 1 else np.arange(len(cosine))
        top = top[np.argsort(-cosine[top], kind="stable")]
        reach = np.searchsorted(np.cumsum(size[top]), k)
        return float(cosine[top[reach]]) if reach < len(top) else 0.0


class Index:
    """Example vectors with their labels; travels as compressed parts, unpacked where it is used."""

    def __init__(self, prior: float = 0.0):
        self.prior = self.no_term = prior
        self.parts: list[tuple] = []     # (terms, their idf, postings of each, rows, counts) by term
        self.toxic = self.clean = np.zeros(0)   # weights of each distinct vector
        self.size = np.zeros(0, np.int64)
        self.ids: list[list[int]] = []   # the first example ids of each
        self.curve: tuple = ((), ())
        self.ready = False

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("terms", "idf", "postings")} | {"ready": False}

    def unpack(self) -> None:
        if self.ready:
            return
        whole = [[np.frombuffer(zlib.decompress(p[i]), kind) for p in self.parts]
                 for i, kind in ((1, "<f8"), (2, "<i4"), (3, "<i4"), (4, "<i4"))]
        idf, df, row, tf = (np.concatenate(x) if x else np.zeros(0) for x in whole)
        df, row = df.astype(np.int64), row.astype(np.int64)
        names = [n for p in self.parts for n in zlib.decompress(p[0]).decode().split("\n")]
        self.terms = {n: i for i, n in enumerate(names)}
        self.idf, self.ready = idf, True
        weight = (1 + np.log(tf)) * np.repeat(idf, df)
        norm = np.sqrt(np.bincount(row, weight * weight, len(self.size)))
        self.postings = BlockMax(df, row, weight / norm[row], len(self.size))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a text by number, and their weights as a unit vector."""
        counts = Counter(words_of(text or ""))
        at = list(map(self.terms.get, counts))
        t = np.array([x for x in at if x is not None], np.int64)
        n = np.array([n for x, n in zip(at, counts.values()) if x is not None], np.float64)
        order = np.argsort(t)
        t = t[order]
        w = (1 + np.log(n[order])) * self.idf[t]
        return t, w / np.linalg.norm(w) if len(t) else w

    def vote(self, t: np.ndarray, w: np.ndarray, k: int, without: tuple[int, float, float] | None = None,
             share: np.ndarray | None = None):
        """Vote of the neighbours in [0, 1], and their numbers; without: a vector that lacks one example, and
        the toxic and clean weight of that example."""
        size = self.size
        if without:
            size = size.copy()
            size[without[0]] -= 1
        near, cosine = self.postings.nearest(t, w, k, size, share)
        # the prior weighs as PRIOR_WEIGHT neighbours at the largest cosine
        s, toxic, clean = cosine ** POWER, self.toxic[near], self.clean[near]
        if without:
            own = near == without[0]
            toxic, clean = toxic - own * without[1], clean - own * without[2]
        s = s / max(s[toxic + clean > 1e-9], default=1.0)
        up, all_ = float(s @ toxic), float(s @ (toxic + clean))
        return (up + PRIOR_WEIGHT * self.prior) / (all_ + PRIOR_WEIGHT), near

    def calibrated(self, vote: float) -> float:
        x, y = self.curve
        return float(np.interp(vote, x, y)) if len(x) else vote


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit: places and values for linear interpolation."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order]):
        blocks.append([a, a, b, c])
        while len(blocks) > 1 and (blocks[-2][2] >= blocks[-1][2] or blocks[-2][1] == blocks[-1][0]):
            low, high = blocks[-2], blocks.pop()
            total = low[3] + high[3]
            blocks[-1] = [low[0], high[1], (low[2] * low[3] + high[2] * high[3]) / total, total]
    px = np.array([v for b in blocks for v in (b[0], b[1])])
    return px, np.array([v for b in blocks for v in (b[2], b[2])])


def labelled_sample(scratch: Scratch, docs: DataFrame, labels: DataFrame, train: Column, positives: int,
                    negatives: int, most_bytes: int) -> tuple[DataFrame, int, int]:
    """(doc_id, toxic, text) of the sample, and how many toxic and clean labels there are."""
    one = (labels.select("doc_id", "toxic").dropna().filter(train).groupBy("doc_id")
           .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n1, n0 = one.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    pick = lambda y, n: one.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = F.broadcast(pick(1, positives).unionAll(pick(0, negatives)))  # at most positives + negatives rows
    sample = (docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "toxic")
              .agg(F.coalesce(F.min("text"), F.lit("")).alias("text")))
    sample = scratch.write(sample, "labelled")
    # at most positives + negatives rows, without their texts
    before = F.coalesce(F.sum("b").over(W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    fits = sample.select("doc_id", F.octet_length("text").alias("b")).withColumn("before", before).filter(
        F.col("before") + F.col("b") <= most_bytes)
    return sample.join(F.broadcast(fits.select("doc_id")), "doc_id", "left_semi"), n1, n0


def fit(scratch: Scratch, docs: DataFrame, labels: DataFrame, train: Column, positives: int = POSITIVES,
        negatives: int = NEGATIVES, k: int = NEIGHBOURS, by_label: bool = True, most_bytes: int = MOST_BYTES) -> Index:
    sample, n1, n0 = labelled_sample(scratch, docs, labels, train, positives, negatives, most_bytes)

    def words(cols: dict) -> dict:
        seen = [Counter(words_of(text)) for text in cols["text"]]
        order = [sorted(c) for c in seen]
        return {"doc_id": cols["doc_id"], "toxic": cols["toxic"], "terms": order,
                "counts": [[c[t] for t in o] for c, o in zip(seen, order)],
                "common": [" ".join(sorted(c, key=lambda t: (-c[t], t))[:4]) for c in seen]}

    told = map_columns(sample, words, "doc_id long, toxic int, terms array<string>, counts array<int>, common string")
    told = scratch.write(told.groupBy("terms", "counts", "common").agg(
        F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0"),
        F.sort_array(F.collect_list("doc_id")).alias("ids")), "vectors")
    s1, s0, e1, e0 = told.agg(*(F.coalesce(F.sum(F.when(c, F.col(n))), F.lit(0)) for c in (F.lit(True), F.size("terms") == 0)
                                for n in ("n1", "n0"))).first()
    index = Index(n1 / (n1 + n0) if n1 + n0 else 0.0)
    if not s1 or not s0:
        return index
    w1, w0 = n1 / s1, n0 / s0
    index.no_term = (e1 * w1 + PRIOR_WEIGHT * index.prior) / (e1 * w1 + e0 * w0 + PRIOR_WEIGHT)
    # at most positives + negatives rows; texts with the same commonest words get near numbers
    told = told.filter(F.size("terms") > 0).withColumn(
        "row", (F.row_number().over(W.orderBy("common", F.element_at("ids", 1))) - 1).cast("int"))
    told = scratch.write(told, "numbered")
    post = told.select("row", "n1", "n0", F.explode(F.arrays_zip("terms", "counts")).alias("e")).select(
        "row", "n1", "n0", F.col("e.terms").alias("term"), F.col("e.counts").alias("tf"))
    share = (F.col("d1") + F.col("d0")) / (s1 + s0)
    z = F.abs(F.col("d1") / s1 - F.col("d0") / s0) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / s1 + 1 / s0))
    idf = F.log((s1 + s0 + 1) / (F.col("d1") + F.col("d0") + 1)) + 1
    terms = post.groupBy("term").agg(F.sum("n1").alias("d1"), F.sum("n0").alias("d0"), F.count(F.lit(1)).alias("df")).select(
        "term", "df", (idf * F.greatest(z, F.lit(1.0)) if by_label else idf).alias("idf"))
    post = post.join(terms, "term").select("term", "df", "idf", "row", "tf")
    index.parts = [tuple(bytes(x) for x in r) for r in post.repartition("term").sortWithinPartitions("term", "row").mapInArrow(
        _pack, "terms binary, idf binary, df binary, row binary, tf binary").collect()]
    rows = told.select("row", "n1", "n0", F.slice("ids", 1, EVIDENCE).alias("ids")).toArrow().sort_by("row")
    ones, zeros = rows["n1"].to_numpy(), rows["n0"].to_numpy()
    index.size, index.toxic, index.clean, index.ids = ones + zeros, ones * w1, zeros * w0, rows["ids"].to_pylist()
    index_b = scratch.spark.sparkContext.broadcast(index)

    def left_out(cols: dict) -> dict:
        own = index_b.value
        own.unpack()
        out = {"vote": [], "y": [], "w": []}
        for text, row, ones, zeros in zip(*(cols[c] for c in ("text", "row", "n1", "n0"))):
            t = own.vector(text)
            for y, n, w in ((1, ones, w1), (0, zeros, w0)):
                if n:
                    out["vote"].append(own.vote(*t, k, (row, w if y else 0.0, 0.0 if y else w))[0])
                    out["y"].append(float(y))
                    out["w"].append(n * w)
        return out

    # a text of the same words as often stands for each example
    again = F.array_join(F.flatten(F.transform(F.arrays_zip("terms", "counts"),
                                               lambda e: F.array_repeat(e["terms"], e["counts"]))), " ")
    rows = told.select("row", "n1", "n0", again.alias("text")).repartition("row")
    votes = map_columns(rows, left_out, "vote double, y double, w double").toArrow().sort_by(
        [("vote", "ascending"), ("y", "ascending")])
    index.curve = isotonic(*(votes[c].to_numpy() for c in ("vote", "y", "w")))
    index_b.destroy()
    return index


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings that come by term and row, as compressed columns; a term's postings stay in one part."""
    table = pa.Table.from_batches(list(batches))  # a shuffle partition of the sample's postings
    if not len(table):
        return
    term = table["term"].combine_chunks().dictionary_encode()
    code = np.asarray(term.indices)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    columns = ["\n".join(term.dictionary.to_pylist()).encode(), table["idf"].to_numpy()[first].astype("<f8"),
               table["df"].to_numpy()[first].astype("<i4"), table["row"].to_numpy().astype("<i4"),
               table["tf"].to_numpy().astype("<i4")]
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(x, 1)], pa.binary()) for x in columns],
                                     names=["terms", "idf", "df", "row", "tf"])


def score(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """doc_id and held_out with score and the ids of the nearest examples."""
    index_b = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample

    def run(cols: dict) -> dict:
        told = scores(index_b.value, cols["text"], k)
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "score": [s for s, _ in told],
                "evidence": [e[:EVIDENCE] for _, e in told]}

    return map_columns(docs.select("doc_id", "held_out", "text"), run,
                       "doc_id long, held_out boolean, score double, evidence array<long>")


def scores(index: Index, texts: list, k: int) -> list[tuple[float, list[int]]]:
    """Score and evidence of each text."""
    index.unpack()
    out = []
    for b in range(0, len(texts), TOGETHER):
        queries = [index.vector(text) for text in texts[b:b + TOGETHER]]
        for q, share in zip(queries, index.postings.shares(queries)):
            if not len(q[0]):
                out.append((index.no_term, []))
                continue
            vote, near = index.vote(*q, k, share=share)
            out.append((index.calibrated(vote), [x for n in near[:EVIDENCE] for x in index.ids[n]]))
    return out


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every document; labels of held-out rows are not read."""
    held = F.coalesce(held_out, F.lit(False))
    index = fit(Scratch(docs.sparkSession), docs, labels, ~held, **bounds)
    out = score(docs.withColumn("held_out", held), index, bounds.get("k", NEIGHBOURS))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                      "evidence")


def keep_clean(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, k: int = NEIGHBOURS,
               **bounds) -> DataFrame:
    """The documents whose score is under `threshold`, with all their columns."""
    spark = docs.sparkSession
    index = fit(Scratch(spark), docs, labels, ~F.coalesce(held_out, F.lit(False)), k=k, **bounds)
    index_b = spark.sparkContext.broadcast(index)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([s for s, _ in scores(index_b.value, list(texts), k)], dtype="float64")

    return docs.filter(F.pandas_udf(run, "double")("text") < threshold)
