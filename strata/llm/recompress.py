"""Substring dedup by recompression.

A document's words are renamed in rounds. A round first names maximal runs of one
symbol, then pairs whose left symbol falls on the left side of a partition of all
names and whose right symbol falls on the right side. A name is a 64-bit hash of
what it stands for and the partition a bit of it, so all tasks give the same name
to the same thing without a naming join. A symbol's name is decided by a short
stretch of words around it (tracked as its dependency), so equal passages have
equal symbols wherever that stretch lies inside them.

1. A map over whole texts chooses for each window of `window` words its anchor:
   the interior symbol of the highest round whose dependency lies in the window,
   of smallest rank by hash. Equal windows have equal anchors (a word is always
   one), and neighbouring windows share them, about six each.
2. Windows travel to the bucket of their anchor's name, as packed arrays by
   anchor. Occurrences that are alike throughout inside a task's batch are settled
   there and only the earliest is sent: a passage that a third of all documents
   hold sends one copy a batch, not one a document. An anchor that by a sample's count
   has more than HOT_WINDOWS windows has several buckets, chosen by the window's hash.
3. In a bucket, shared names reveal repeats and the windows' own 64-bit hashes,
   together with 32 bits of the anchor's name, verify them; the earliest
   occurrence is told from later ones. A bucket packs the later ones' places by
   groups of documents, and a group unpacks them to one row per document.
4. The documents, joined with their places, lose the covered words.

Nothing is dropped or capped: every window of every text is compared. Equality is
that of 96 hash bits.

Defined cases: a null or empty text has no words; texts under `window` words stay
whole; rows that share doc_id and text are one document and each come back with
its result; rows of one doc_id with different texts are documents ordered by a
hash of the text; a null doc_id comes first; other columns are kept by
`remove_repeats` and ignored by `repeats`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_columns, mix64

ROUNDS = 4
#: text bytes for each bucket of windows, and of a task's batch; words whose hash a worker keeps
BUCKET_BYTES, BATCH_BYTES, KEPT_WORDS = 4 << 20, 1 << 20, 200_000
#: windows of an anchor in one bucket, text bytes of the sample that counts them, least count
HOT_WINDOWS, SAMPLE_BYTES, LEAST_COUNT = 4 << 20, 32 << 20, 16
_INDEX = np.uint64((1 << 28) - 1)
_P = np.uint64(0x9E3779B97F4A7C55)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))


class _WordHash(dict):
    """64-bit hashes of words; a worker keeps the short ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word, 7)
        if len(word) <= 32:
            self[word] = h
        return h


_HASHES = _WordHash()


def _const(*parts: int) -> np.uint64:
    """A fixed odd number for a step of a round."""
    return mix64(np.array([sum(p * 1_000_003 ** i for i, p in enumerate(parts)) + 1], np.uint64))[0] | np.uint64(1)


def rounds(name: np.ndarray, doc: np.ndarray, first: np.ndarray, end: np.ndarray, n: int = ROUNDS) -> list[tuple]:
    """(name, low, high) of the symbols after each round; a symbol depends on words [low, high).

    `doc` numbers the document of each word, [first, end) its words. What depends
    on a document's border reaches beyond it, so no window holds it."""
    low = np.arange(len(name))
    high = low + 1
    out = [(name, low, high)]
    for t in range(n):
        # runs
        same = doc[1:] == doc[:-1]
        head = np.flatnonzero(np.concatenate(([True], ~(same & (name[1:] == name[:-1])))))
        last = np.append(head[1:], len(name)) - 1
        has_left, has_right = np.concatenate(([False], same))[head], np.concatenate((same, [False]))[last]
        d = doc[head]
        new_low = np.where(has_left, low[np.maximum(head - 1, 0)], first[d] - 1)
        new_high = np.where(has_right, high[np.minimum(last + 1, len(name) - 1)], end[d] + 1)
        size = (last - head + 1).astype(np.uint64)
        own = name[head]
        name = np.where(size > 1, mix64(own + size * _const(t, 1)), own)
        doc, low, high = d, new_low, new_high
        # pairs
        left = mix64(name ^ _const(t, 2)) >> np.uint64(63) == 0
        same = doc[1:] == doc[:-1]
        pair = np.concatenate((same & left[:-1] & ~left[1:], [False]))
        has_left, has_right = np.concatenate(([False], same)), np.concatenate((same, [False]))
        after = np.concatenate((name[1:], name[:1]))
        new_high = np.where(left, np.where(has_right, np.concatenate((high[1:], [0])), end[doc] + 1), high)
        new_low = np.where(left, low, np.where(has_left, np.concatenate(([0], low[:-1])), first[doc] - 1))
        name = np.where(pair, mix64(name * _const(t, 3) + (after ^ _const(t, 4))), name)
        keep = ~np.concatenate(([False], pair[:-1]))
        name, doc, low, high = name[keep], doc[keep], new_low[keep], new_high[keep]
        out.append((name, low, high))
    return out


def anchors(levels: list[tuple], starts: np.ndarray, window: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the name and an identity of its anchor symbol."""
    names, ids = np.zeros(len(starts), np.uint64), np.full(len(starts), -1)
    todo = np.arange(len(starts))
    shift = 0
    for level in reversed(range(len(levels))):
        name, low, high = levels[level]
        at = starts[todo]
        a = np.cumsum(np.bincount(low + 1, minlength=words + 2))[at]           # symbols with low < start
        b = np.cumsum(np.bincount(high, minlength=words + 2))[at + window] - 1  # last with high <= start + window
        ok = a <= b
        if ok.any():
            rank = (mix64(name ^ _const(level, 9)) & ~_INDEX) | (_INDEX - np.arange(len(name), dtype=np.uint64))
            a, b, where = a[ok], b[ok], todo[ok]
            power = np.log2(b - a + 1).astype(np.int64)
            best, table = np.zeros(len(a), np.uint64), rank
            for k in range(int(power.max()) + 1):
                if k:
                    h = 1 << k - 1
                    table = np.maximum(table[:-h], table[h:])
                m = power == k
                best[m] = np.maximum(table[a[m]], table[b[m] - (1 << k) + 1])
            index = (_INDEX - (best & _INDEX)).astype(np.int64)
            names[where] = mix64(name[index] + _const(level, 5))
            ids[where] = shift + index
        shift += len(name)
        todo = todo[~ok]
        if not len(todo):
            break
    return names, ids


def window_hashes(h: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [starts, stops)."""
    n = len(h)
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _P))), dtype=np.uint64)
    inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _P_INV))), dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix64(h ^ _const(0, 7)) * power[:n], dtype=np.uint64)))
    return mix64((sums[stops] - sums[starts]) * inverse[starts])


def _planes(x: np.ndarray) -> np.ndarray:
    """Bytes by significance, which compress better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)


def _packed(x: np.ndarray) -> bytes:
    return _planes(x).T.tobytes()


def _unpacked(parts: list[bytes], dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    cols = [np.frombuffer(p, np.uint8).reshape(width, -1).T for p in parts]
    return np.ascontiguousarray(np.concatenate(cols)).view(dtype).ravel() if cols else np.zeros(0, dtype)


def _spans(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """0..count-1 after low, for each."""
    return np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _anchored(texts: list, window: int) -> tuple | None:
    """Texts that have a window, hashes and documents of their words, and all windows with their anchors."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    use = [i for i, w in enumerate(words) if len(w) >= window]
    if not use:
        return None
    sizes = np.array([len(words[i]) for i in use])
    end = np.cumsum(sizes)
    first = end - sizes
    n = int(end[-1])
    h = np.fromiter((_HASHES[w] for i in use for w in words[i]), np.uint64, n)
    if len(_HASHES) > KEPT_WORDS:
        _HASHES.clear()
    del words
    doc = np.repeat(np.arange(len(use)), sizes)
    starts = _spans(first, sizes - window + 1)
    names, ident = anchors(rounds(h, doc, first, end), starts, window, n)
    return use, h, doc, first, starts, names, ident


def hot_anchors(docs: DataFrame, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the anchors with more than HOT_WINDOWS windows, in order, and their numbers of buckets.

    Counted on about SAMPLE_BYTES of text; any answer gives the same result, as equal windows stay together."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if size // 2 <= HOT_WINDOWS:  # a word takes two bytes
        return none
    step = max(1, size // SAMPLE_BYTES)
    some = docs.filter(F.pmod(F.xxhash64("_id", "_tag", F.lit("anchors")), F.lit(step)) == 0).select("text")

    def run(cols: dict) -> dict:
        got = _anchored(cols["text"], window)
        names, n = np.unique(got[5], return_counts=True) if got else none
        return {"name": names.view(np.int64), "n": n}

    count = map_columns(some, run, "name long, n long", chunk_bytes=BATCH_BYTES).groupBy("name").agg(F.sum("n").alias("n"))
    found = count.filter((F.col("n") >= LEAST_COUNT) & (F.col("n") * step > HOT_WINDOWS)).collect()
    names = np.array([r["name"] for r in found], np.int64).view(np.uint64)
    parts = np.array([-(-r["n"] * step // HOT_WINDOWS) for r in found], np.int64)
    order = np.argsort(names)
    return names[order], parts[order]


def _batch(ids: list, tags: list, texts: list, window: int, buckets: int,
           hot: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))) -> Iterator[dict]:
    """Rows for the buckets, and places already known to be repeats."""
    got = _anchored(texts, window)
    if not got:
        return
    use, h, doc, first, starts, names, ident = got
    doc_id, tag = np.array([ids[i] for i in use], np.int64), np.array([tags[i] for i in use], np.int64)
    # runs of windows with one anchor
    own = doc[starts]
    head = np.flatnonzero(np.concatenate(([True], (ident[1:] != ident[:-1]) | (own[1:] != own[:-1]))))
    count = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    at, d = begin - first[own[head]], own[head]
    run_name = names[head]
    whole = window_hashes(h, begin, begin + count + window - 1)
    order = np.lexsort((at, tag[d], doc_id[d], count, whole, run_name))
    k = [x[order] for x in (run_name, whole, count)]
    new = np.concatenate(([True], (k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])))
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (doc_id[d[order]] != doc_id[d[lead]]) | (tag[d[order]] != tag[d[lead]]) | (at[order] != at[lead])
    yield from _places(doc_id[d[order[later]]], tag[d[order[later]]], at[order[later]], count[order[later]], buckets)
    # the earliest of each kind goes to its bucket
    sent = order[new]
    hashes = window_hashes(h, starts, starts + window)
    part = np.zeros(len(sent), np.uint64)
    if len(hot[0]):  # runs of hot anchors, in order of their windows' parts
        place = np.minimum(np.searchsorted(hot[0], run_name[sent]), len(hot[0]) - 1)
        parts = np.where(hot[0][place] == run_name[sent], hot[1][place], 1)
        run = np.repeat(np.arange(len(sent)), count[sent])
        at_window = _spans(head[sent], count[sent])
        own_part = mix64(hashes[at_window] ^ _const(0, 8)) % parts[run].astype(np.uint64)
        cut = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (own_part[1:] != own_part[:-1]))))
        length = np.diff(np.append(cut, len(run)))
        part, head, own_run = own_part[cut], at_window[cut], sent[run[cut]]
        d, run_name, count = d[own_run], run_name[own_run], length
        at = starts[head] - first[d]
        sent = np.arange(len(cut))
    bucket = (mix64(run_name[sent] + part * _P) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    sent, bucket = sent[by], bucket[by]
    edges = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
    for i, j in zip(edges[:-1], edges[1:]):
        r = sent[i:j]
        yield {"group": int(bucket[i]), "blob": b"".join((
            np.int64(len(r)).tobytes(), _packed(doc_id[d[r]]), _packed(tag[d[r]]),
            _packed(at[r].astype(np.int32)), _packed(count[r].astype(np.int32)),
            _packed((run_name[r] >> np.uint64(32)).astype(np.uint32)), hashes[_spans(head[r], count[r])].tobytes()))}


def _places(doc_id, tag, at, count, buckets: int) -> Iterator[dict]:
    """Repeated window starts [at, at + count), packed by groups of documents (-1 and below)."""
    group = -1 - (mix64(doc_id.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((at, tag, doc_id, group))
    doc_id, tag, at, count, group = (x[order] for x in (doc_id, tag, at, count, group))
    edges = np.append(np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))), len(group)) if len(group) else [0]
    for i, j in zip(edges[:-1], edges[1:]):
        yield {"group": int(group[i]), "blob": b"".join((
            np.int64(j - i).tobytes(), _packed(doc_id[i:j]), _packed(tag[i:j]), _packed(at[i:j].astype(np.int32)),
            _packed(count[i:j].astype(np.int32))))}


def _fields(blobs: list[bytes], widths: tuple[int, ...]) -> list[list[bytes]]:
    """The packed columns of each blob; a width of 0 takes the rest."""
    cols: list[list[bytes]] = [[] for _ in widths]
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
        for c, width in zip(cols, widths):
            c.append(blob[at:at + n * width] if width else blob[at:])
            at += n * width
    return cols


def later_windows(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, tag and start of the windows of a bucket that an earlier one equals."""
    cols = _fields(blobs, (8, 8, 4, 4, 4, 0))
    doc_id, tag, start = _unpacked(cols[0], "i8"), _unpacked(cols[1], "i8"), _unpacked(cols[2], "i4")
    count, name = _unpacked(cols[3], "i4").astype(np.int64), _unpacked(cols[4], "u4")
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in cols[5]])
    run = np.repeat(np.arange(len(count)), count)
    pos = _spans(start.astype(np.int64), count)
    order = np.argsort(h)
    s = h[order]
    twin = np.zeros(len(s), bool)
    twin[1:] = s[1:] == s[:-1]
    twin[:-1] |= twin[1:].copy()
    order = order[twin]  # hashes that occur once are first by definition
    r = run[order]
    order = order[np.lexsort((pos[order], tag[r], doc_id[r], name[r], h[order]))]
    r, p = run[order], pos[order]
    if not len(r):
        return doc_id[:0], tag[:0], pos[:0]
    new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (name[r][1:] != name[r][:-1])))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc_id[r] != doc_id[r[lead]]) | (tag[r] != tag[r[lead]]) | (p != p[lead])
    return doc_id[r[later]], tag[r[later]], p[later]


def _runs(doc_id, tag, at) -> tuple[np.ndarray, ...]:
    """Neighbouring starts of one document as (doc_id, tag, first, count)."""
    order = np.lexsort((at, tag, doc_id))
    doc_id, tag, at = doc_id[order], tag[order], at[order]
    if not len(at):
        return doc_id, tag, at, at
    new = np.concatenate(([True], (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1]) | (at[1:] - at[:-1] > 1)))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(at)) - 1
    return doc_id[head], tag[head], at[head], at[last] + 1 - at[head]


def _by_document(blobs: list[bytes]) -> pd.DataFrame:
    """One row per document with its places as pairs (first, end) of window starts."""
    cols = _fields(blobs, (8, 8, 4, 4))
    doc_id, tag, at, count = (_unpacked(c, t) for c, t in zip(cols, ("i8", "i8", "i4", "i4")))
    order = np.lexsort((at, tag, doc_id))
    doc_id, tag = doc_id[order], tag[order]
    pairs = np.stack((at[order], at[order] + count[order]), axis=1).astype(np.int32)
    head = np.flatnonzero(np.concatenate(([True], (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1]))))
    edges = np.append(head, len(doc_id))
    return pd.DataFrame({"doc_id": doc_id[head], "tag": tag[head],
                         "places": [pairs[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])]})


def repeat_places(scratch: Scratch, docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, tag, places): the starts of repeated windows of each document that has some.

    doc_id is never null here (the smallest long stands for null); tag tells texts of one doc_id apart."""
    d = keyed(docs).select("_id", "_tag", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    hot = hot_anchors(d, size, window)
    schema = "group int, blob binary"

    def packed(rows: Iterator[dict]) -> dict:
        rows = list(rows)
        return {"group": [r["group"] for r in rows], "blob": [r["blob"] for r in rows]}

    def run(cols: dict) -> dict:
        return packed(_batch(cols["_id"], cols["_tag"], cols["text"], window, buckets, hot))

    def settle(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:  # what a batch settled itself goes on as it is
            return pdf
        return pd.DataFrame(packed(_places(*_runs(*later_windows(list(pdf["blob"]))), buckets)))

    def unpack(pdf: pd.DataFrame) -> pd.DataFrame:
        return _by_document(list(pdf["blob"]))

    found = map_columns(d, run, schema, chunk_bytes=BATCH_BYTES).groupBy("group").applyInPandas(settle, schema)
    places = scratch.write(found, "places")
    return places.groupBy("group").applyInPandas(unpack, "doc_id long, tag long, places binary")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_id": F.coalesce("doc_id", F.lit(-(1 << 63))),
                             "_tag": F.xxhash64("text")})


def _kept(text: str | None, places: bytes | None, window: int) -> tuple[list[bytes], int]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not places:
        return words, 0
    pairs = np.frombuffer(places, np.int32).reshape(-1, 2)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, pairs[:, 0], 1)
    np.add.at(edge, np.minimum(pairs[:, 1] + window - 1, len(words)), -1)
    keep = np.cumsum(edge[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep)], int((~keep).sum())


def _joined(scratch: Scratch, docs: DataFrame, window: int) -> DataFrame:
    places = repeat_places(scratch, docs, window).select(F.col("doc_id").alias("_pid"), F.col("tag").alias("_ptag"),
                                                         F.col("places").alias("_places"))
    d = keyed(docs)
    return d.join(places.hint("shuffle_hash"), (F.col("_id") == F.col("_pid")) & (F.col("_tag") == F.col("_ptag")),
                  "left").drop("_pid", "_ptag", "_id", "_tag")


def repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    The figures are stored, so the texts reach the Python workers in small batches whatever
    the caller's session says, and the shuffled texts go before the caller reads."""
    def run(cols: dict) -> dict:
        got = [_kept(t, p, window) for t, p in zip(cols["text"], cols["_places"])]
        return {"doc_id": cols["doc_id"], "n_words": [len(w) + k for w, k in got], "n_removed": [k for _, k in got],
                "kept_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for w, _ in got]}

    scratch = Scratch(docs.sparkSession)
    return scratch.write(map_columns(_joined(scratch, docs.select("doc_id", "text"), window), run,
                                     "doc_id long, n_words long, n_removed long, kept_sha256 string",
                                     chunk_bytes=BATCH_BYTES), "figures")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """The documents without their repeated words. A text that loses words becomes its kept words
    joined by one space, other texts stay as they are; n_chars follows the text."""
    cut = F.pandas_udf(lambda t, p: pd.Series([
        x if p_ is None else b" ".join(_kept(x, p_, window)[0]).decode("utf-8", "surrogatepass")
        for x, p_ in zip(t, p)], dtype=object), "string")
    joined = _joined(Scratch(docs.sparkSession), docs, window)
    out = joined.withColumn("text", F.when(F.col("_places").isNull(), F.col("text")).otherwise(
        cut(F.col("text"), F.col("_places"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_places").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast("long")))
    return out.select(*docs.columns)
