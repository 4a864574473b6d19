"""Sequence packing by minimum bin slack.

1. A map over whole texts encodes them and cuts each document into pieces: full
   windows from its start, then the remainder. A piece carries its place and the
   CRC of its ids; the ids stay in the task unless asked for.
2. The histogram of piece lengths (as many rows as there are lengths, at most the
   capacity) is planned on the driver: for the longest remaining length a bitset
   subset-sum over the remaining multiset finds the filling closest to the
   capacity; backtracking gives its counts, and the filling is repeated as often
   as the remaining counts allow. The plan's size follows the capacity, not the
   data.
3. Each piece is numbered within its length (salted, so a length that a third of
   all pieces share is dealt over many tasks) and finds its sequence and offset
   in the plan by a broadcast range join.

Defined cases: a null or empty text is one piece that holds the end id alone;
repeated rows are packed each for itself; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import byte_letters
from strata.llm.common import Scratch, map_columns, numbered

CAPACITY = 2048


@cache
def _encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids (unsigned 32-bit) of a text as `tokenizers` gives them for the file, without special tokens added.

    A byte-level BPE file whose merges stand in the order of their ids is a rank
    table: merging the pair of lowest rank first is the same rule, and `tiktoken`
    applies it several times faster. For any other file `tokenizers` encodes."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, vocab, pre = told["model"], told["model"]["vocab"], told.get("pre_tokenizer") or {}
    merged = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model.get("merges", [])]
    special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
    plain = all(not t.get(k) for t in told.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word"))
    ids = [vocab.get(m, -1) for m in merged]
    if (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and not told.get("normalizer") and plain and ids == sorted(set(ids))
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout"))):
        back = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items() if t not in special}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> np.ndarray:
            if any(x in text for x in special):
                return own.encode_to_numpy(text, allowed_special="all")
            return np.array(own.encode_ordinary(text), np.uint32)

        return encode
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda text: np.array(t.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
           keep_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of every piece, at most `capacity` long."""
    def run(cols: dict) -> dict:
        out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
        encode = _encoder(tokenizer_path)
        for doc_id, text in zip(cols["doc_id"], cols["text"]):
            ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4").tobytes()
            n = len(ids) // 4
            for start in range(0, n, capacity):
                part = ids[4 * start:4 * (start + capacity)]
                for k, v in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), n, part)):
                    out[k].append(v)
        return out

    return map_columns(docs.select("doc_id", "text"), run,
                       "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
                       + (", ids binary" if keep_ids else ""))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Counts per length of a multiset within `counts` whose sum is as close to `room` as any can be."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left > 0:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, copies = left - take, copies * 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            out[length] = out.get(length, 0) + take
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Fillings (counts per length) and how often each is used; every piece is used once."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        filling = fullest(left, capacity - longest)
        left[longest] += 1
        filling[longest] = filling.get(longest, 0) + 1
        times = min(left[k] // v for k, v in filling.items())
        out.append((filling, times))
        for k, v in filling.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return out


def places(fillings: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each length and filling: the piece numbers [low, high) it takes, how many in a sequence, and where."""
    rows, taken, sequence = [], {}, 0
    for filling, times in fillings:
        offset = 0
        for length in sorted(filling, reverse=True):
            per = filling[length]
            low = taken.get(length, 0)
            taken[length] = low + per * times
            rows.append((length, low, low + per * times, per, sequence, offset))
            offset += length * per
        sequence += times
    return pd.DataFrame(rows, columns=["length", "low", "high", "per", "sequence0", "offset0"], dtype="int64")


def pack(scratch: Scratch, cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan(counts, capacity))
    if where.empty:
        return cut.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    law = F.broadcast(spark.createDataFrame(where))
    d = numbered(cut, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")],
                 F.struct("doc_id", "start", "ids_crc32"), "number")
    d = d.join(law, (d["length"] == law["length"]) & (F.col("number") >= F.col("low"))
               & (F.col("number") < F.col("high"))).drop(law["length"])
    nth = F.col("number") - F.col("low")
    return (d.withColumn("sequence_id", F.col("sequence0") + F.floor(nth / F.col("per")).cast("long"))
            .withColumn("offset", F.col("offset0") + F.pmod(nth, F.col("per")) * F.col("length"))
            .select(*cut.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    scratch = Scratch(docs.sparkSession)
    return pack(scratch, scratch.write(pieces(docs, tokenizer_path, end_id, capacity), "pieces"), capacity)
