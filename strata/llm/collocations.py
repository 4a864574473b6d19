"""Phrases whose words go together, counted in quotient filters.

1. Blocks of documents of one language become streams of local word numbers with a
   break after every piece; their words and counts are summed by (language, word).
   Words of at least `least` occurrences get a dense number (below 2**32) and the
   streams are written again with it: a phrase of a rarer word cannot be frequent.
2. For two, three and four words, each task packs the n-grams of its streams into 64
   or 128 bits and counts them in quotient filters (`strata.llm.quotient`), which are
   cut into shards, shuffled, merged in order and read back without loss. An n-gram is
   counted only if both its (n-1)-grams may be frequent by a bit table of fixed size
   (BITS), made of the frequent ones of the round before; clashes cost counting, never
   a count.
3. Counts of the parts are joined on, the lowest-scoring cut counts, phrases that a
   longer one holds nearly as often are dropped, and each language's best are kept.

Frequent phrases stay tables; the driver sees the bit table alone (16 MB). Numbers
are 64-bit counts; scores are divided as decimals of 38 digits, so nothing is rounded.

Defined cases: a null text is empty, a null language is `und`, a text without a word
gives nothing, an empty table gives an empty result; repeated rows count as often as
they stand; other columns are ignored; phrases never span pieces or documents; ties
are ordered by the phrase's UTF-8 bytes. More than 2**32 - 1 frequent words raise."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm import quotient
from strata.llm.common import CHUNK_BYTES, Scratch, chunks, mix64, numbered

#: occurrences of a phrase, words of the longest, phrases of a language, percent of the count that a longer one has
LEAST, LONGEST, TOP, PART_OF = 30, 4, 2000, 80
#: entries that a task holds before it sends filters, and slots of the bit table of frequent phrases
HELD, BITS = 1 << 21, 1 << 27
#: `.,;:!?` and line breaks end a piece; a tab separates words like a blank
_TO = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def block_rows(lang: list, texts: list) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """(language, words, counts, stream) of each language of some documents."""
    by: dict[str, tuple[list, list]] = {}
    for code, text in zip(lang, texts):
        words, lengths = by.setdefault("und" if code is None else code, ([], []))
        for piece in (text or "").encode().lower().translate(_TO).split(b"\n"):
            found = piece.split(b" ")
            if not all(found):
                found = [w for w in found if w]
            words += found
            lengths.append(len(found))
    for code, (words, lengths) in by.items():
        if not words:
            continue
        told = pa.array(words, pa.binary()).dictionary_encode()
        local = np.asarray(told.indices).astype(np.uint32) + np.uint32(1)
        stream = np.zeros(len(words) + len(lengths), np.uint32)
        stream[np.arange(len(words)) + np.repeat(np.arange(len(lengths)), lengths)] = local
        yield code, told.dictionary, np.bincount(local)[1:], stream


def blocks(docs: DataFrame) -> DataFrame:
    """block, lang, words, counts and stream (local numbers from 1, 0 between pieces)."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
                        ("stream", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                for lang, words, counts, stream in block_rows(part["lang"].to_pylist(), part["text"].to_pylist()):
                    edges = pa.array([0, len(words)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang], pa.string()), pa.ListArray.from_arrays(edges, words.cast(pa.string())),
                         pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64())),
                         pa.array([stream.tobytes()], pa.binary())], schema=schema)

    out = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return out.mapInArrow(run, "lang string, words array<string>, counts array<long>, stream binary").withColumn(
        "block", F.monotonically_increasing_id())


def recode(block: DataFrame, codes: DataFrame) -> DataFrame:
    """Streams of global numbers; rare words become breaks, and words that stand alone go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stream = np.frombuffer(batch["stream"][i].as_buffer(), np.uint32)
                pair = batch["codes"][i].values
                table = np.zeros(int(stream.max()) + 1, np.uint32)
                table[np.asarray(pc.struct_field(pair, "local"))] = np.asarray(pc.struct_field(pair, "id"))
                s = np.append(table[stream], np.uint32(0))
                word = s != 0
                near = word.copy()
                near[1:] |= word[:-1]      # a word or the break after one
                alone = word & ~np.append(False, word[:-1]) & ~np.append(word[1:], False)
                s = s[near & ~alone]
                keep = np.append(True, (s[1:] != 0) | (s[:-1] != 0)) if len(s) else np.zeros(0, bool)
                s = s[keep]
                if len(s):
                    yield pa.RecordBatch.from_arrays([pa.array([s.tobytes()], pa.binary())], names=["stream"])

    return block.join(codes, "block").select("stream", "codes").mapInArrow(run, "stream binary")


def packed(s: np.ndarray, n: int) -> quotient.Keys:
    """The n-grams at every place of a stream by 32 bits a word; absent words are zero."""
    m = max(len(s) - n + 1, 0)
    at = [s[j:j + m].astype(np.uint64) for j in range(n)] + [np.uint64(0)] * (4 - n)
    keys = [at[0] << np.uint64(32) | at[1]]
    return keys if n == 2 else [*keys, at[2] << np.uint64(32) | at[3]]


def slots(keys: quotient.Keys) -> np.ndarray:
    """Places of n-grams in the bit table."""
    h = mix64(keys[0] + np.uint64(0x9E3779B97F4A7C15))
    for k in keys[1:]:
        h = mix64(h ^ k)
    return (h % np.uint64(BITS)).astype(np.int64)


def grams(s: np.ndarray, n: int, table: np.ndarray | None) -> quotient.Keys:
    """Permuted n-grams of a stream whose words, and whose (n-1)-grams by the table, may all be frequent."""
    zeros = np.concatenate(([0], np.cumsum(s == 0)))
    whole = np.flatnonzero(zeros[n:] == zeros[:len(zeros) - n]) if len(s) >= n else np.zeros(0, np.int64)
    if table is not None and len(whole):
        # the (n-1)-grams at a place and at the next, each looked up once
        at = np.union1d(whole, whole + 1)
        slot = slots([k[at] for k in packed(s, n - 1)])
        may = np.zeros(len(s) + 1, bool)
        may[at] = table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1
        whole = whole[may[whole] & may[whole + 1]]
    return quotient.permute([k[whole] for k in packed(s, n)])


def count_phrases(scratch: Scratch, streams: DataFrame, n: int, table, least: int, shard_bits: int) -> DataFrame:
    """Written table (ws, f, slot) of the n-grams that stand `least` times or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else np.frombuffer(table.value, np.uint8)
        held, size = [], 0

        def send(keys, counts):
            made = quotient.shards(keys, counts, shard_bits)
            for i in range(0, len(made), 1024):
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in made[i:i + 1024]], pa.int32()),
                                                  pa.array([b for _, b in made[i:i + 1024]], pa.binary())],
                                                 names=["shard", "filter"])

        for batch in batches:
            for v in batch["stream"]:
                s = np.frombuffer(v.as_buffer(), np.uint32)
                part = quotient.combine(grams(s, n, bits))
                held.append(part)
                size += len(part[1])
                if size > HELD:
                    held = [quotient.merge(held)]
                    size = len(held[0][1])
                    if size > HELD // 2:
                        yield from send(*held[0])
                        held, size = [], 0
        if held:
            yield from send(*quotient.merge(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size, least_size = None, [], 0, 0

        def frequent():
            keys, counts = quotient.merge(held)
            often = counts >= least
            keys = quotient.restore([k[often] for k in keys])
            ws = [x for k in keys for x in (k >> np.uint64(32), k & np.uint64(0xFFFFFFFF))][:n]
            ws = np.stack(ws, axis=1).astype(np.int64) if len(ws) else np.zeros((0, n), np.int64)
            edges = pa.array(np.arange(len(ws) + 1) * n, pa.int32())
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(edges, pa.array(ws.reshape(-1), pa.int64())),
                                               pa.array(counts[often]), pa.array(slots(keys), pa.int64())],
                                              names=["ws", "f", "slot"])

        for batch in batches:
            for own, blob in zip(batch["shard"].to_pylist(), batch["filter"]):
                if own != shard:
                    if held:
                        yield frequent()
                    shard, held, size, least_size = own, [], 0, 0
                part = quotient.unpack(blob.as_buffer(), own)
                held.append(part)
                size += len(part[1])
                if size > HELD + 2 * least_size:  # merged again only when it has doubled
                    held = [quotient.merge(held)]
                    size = least_size = len(held[0][1])
        if held:
            yield frequent()

    filters = streams.mapInArrow(count, "shard int, filter binary")
    return scratch.write(filters.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        merge, "ws array<long>, f long, slot long"), f"phrases{n}")


def bit_table(spark: SparkSession, frequent: DataFrame):
    """The slots of the frequent phrases as a broadcast bit table of BITS / 8 bytes."""
    # these functions count from one: slot s is bit s % 32768 of bucket s // 32768 + 1
    at = F.col("slot") + 1
    rows = frequent.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = bytearray(BITS // 8)
    for r in rows.collect():
        at = (r["bucket"] - 1) * 4096
        out[at:at + 4096] = r["bits"]
    return spark.sparkContext.broadcast(bytes(out))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 part_of: int = PART_OF) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases."""
    if not 2 <= longest <= 4:
        raise ValueError("a phrase has two to four words")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    shard_bits = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1, 1).bit_length()

    block = scratch.write(blocks(docs), "blocks")
    entries = block.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("p", "e")).select(
        "block", "lang", (F.col("p") + 1).alias("local"), F.col("e.words").alias("word"), F.col("e.counts").alias("c"))
    n = block.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    often = entries.groupBy("lang", "word").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
    often = scratch.write(often, "words")
    dictionary = scratch.write(numbered(often, [], [F.col("lang"), F.col("word")], F.concat("lang", F.lit("\n"), "word"),
                                        "id").withColumn("id", F.col("id") + 1), "dictionary")
    if (dictionary.agg(F.max("id")).first()[0] or 0) >= 1 << 32:
        raise ValueError("more frequent words than 32 bits can number")
    codes = (entries.join(dictionary.select("lang", "word", "id"), ["lang", "word"]).groupBy("block")
             .agg(F.collect_list(F.struct("local", "id")).alias("codes")))
    streams = scratch.write(recode(block.select("block", "stream"), codes), "streams")

    found, table = [dictionary.select(F.array("id").alias("ws"), "f")], None
    for words in range(2, longest + 1):
        phrases = count_phrases(scratch, streams, words, table, least, shard_bits)
        found.append(phrases.select("ws", "f"))
        if words < longest:
            table = bit_table(spark, phrases)
    freq = found[0]
    for f in found[1:]:
        freq = freq.unionAll(f)
    freq = scratch.write(freq, "frequent")
    cand = freq.filter(F.size("ws") > 1).withColumnRenamed("f", "a")

    cuts = cand.select("ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.expr("slice(ws, 1, k)")).withColumn("right", F.expr("slice(ws, k + 1, size(ws))"))
    cuts = (cuts.join(freq.select(F.col("ws").alias("left"), F.col("f").alias("l")), "left")
            .join(freq.select(F.col("ws").alias("right"), F.col("f").alias("r")), "right"))
    score = F.expr("(2000000bd * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.withColumn("score", score).groupBy("ws", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("ws", "a", "cut.score", "cut.l", "cut.r")

    # a longer phrase and the phrases inside it
    inside = cand.filter(F.size("ws") > 2).select(F.col("a").alias("longer"), F.explode(F.expr(
        "flatten(transform(sequence(2, size(ws) - 1), m -> transform(sequence(1, size(ws) - m + 1), i -> slice(ws, i, m))))"
    )).alias("ws"))
    inside = inside.groupBy("ws").agg(F.max("longer").alias("longer"))
    held = F.expr(f"100bd * cast(longer as decimal(20, 0)) >= {part_of}bd * cast(a as decimal(20, 0))")
    kept = scored.join(inside, "ws", "left").filter(~F.coalesce(held, F.lit(False))).drop("longer")

    lang_of = dictionary.select(F.col("id").alias("w"), "lang")
    kept = kept.withColumn("w", F.element_at("ws", 1)).join(lang_of, "w").drop("w")
    # all that tie with a language's last place stay until the phrase's text orders them
    kept = kept.withColumn("_place", F.rank().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(
        F.col("_place") <= top).drop("_place")
    text = (kept.select("ws", F.posexplode("ws").alias("p", "w")).join(
        dictionary.select(F.col("id").alias("w"), "word"), "w").groupBy("ws")
        .agg(F.expr("array_join(transform(array_sort(collect_list(struct(p, word))), x -> x.word), ' ')").alias("phrase")))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = kept.join(text, "ws").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).join(n, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
