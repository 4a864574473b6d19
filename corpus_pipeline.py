"""A training corpus from the documents: toxic documents go, of near-duplicates one
stays, repeated passages and personal data are cut out, and the rest is packed.

Each stage is a function (spark, docs, sf_dir) of the documents that the stage
before it kept; `run` writes each stage's result as Parquet in the shared folder
and gives the reread table to the next. All but the last return the columns of
documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import packing, pii, recompress, simhash, toxicity
from strata.llm.common import Scratch, ship, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that score 0.7 or more."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), held_out, threshold=0.7)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates."""
    ship(spark)
    return simhash.keep_one(docs, shingle=4, radius=4)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words that an earlier window of 20 words repeats."""
    ship(spark)
    return recompress.remove_repeats(docs, window=20)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: the learnt stages have no SQL form; tests/llm holds the rows against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
