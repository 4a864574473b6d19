"""Registered queries of the operators: op1 to op13 over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.common import table
from strata.llm.oracles import kmeans_sql

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.simhash import simhash_groups, simhash_hex

    out = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", simhash_hex().alias("fingerprint"), "component_id")


def op2_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          end_id=1, capacity=2048)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.bpe import encode_decode
    from strata.llm.common import ship

    ship(spark)
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.sharding import shard_documents

    out = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.merkle import compare_edits

    return compare_edits(table(spark, sf_dir, "documents"))


def op6_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.recompress import repeats

    return repeats(table(spark, sf_dir, "documents"), window=20)


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op7_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"), held_out=_remainder(4) == 2)


def op8_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pii import find

    return find(table(spark, sf_dir, "documents"))


def op9_knn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=_remainder(3) == 1,
                    threshold=0.7)


def op10_rp_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.rpforest import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op11_quotient_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000, part_of=80)


def op12_ptolemaic_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ptolemy import cluster_digest

    return cluster_digest(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64, scale=1024, seed=3)


def op13_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.htmltext import extract

    return extract(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_slack_packing": op2_slack_packing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_kd_sharding": op4_kd_sharding,
    "op5_merkle_fingerprints": op5_merkle_fingerprints,
    "op6_recompression_dedup": op6_recompression_dedup,
    "op7_hyperdimensional_langid": op7_hyperdimensional_langid,
    "op8_boosted_pii": op8_boosted_pii,
    "op9_knn_toxicity": op9_knn_toxicity,
    "op10_rp_forest_dedup": op10_rp_forest_dedup,
    "op11_quotient_collocations": op11_quotient_collocations,
    "op12_ptolemaic_clustering": op12_ptolemaic_clustering,
    "op13_html_density": op13_html_density,
    "pipeline": corpus_pipeline.run,
}

# the other operators are learnt, or hash and encode in ways that SQL does not offer
ORACLE_SQL: dict[str, str] = {
    "op6_recompression_dedup": r"""
WITH d AS (SELECT doc_id, [w FOR w IN regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS w
           FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
windows AS (SELECT doc_id, s, ROW_NUMBER() OVER (PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) AS nth
            FROM places),
cut AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM windows WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, COUNT(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM words ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - COALESCE(k.n, 0) AS BIGINT) AS n_removed,
  sha256(COALESCE(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)""",
    "op10_rp_forest_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, to_id) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.to_id),
component AS (SELECT vec_id, MIN(to_id) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, COALESCE(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM component c LEFT JOIN n USING (vec_id)""",
    "op12_ptolemaic_clustering": kmeans_sql(),
    "op11_quotient_collocations": r"""
WITH d AS (SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(COALESCE(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS w FROM d),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w[i:i + m - 1] AS ws, m FROM places, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, ws, m, COUNT(*) AS f FROM grams GROUP BY ALL HAVING COUNT(*) >= 30),
n AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, ws, m, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
sides AS (SELECT c.lang, c.ws, c.m, c.a, c.k, x.f AS l, y.f AS r,
            CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
          FROM cuts c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[:k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[k + 1:]),
scored AS (SELECT * FROM sides QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
lengths AS (SELECT lang, ws, f, m, unnest(range(2, m)) AS m2 FROM f WHERE m > 2),
inside AS (SELECT lang, f, ws, m2, unnest(range(1, m - m2 + 2)) AS i FROM lengths),
longer AS (SELECT lang, ws[i:i + m2 - 1] AS ws, MAX(f) AS f FROM inside GROUP BY ALL),
kept AS (SELECT s.lang, array_to_string(s.ws, ' ') AS phrase, s.a, s.l, s.r, s.score
         FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.ws = s.ws
         WHERE g.f IS NULL OR CAST(100 AS HUGEINT) * g.f < CAST(80 AS HUGEINT) * s.a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM ranked r JOIN n USING (lang) WHERE r.rank <= 2000""",
}
