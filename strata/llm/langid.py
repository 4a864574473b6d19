"""Language identification by hyperdimensional profiles.

Each letter class has a random vector of +1 and -1. A trigram's vector binds its
letters by product, each permuted by its place; a document's vector bundles its
trigrams by sum, a language's prototype bundles its training documents, each with
the same weight. A text gets the language whose prototype has the largest cosine
with its vector, both seen from the mean of the prototypes.

Bundling is linear, so training only sums trigram counts per language on Spark and
binds them once: at most 64³ trigrams per language reach the driver. Prediction is
a map over whole texts: counts times trigram vectors, some thousand trigrams and a
few dozen documents at a time. Code points fall into 63 letter classes by a fixed
rule (lower-cased letters; a run of other characters is one space).

Defined cases: a null text or one without a letter is `und` with score 0; without
training rows every text is `und`; ties go to the first language by name; rows
with null lang do not train; repeated rows count each; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, chunks, map_columns

#: vector length, letter classes (0 is the space between words)
DIM, CLASSES = 1024, 64
CODES = CLASSES ** 3
#: documents and trigrams of a matrix product
DOCS, TRIGRAMS = 64, 16_384


@cache
def letter_classes() -> np.ndarray:
    """Class of each code point: 0 for what is no letter, else 1 to 63."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = 1 + c % (CLASSES - 1)
    return table


@cache
def letter_vectors(dim: int = DIM) -> np.ndarray:
    return np.random.default_rng(20).choice(np.array([-1, 1], np.int8), (CLASSES, dim))


def trigram_vectors(codes: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Bound vectors (float32) of trigram codes: permuted twice, once, not at all."""
    v = letter_vectors(dim)
    a, b, c = codes // CLASSES ** 2, codes // CLASSES % CLASSES, codes % CLASSES
    return (np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]).astype(np.float32)


def trigrams(text: str | None) -> np.ndarray:
    """Codes of the letter trigrams of a text, words set apart by single spaces."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    k = letter_classes()[np.frombuffer(raw, np.uint32)]
    if not k.any():
        return np.zeros(0, np.int64)
    k = np.concatenate(([0], k, [0]))
    k = k[np.concatenate(([True], (k[1:] > 0) | (k[:-1] > 0)))].astype(np.int64)
    return (k[:-2] * CLASSES + k[1:-1]) * CLASSES + k[2:]


def _counts(texts: list) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(documents, trigram codes, counts of the documents by codes)."""
    for i in range(0, len(texts), DOCS):
        found = [trigrams(t) for t in texts[i:i + DOCS]]
        codes = np.concatenate(found)
        row = np.repeat(np.arange(len(found)), [len(x) for x in found])
        present = np.flatnonzero(np.bincount(codes, minlength=CODES)) if len(codes) else codes
        place = np.zeros(CODES, np.int64)
        place[present] = np.arange(len(present))
        m = np.bincount(row * max(1, len(present)) + place[codes], minlength=len(found) * max(1, len(present)))
        yield slice(i, i + len(found)), present, m.reshape(len(found), -1)


def train(docs: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages and unit prototypes (one row each, seen from their mean) from columns text and lang."""
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch, "text", 4 << 20):
                langs, texts = part.column(1).to_pylist(), part.column(0).to_pylist()
                for s, codes, m in _counts(texts):
                    share = m / np.maximum(1, m.sum(axis=1, keepdims=True))
                    own = langs[s]
                    for lang in set(own):
                        pick = np.array([x == lang for x in own])
                        total = sums.setdefault(lang, np.zeros(CODES))
                        total[codes] += share[pick].sum(axis=0) if len(codes) else 0
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            # whole numbers: their sum does not depend on the order
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(np.round(total[at] * 2.0 ** 32).astype(np.int64))], ["lang", "code", "w"])

    rows = docs.select("text", "lang").dropna().mapInArrow(profile, "lang string, code int, w long")
    got = rows.groupBy("lang", "code").agg(F.sum(F.col("w").cast("double")).alias("w")).toPandas()
    langs = sorted(set(got["lang"]))
    proto = np.zeros((len(langs), dim))
    for i, lang in enumerate(langs):
        own = got[got["lang"] == lang].sort_values("code")
        codes, w = own["code"].to_numpy(np.int64), own["w"].to_numpy() / max(1.0, own["w"].sum())
        for j in range(0, len(codes), TRIGRAMS):
            proto[i] += w[j:j + TRIGRAMS] @ trigram_vectors(codes[j:j + TRIGRAMS], dim)
    return langs, proto


def predict(docs: DataFrame, langs: list[str], proto: np.ndarray) -> DataFrame:
    """The columns doc_id and held_out of `docs` with lang_pred and score (cosine, 0 to 1) of text."""
    dim = proto.shape[1] if len(langs) else DIM
    mean = proto.mean(axis=0) if len(langs) > 1 else np.zeros(dim)
    unit = (proto - mean) / np.maximum(1e-12, np.linalg.norm(proto - mean, axis=1, keepdims=True))
    unit32, mean32 = unit.astype(np.float32), mean.astype(np.float32)

    def run(cols: dict) -> dict:
        texts = cols["text"]
        pred, score = ["und"] * len(texts), [0.0] * len(texts)
        for s, codes, m in _counts(texts):
            if not len(codes) or not len(langs):
                continue
            v = np.zeros((len(m), dim), np.float32)
            total = np.maximum(1, m.sum(axis=1, keepdims=True))
            share = (m / total).astype(np.float32)
            for j in range(0, len(codes), TRIGRAMS):
                v += share[:, j:j + TRIGRAMS] @ trigram_vectors(codes[j:j + TRIGRAMS], dim)
            v -= mean32
            cosine = v @ unit32.T / np.maximum(1e-12, np.linalg.norm(v, axis=1, keepdims=True))
            best = cosine.argmax(axis=1)
            for i in np.flatnonzero(m.sum(axis=1)):
                pred[s.start + i] = langs[best[i]]
                score[s.start + i] = float(min(1.0, max(0.0, cosine[i, best[i]])))
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": pred, "score": score}

    return map_columns(docs.select("doc_id", "held_out", "text"), run,
                       "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """Train on the rows outside `held_out` and predict all."""
    Scratch(docs.sparkSession)
    d = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    langs, proto = train(d.filter(~F.col("held_out")))
    return predict(d, langs, proto)
