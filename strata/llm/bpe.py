"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is serialised directly from the rank file, nothing is trained: a piece
is a token's bytes mapped to visible characters, its score the negative rank, and
the normaliser leaves text alone. A text is cut by the public pattern; each match
is byte-mapped and encoded by the model's BPE, which merges the pair of best
score, leftmost first, as the rank file asks. A token that merges cannot reach is
known from encoding the vocabulary itself and kept as a whole. Decoding maps ids
back to bytes.

A map over whole texts: no shuffle, and memory bounded by the longest text.

Defined cases: a null text counts as empty; empty texts have no ids; repeated
rows each come back; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from strata.llm.common import map_columns
from strata.llm.wordmemo import WordMemo


def byte_letters() -> list[str]:
    """A visible character for each byte: itself if printable in Latin-1, else the next from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 token and rank in each line)."""
    with open(path, "rb") as f:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [found[i] for i in range(len(found))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: BPE over byte-mapped pieces, ids equal to ranks, the unknown piece last."""
    letters, normal, unknown, bpe = byte_letters(), 1, 2, 2
    pieces = [("".join(letters[b] for b in t).encode(), -float(rank), normal) for rank, t in enumerate(tokens)]
    pieces.append((b"<unk>", 0.0, unknown))
    body = b"".join(_field(1, _field(1, p) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    no = (1 << 64) - 1  # -1: there is no such id
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens)) + b"".join(
        _field(k, no) for k in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return body + _field(2, trainer) + _field(3, normalizer)


class ByteBPE:
    """Encoder and decoder for one rank file and pre-token pattern."""

    def __init__(self, rank_path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(rank_path)
        self.pattern = regex.compile(pattern)
        self.letters = dict(enumerate(byte_letters()))
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise_model(self.tokens))
        mapped = [self._letters(t) for t in self.tokens]
        ways = self.model.encode(mapped, out_type=int)
        self.whole = {m: i for i, (m, w) in enumerate(zip(mapped, ways)) if w != [i]}
        self.memo = WordMemo(self._parts)

    def _letters(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.letters)

    def _parts(self, parts: list[str]) -> list[bytes]:
        cut = [self.pattern.findall(p) for p in parts]
        new = list({w for ws in cut for w in ws})
        mapped = [self._letters(w.encode()) for w in new]
        ids = {}
        for w, m, way in zip(new, mapped, self.model.encode(mapped, out_type=int, num_threads=1)):
            ids[w] = np.array([self.whole[m]] if m in self.whole else way, "<u4").tobytes()
        return [b"".join([ids[w] for w in ws]) for ws in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.memo.ids(texts)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


@cache
def codec(rank_path: str, pattern: str) -> ByteBPE:
    return ByteBPE(rank_path, pattern)


def encode_decode(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, and with
    `keep_ids` the ids (binary) and the decoded text. `rank_path` must be readable on all machines."""
    def run(cols: dict) -> dict:
        bpe = codec(rank_path, pattern)
        ids = bpe.encode([t or "" for t in cols["text"]])
        decoded = [bpe.decode(x) for x in ids]
        out = {"doc_id": cols["doc_id"], "n_tokens": [len(x) // 4 for x in ids],
               "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
               "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded]}
        return out | ({"ids": ids, "decoded": [x.decode() for x in decoded]} if keep_ids else {})

    more = ", ids binary, decoded string" if keep_ids else ""
    return map_columns(docs.select("doc_id", "text"), run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more)
