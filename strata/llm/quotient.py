"""Counting quotient filters over packed n-grams: lossless, compact and mergeable.

A key is one or two unsigned 64-bit words. `permute` is a Feistel network, a
bijection on the key's bits that spreads keys evenly; `restore` is its inverse. The
first `shard_bits` of a permuted key name its shard, the next bits its quotient, and
all bits that are left are its remainder, stored in full. So a filter holds the exact
set of its keys with exact counts, and equal keys have equal places in all filters.

A filter stores its entries in the order of (quotient, remainder): one bit a quotient
says whether it is occupied, one bit an entry ends the run of its quotient, then come
the remainders and the counts, one byte each with longer counts apart. The quotient
has about log2(entries) bits, so the two bit vectors replace that many bits a key.
Sorted filters of a shard merge by their order alone, without the keys restored."""

from __future__ import annotations

import struct

import numpy as np

from strata.llm.common import mix64

_ROUNDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
_HEAD = struct.Struct("<QQBBB")
LONG_COUNT = 255

#: permuted or plain keys by column, the most significant word first
Keys = list[np.ndarray]


def permute(keys: Keys) -> Keys:
    if len(keys) == 1:
        left, right = keys[0] >> _HALF, keys[0] & _LOW
        for k in _ROUNDS:
            left, right = right, left ^ (mix64(right + k) & _LOW)
        return [left << _HALF | right]
    left, right = keys
    for k in _ROUNDS:
        left, right = right, left ^ mix64(right + k)
    return [left, right]


def restore(keys: Keys) -> Keys:
    if len(keys) == 1:
        left, right = keys[0] >> _HALF, keys[0] & _LOW
        for k in reversed(_ROUNDS):
            left, right = right ^ (mix64(left + k) & _LOW), left
        return [left << _HALF | right]
    left, right = keys
    for k in reversed(_ROUNDS):
        left, right = right ^ mix64(left + k), left
    return [left, right]


def combine(keys: Keys, counts: np.ndarray | None = None) -> tuple[Keys, np.ndarray]:
    """Sorted distinct keys and the sums of their counts (None: one each)."""
    if not len(keys[0]):
        return keys, np.zeros(0, np.int64)
    if counts is None and len(keys) == 1:
        keys = [np.sort(keys[0])]
    else:
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        counts = None if counts is None else counts[order]
    new = np.ones(len(keys[0]), bool)
    new[1:] = keys[0][1:] != keys[0][:-1]
    for k in keys[1:]:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    if counts is None:
        sums = np.diff(np.append(first, len(new)))
    else:
        sums = np.add.reduceat(counts, first)
    return [k[first] for k in keys], sums.astype(np.int64)


def pack(keys: Keys, counts: np.ndarray, shard_bits: int) -> bytes:
    """A filter of sorted distinct permuted keys that share their first `shard_bits`."""
    n = len(counts)
    q = min(max(n - 1, 0).bit_length(), 64 - shard_bits)
    top = keys[0] << np.uint64(shard_bits) if shard_bits else keys[0]
    quotient = (top >> np.uint64(64 - q)).astype(np.int64) if q else np.zeros(n, np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
    # whole bytes of the first word that are not given by shard and quotient, then the others
    rest = 8 - (shard_bits + q) // 8
    words = [k.astype(">u8").view(np.uint8).reshape(n, 8) for k in keys]
    remainder = np.concatenate([words[0][:, 8 - rest:], *words[1:]], axis=1)
    long = counts >= LONG_COUNT
    return b"".join((_HEAD.pack(n, int(long.sum()), q, len(keys), shard_bits), np.packbits(occupied).tobytes(),
                     np.packbits(ends).tobytes(), remainder.tobytes(),
                     np.minimum(counts, LONG_COUNT).astype(np.uint8).tobytes(), counts[long].astype("<i8").tobytes()))


def unpack(blob: bytes, shard: int) -> tuple[Keys, np.ndarray]:
    """Sorted permuted keys and counts of a filter of `shard`."""
    n, longs, q, width, shard_bits = _HEAD.unpack_from(blob)
    at = _HEAD.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(blob, np.uint8, size, at - size)

    occupied = np.unpackbits(take(((1 << q) + 7) // 8), count=1 << q)
    ends = np.unpackbits(take((n + 7) // 8), count=n).astype(np.int64)
    rest = 8 - (shard_bits + q) // 8
    remainder = take(n * (rest + 8 * (width - 1))).reshape(n, rest + 8 * (width - 1))
    counts = take(n).astype(np.int64)
    counts[counts == LONG_COUNT] = np.frombuffer(blob, "<i8", longs, at)
    run = np.cumsum(ends) - ends  # the run of each entry
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    first = np.zeros((n, 8), np.uint8)
    first[:, 8 - rest:] = remainder[:, :rest]
    first = first.reshape(-1).view(">u8").astype(np.uint64)
    prefix = np.full(n, shard, np.uint64) << np.uint64(64 - shard_bits) if shard_bits else np.zeros(n, np.uint64)
    if q:
        prefix = prefix | quotient << np.uint64(64 - shard_bits - q)
    keys = [first | prefix]
    for i in range(width - 1):
        keys.append(np.ascontiguousarray(remainder[:, rest + 8 * i:rest + 8 * i + 8]).reshape(-1).view(">u8")
                    .astype(np.uint64))
    return keys, counts


def merge(parts: list[tuple[Keys, np.ndarray]]) -> tuple[Keys, np.ndarray]:
    """One sorted set of entries of several."""
    if len(parts) == 1:
        return parts[0]
    return combine([np.concatenate(k) for k in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))


def shards(keys: Keys, counts: np.ndarray, shard_bits: int) -> list[tuple[int, bytes]]:
    """(shard, filter) of all shards that hold one of the sorted keys."""
    own = (keys[0] >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(counts), np.int64)
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    return [(int(own[a]), pack([k[a:b] for k in keys], counts[a:b], shard_bits))
            for a, b in zip(first, np.append(first[1:], len(own)))]
