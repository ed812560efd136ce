"""Keyed hashing: repeatable pseudo-random numbers that do not depend on partitioning.

``md5`` is used because any SQL engine computes the same value, so samples, splits and
resampling weights can be checked outside Spark.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, functions as F

from campaignlens.settings import SEED

HASH_RANGE = 1 << 32
BUCKET_BITS = 16


def keyed_hash(*parts, tag: str, seed: int = SEED) -> Column:
    """Uniform integer in ``[0, 2**32)`` from ``parts | seed | tag``."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed)), F.lit(tag))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(hashed: Column) -> Column:
    """Upper half of the hash: at most 65,536 evenly filled buckets."""
    return F.shiftright(hashed, 32 - BUCKET_BITS)


def poisson_cutoffs(mean: float = 1.0) -> list[int]:
    """Hash values at which a Poisson draw by inversion steps to the next integer."""
    cutoffs, term, below, k = [], math.exp(-mean), 0.0, 0
    while True:
        below += term
        k += 1
        term *= mean / k
        cutoff = round(below * HASH_RANGE)
        if cutoff >= HASH_RANGE:
            return cutoffs
        cutoffs.append(cutoff)


def poisson_weight(hashed: Column, mean: float = 1.0) -> Column:
    """Poisson draw from a keyed hash: number of cut-offs not above the hash value."""
    steps = poisson_cutoffs(mean)
    draw = F.when(hashed < steps[0], F.lit(0))
    for weight, upper in enumerate(steps[1:], start=1):
        draw = draw.when(hashed < upper, F.lit(weight))
    return draw.otherwise(F.lit(len(steps))).cast("bigint")


# --- the engine's 64-bit hash on arrays ------------------------------------------------------------

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(v: np.ndarray, bits: int) -> np.ndarray:
    return (v << np.uint64(bits)) | (v >> np.uint64(64 - bits))


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(33))) * _P2
    v = (v ^ (v >> np.uint64(29))) * _P3
    return v ^ (v >> np.uint64(32))


def _round(v: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turned(v + word * _P2, 31) * _P1


def xxhash64_int(values: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` makes of 32-bit integers, going on from the hash ``seed`` of the columns before; unsigned."""
    word = np.asarray(values).astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    v = np.atleast_1d(np.asarray(seed, np.uint64)) + _P5 + np.uint64(4)
    return _mixed(_turned(v ^ (word * _P1), 23) * _P2 + _P3)


def xxhash64_bytes(texts: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` makes of strings of one length, the rows of a matrix of bytes, going on from ``seed``; unsigned."""
    rows, length = texts.shape
    seed = np.broadcast_to(np.asarray(seed, np.uint64), (rows,))
    words = np.ascontiguousarray(texts[:, : length & -8]).view("<u8").astype(np.uint64)
    at = 0
    if length >= 32:
        lanes = [seed + _P1 + _P2, seed + _P2, seed.copy(), seed - _P1]
        while at + 4 <= length // 8:
            lanes = [_round(v, words[:, at + i]) for i, v in enumerate(lanes)]
            at += 4
        v = _turned(lanes[0], 1) + _turned(lanes[1], 7) + _turned(lanes[2], 12) + _turned(lanes[3], 18)
        for lane in lanes:
            v = (v ^ _round(np.zeros_like(lane), lane)) * _P1 + _P4
    else:
        v = seed + _P5
    v = v + np.uint64(length)
    for i in range(at, length // 8):
        v = _turned(v ^ _round(np.zeros_like(v), words[:, i]), 27) * _P1 + _P4
    at = length & -8
    if at + 4 <= length:
        half = np.ascontiguousarray(texts[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64)
        v = _turned(v ^ (half * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, length):
        v = _turned(v ^ (texts[:, i].astype(np.uint64) * _P5), 11) * _P1
    return _mixed(v)
