"""Hashes used as a source of repeatable order, buckets and random numbers.

``rand()`` depends on how rows are partitioned; these depend on the row alone,
so a retried task or a different cluster gives the same answer.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_order(key: Column, seed: int = 42) -> Column:
    """A fixed pseudo-random order of the keys (32 hex digits)."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hash_bucket(key: Column, buckets: int) -> Column:
    """The key's 128-bit MD5, read as an unsigned integer, modulo ``buckets``.

    Folded over four 32-bit words so that no step leaves the bigint range.
    """
    digest = F.md5(key.cast("string"))
    shift = (1 << 32) % buckets
    acc = F.lit(0).cast("bigint")
    for word in range(4):
        part = F.conv(F.substring(digest, word * 8 + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(shift) + part) % F.lit(buckets)
    return acc.cast("int")


def hash_uniform(*parts: Column) -> Column:
    """A number in (0, 1) fixed by ``parts``."""
    bits = F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits.cast("double") + 0.5) / float(1 << 52)


def hash_normal(*parts: Column) -> Column:
    """A standard normal number fixed by ``parts`` (Box–Muller)."""
    radius = F.sqrt(-2.0 * F.log(hash_uniform(*parts, F.lit("r"))))
    return radius * F.cos(2.0 * math.pi * hash_uniform(*parts, F.lit("a")))


_P = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def _with_int(h: np.ndarray, part: np.ndarray) -> np.ndarray:
    """xxhash64 that goes on from ``h`` with an int."""
    h = (h + (_P[4] + np.uint64(4))) ^ (np.asarray(part, np.int32).view(np.uint32).astype(np.uint64) * _P[0])
    return _mixed(_turned(h, 23) * _P[1] + _P[2])


def _with_letter(h: np.ndarray, letter: str) -> np.ndarray:
    """xxhash64 that goes on from ``h`` with a text of one letter."""
    h = (h + (_P[4] + np.uint64(1))) ^ (np.uint64(ord(letter)) * _P[4])
    return _mixed(_turned(h, 11) * _P[0])


def normals_of(key_hash: np.ndarray, *parts: np.ndarray) -> np.ndarray:
    """:func:`hash_normal` of many at a time, from ``xxhash64(key)`` and ints that broadcast with it."""
    with np.errstate(over="ignore"):
        h = np.asarray(key_hash, np.int64).view(np.uint64)
        for part in parts:
            h = _with_int(h, part)
        uniform = lambda x: ((x & np.uint64((1 << 52) - 1)).astype(float) + 0.5) * 2.0**-52
        r, a = uniform(_with_letter(h, "r")), uniform(_with_letter(h, "a"))
    return np.sqrt(-2.0 * np.log(r)) * np.cos(2.0 * math.pi * a)
