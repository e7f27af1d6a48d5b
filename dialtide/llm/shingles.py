"""Word shingles and their ProbMinHash signatures, vectorised over many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 19

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix((np.arange(256, dtype=_U) + _U(1)) * _ODD)
_FACTORS = mix((np.arange(SHINGLE_WORDS, dtype=_U) + _U(101)) * _ODD) | _U(1)
_powers = {_BASE: np.ones(1, _U), _INVERSE: np.ones(1, _U)}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """The first ``n`` powers modulo 2**64, kept for the next call."""
    if len(_powers[base]) < n:
        factors = np.full(1 << (n - 1).bit_length(), base, _U)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums whose differences, times an inverse power, hash any part of ``data``."""
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * powers(len(data)), out=out[1:])
    return out


def part_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    value = (prefix[end] - prefix[start]) * powers(len(prefix), _INVERSE)[start]
    return mix(value + (end - start).astype(_U) * _ODD)


def slices(column: pa.Array) -> list[pa.Array]:
    """Runs of texts of about :data:`SLICE_BYTES`; a longer text is a run of its own."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    out, first, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and total + n > SLICE_BYTES:
            out.append(column.slice(first, i - first))
            first, total = i, 0
        total += n
    return [*out, column.slice(first)] if len(column) else []


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more entry for the end)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(int)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word does not go on into the next text."""
    if not len(data):
        return np.empty(0, int), np.empty(0, int)
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    begins, stops = ~space, ~space
    begins[1:] &= space[:-1] | first[1:-1]
    stops[:-1] &= space[1:] | first[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of one text."""
    return _words(np.frombuffer(text, np.uint8), np.zeros(1, int))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; long texts are hashed a stretch at a time."""
    begins, stops = _words(data, starts)
    owner = np.searchsorted(starts, begins, "right") - 1
    out, at = np.empty(len(begins), _U), 0
    while at < len(begins):
        upto = max(int(np.searchsorted(stops, begins[at] + SLICE_BYTES)), at + 1)
        low = begins[at]
        prefix = prefix_hashes(data[low : stops[upto - 1]])
        out[at:upto] = part_hashes(prefix, begins[at:upto] - low, stops[at:upto] - low)
        at = upto
    return out, owner


def shingled(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in lower case: a 128-bit fingerprint of each one's words, and its distinct shingles.

    Shingles come as (text number, hash, count), sorted. A text of fewer words
    than a shingle has one shingle, a text without words none.
    """
    data, bounds = text_bytes(column)
    words, owner = word_hashes(data, bounds[:-1])
    n = len(column)
    counts = np.bincount(owner, minlength=n)
    ends = np.cumsum(counts)
    fingerprints = [xxhash.xxh3_128_digest(words[e - c : e].tobytes()) for e, c in zip(ends.tolist(), counts.tolist())]
    k = SHINGLE_WORDS
    if len(words) >= k:
        full = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
        hashes = sum((words[full + j] * _FACTORS[j] for j in range(k)), np.zeros(len(full), _U))
        owners = owner[full]
    else:
        hashes, owners = np.empty(0, _U), np.empty(0, int)
    short = np.flatnonzero((counts > 0) & (counts < k))
    for i in short.tolist():
        own = words[ends[i] - counts[i] : ends[i]]
        hashes = np.append(hashes, (own * _FACTORS[: len(own)]).sum(dtype=_U) + _U(len(own)))
        owners = np.append(owners, i)
    hashes = mix(hashes)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    at = np.flatnonzero(new)
    return fingerprints, owners[at], hashes[at], np.diff(np.append(at, len(hashes)))


def prob_minhash(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Signatures of weighted sets: ``size`` components for each text.

    Every element sends arrivals of a Poisson process with its weight as rate to
    random components; a component keeps the element that arrives first. Two
    sets agree in a component with the probability of their probability
    Jaccard similarity. An element stops once its next arrival comes after the
    latest first arrival of its text, since it cannot win any more.
    """
    first = np.full((texts, size), np.inf)
    winner = np.zeros((texts, size), _U)
    latest = np.full(texts, np.inf)
    time, turn = np.zeros(len(hashes)), 0
    while len(hashes):
        turn += 1
        draw = mix(hashes + _U(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log(((draw >> _U(11)).astype(float) + 0.5) * 2.0**-53) / weights
        live = time < latest[owner]
        owner, hashes, weights, time, draw = owner[live], hashes[live], weights[live], time[live], draw[live]
        slot = owner * size + (mix(draw ^ _ODD) % _U(size)).astype(int)
        flat = first.reshape(-1)
        np.minimum.at(flat, slot, time)
        won = flat[slot] == time
        winner.reshape(-1)[slot[won]] = hashes[won]
        active = np.unique(owner)
        latest[active] = first[active].max(axis=1)
        live = time < latest[owner]
        owner, hashes, weights, time = owner[live], hashes[live], weights[live], time[live]
    return winner


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """The probability Jaccard similarity of two weighted sets of distinct hashes.

    For each common element the weights of all are compared after both sets are
    scaled so that it weighs 1; the larger ones add up to the inverse of its
    share. With equal weights this is the Jaccard similarity.
    """
    if not len(a) or not len(b):
        return 0.0
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if (wa == wa[0]).all() and (wb == wb[0]).all():
        return len(ia) / (len(a) + len(b) - len(ia))
    x, y = wa[ia], wb[ib]
    order = np.argsort(x / y)
    x, y = x[order], y[order]
    larger_x = wa.sum() - np.cumsum(x) + x  # only in a, or at this ratio or above
    larger_y = wb.sum() - y.sum() + np.cumsum(y) - y  # only in b, or below this ratio
    return float((1 / (larger_x / x + larger_y / y)).sum())
