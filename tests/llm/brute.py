"""Plain single-process versions of what SQL cannot say."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@functools.cache
def library(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def encoded(name: str, text: str | None, end: tuple = ()) -> list[int]:
    return library(name).encode(text or "", add_special_tokens=False).ids + list(end)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normalised(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def line_key(line: str) -> str:
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def lines_kept(texts: list, least: int = 10) -> list[str]:
    seen = Counter(k for t in texts for k in {line_key(x) for x in (t or "").split("\n")} if k)
    return ["\n".join(x for x in (t or "").split("\n") if seen[line_key(x)] < least or not line_key(x)) for t in texts]


def quality_figures(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, again = len(words), len(covered)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), again, n < 10 or 100 * again > 20 * n


def quality_kept(rows: list[tuple]) -> list[bool]:
    """Verdicts on (text, host) rows."""
    return [v for v, _ in quality_judged(rows)]


def quality_judged(rows: list[tuple]) -> list[tuple[bool, str]]:
    """Verdicts on (text, host) rows, and the texts without template lines."""
    hosts, lines = defaultdict(set), defaultdict(set)
    for text, host in rows:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                lines[host, line_key(line)].add(text or "")
    out = []
    for text, host in rows:
        keys = [line_key(x) for x in (text or "").split("\n") if WORD.search(x)]
        frequent = {k for k in keys if len(lines[host, k]) >= 10 and len(lines[host, k]) ** 2 >= len(hosts[host])}
        left = sum(len(k) for k in keys if k not in frequent)
        rest = "\n".join(x for x in (text or "").split("\n") if line_key(x) not in frequent)
        out.append((not quality_figures(text)[5] and not 100 * left < 30 * sum(map(len, keys)), rest))
    return out


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def weights(text: str | None) -> dict:
    """1 + ln(count) of each shingle."""
    words = WORD.findall((text or "").lower())
    found = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or Counter([tuple(words)] if words else [])
    return {s: 1 + math.log(n) for s, n in found.items()}


def probability_jaccard(x: dict, y: dict) -> float:
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in x.keys() & y.keys())


def near_classes(texts: list, repeats: bool = False) -> list[int]:
    """Number of the first text of each one's class."""
    sets, holders, common = [shingles(t) for t in texts], defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            common.update((j, i) for j in holders[x])
            holders[x].append(i)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = [p for p, c in common.items() if 10 * c >= 8 * (len(sets[p[0]]) + len(sets[p[1]]) - c)]
    if repeats:
        pairs = [(a, b) for a, b in common if probability_jaccard(weights(texts[a]), weights(texts[b])) >= 0.8]
    empty = [i for i, s in enumerate(sets) if not s]
    for a, b in [*pairs, *zip(empty, empty[1:])]:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def repeats_removed(texts: list, length: int) -> list[tuple[int, int, int, bytes]]:
    """n_bytes, n_removed, n_spans and the bytes kept."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b) + 1)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


def passages_removed(texts: list, words: int) -> list[tuple[int, int, str]]:
    """Per text: runs of words that repeated windows of so many words cover, the words in them, and the rest."""
    found = [[(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    seen = Counter(tuple(w for _, _, w in own[i : i + words]) for own in found for i in range(len(own) - words + 1))
    out = []
    for text, own in zip(texts, found):
        covered = set()
        for i in range(len(own) - words + 1):
            if seen[tuple(w for _, _, w in own[i : i + words])] > 1:
                covered.update(range(i, i + words))
        runs = []
        for i in sorted(covered):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        at, rest = 0, []
        for a, b in runs:
            rest.append((text or "")[at : own[a][0]])
            at = own[b][1]
        out.append((len(runs), len(covered), "".join([*rest, (text or "")[at:]])))
    return out
