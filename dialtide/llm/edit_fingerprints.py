"""Document fingerprints by randomised edit embedding.

A walk goes through a text character by character. At every step one shared
random bit, drawn for the step and the character, says whether to stay or to go
on, so a character covers one or more places of the embedded text. Two texts
with the same beginning are on the same walk; after an edit the two walks drift
against each other until they meet again. Few edits therefore leave most places
of the embedded texts equal: edit distance becomes Hamming distance.

A fingerprint samples places of the embedded text. A component has a sequence of
falling random places, shared by all texts, and takes the first that is inside
the text. For texts of any two lengths it takes the same place with the
probability of the shorter length over the longer, so components agree about as
often as places of the embedded texts do, and missing places count as different.

Bands of components are the candidates' keys (bit sampling), and whole
fingerprints verify them.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import small_batches, text_of
from .components import connected_components
from .minhash import BLOCK, by_blocks, mixed_blocks
from .shingles import mix

WALKS, SAMPLES = 4, 32
COMPONENTS = WALKS * SAMPLES
#: Characters share so many rows of random bits, and a row repeats after so many steps.
CLASSES, PERIOD = 256, 1 << 10
#: Below so many walks side by side each goes on by itself.
FEW_LANES = 64
_STEPS_AT_ONCE = 128
_LONGEST = 1 << 40
_WORK_CHARS = 1 << 20

_U = np.uint64
_ALL = (1 << 64) - 1


def _random(seed: int, n: int) -> np.ndarray:
    """``n`` numbers of 64 bits that depend on nothing but the seed."""
    return mix(mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) + _U(seed * 0xD1B54A32D192ED03 & _ALL))


@functools.cache
def step_table() -> np.ndarray:
    """[walk, class, place]: how many places a character covers that is reached at a place (modulo the period)."""
    go = (_random(1, WALKS * CLASSES * PERIOD) >> _U(63)).astype(bool).reshape(-1, PERIOD)
    again = np.concatenate([go, go], axis=1)
    place = np.where(again, np.arange(2 * PERIOD, dtype=np.int32), np.int32(4 * PERIOD))
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
    return (following - np.arange(PERIOD) + 1).astype(np.uint8).reshape(WALKS, CLASSES, PERIOD)


@functools.cache
def places(component: int) -> np.ndarray:
    """A component's places, rising: each is drawn from below the one after it."""
    out, top = [], _LONGEST
    for r in _random(1000 + component, 400).tolist():
        top = r % top
        out.append(top)
        if not top:
            break
    return np.array(sorted({0, *out}))


@functools.cache
def _class_table() -> np.ndarray:
    return (mix(np.arange(1 << 16, dtype=_U) + _U(77)) & _U(CLASSES - 1)).astype(np.uint8)


def _classes(points: np.ndarray) -> np.ndarray:
    out = _class_table()[np.minimum(points, (1 << 16) - 1)]
    far = np.flatnonzero(points >> 16)
    out[far] = (mix(points[far].astype(_U) + _U(77)) & _U(CLASSES - 1)).astype(np.uint8)
    return out


def _alone(classes: bytes, rows: list[bytes], place: int) -> list[int]:
    """The places at which one walk reaches the characters, from ``place`` on."""
    mask, out = PERIOD - 1, []
    for c in classes:
        out.append(place)
        place += rows[c][place & mask]
    return out


def arrivals(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[walk, character]: the place at which a walk through the character's text reaches it.

    All walks of all texts take each step together; those of the last and longest texts go on alone.
    """
    n, table = len(classes), step_table()
    lanes = np.argsort(-np.diff(bounds), kind="stable")
    starts, sizes = bounds[lanes], np.diff(bounds)[lanes]
    out = np.zeros((WALKS, n + 1), np.int32)
    padded, steps = np.append(classes, np.uint8(0)), table.reshape(-1)
    first_row = (np.arange(WALKS, dtype=np.int32) * (CLASSES * PERIOD))[:, None]
    place, done, live = np.zeros((WALKS, len(lanes)), np.int32), 0, len(lanes)
    while True:
        live = int(np.searchsorted(-sizes, -done, "left"))  # those longer than what is done
        if live * WALKS < FEW_LANES:
            break
        ahead = np.arange(done, min(done + _STEPS_AT_ONCE, int(sizes[0])))
        at = np.where(ahead < sizes[:live, None], starts[:live, None] + ahead, n).T
        rows = padded[at].astype(np.int32) * PERIOD
        reached, now = np.empty((len(ahead), WALKS, live), np.int32), place[:, :live]
        for t in range(len(ahead)):
            reached[t] = now
            now = now + steps.take((now & (PERIOD - 1)) + (rows[t] + first_row))
        for w in range(WALKS):
            out[w][at] = reached[:, w]
        place[:, :live] = now
        done += len(ahead)
    for w in range(WALKS):
        rows = [r.tobytes() for r in table[w]] if live else []
        for i in range(live):
            first, last = int(starts[i]) + done, int(starts[i] + sizes[i])
            out[w, first:last] = _alone(classes[first:last].tobytes(), rows, int(place[w, i]))
    return out[:, :n]


def fingerprint_texts(texts: list[str]) -> np.ndarray:
    """One row of :data:`COMPONENTS` bytes for each text; equal texts have equal rows, also empty ones."""
    points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in points], dtype=np.int64)])
    points = np.concatenate([*points, np.zeros(0, np.uint32)])
    out = np.zeros((len(texts), COMPONENTS), np.uint8)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    classes = _classes(points)
    lengths, ends = np.diff(bounds)[full], bounds[full + 1] - 1
    for walk, reached in enumerate(arrivals(classes, bounds)):
        size = reached[ends].astype(np.int64) + step_table()[walk, classes[ends], reached[ends] & (PERIOD - 1)]
        # one rising sequence over all texts, so that one search finds the characters
        shift = np.concatenate([[0], np.cumsum(size)[:-1]])
        rising = reached + np.repeat(shift, lengths)
        own = range(walk * SAMPLES, (walk + 1) * SAMPLES)
        place = np.stack([places(k)[np.searchsorted(places(k), size) - 1] for k in own], axis=1)
        order = np.argsort(place, axis=1)
        wanted = np.take_along_axis(place, order, 1) + shift[:, None]  # in rising order, which the search likes
        found = np.searchsorted(rising, wanted.reshape(-1), "right").reshape(wanted.shape) - 1
        char = np.empty_like(found)
        np.put_along_axis(char, order, points[found].astype(np.int64), 1)
        salt = _random(7 + walk, SAMPLES)
        out[full[:, None], np.array(own)] = (mix(char.astype(_U) + mix(place.astype(_U) + salt)) >> _U(56)).astype(np.uint8)
    return out


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


@F.arrow_udf(T.StringType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text as a hex string."""
    out, waiting, size = [], [], 0
    for text in texts.to_pylist():
        waiting.append(text or "")
        size += len(waiting[-1])
        if size > _WORK_CHARS:
            out, waiting, size = out + _hex(fingerprint_texts(waiting)), [], 0
    return pa.array(out + _hex(fingerprint_texts(waiting)), pa.string())


def likeness(a: Column, b: Column) -> Column:
    """The share of components in which two fingerprints agree, 0 to 1."""
    places = F.sequence(F.lit(0), F.lit(COMPONENTS - 1))
    byte = lambda x, i: F.substr(x, 2 * i + 1, F.lit(2))
    return F.size(F.filter(places, lambda i: byte(a, i) == byte(b, i))) / F.lit(float(COMPONENTS))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _router(cuts: list[int], first: dict[tuple[int | None, int], int] | None):
    """Buckets by (doc_id, hash of the text): in order of the id, null last, then of the hash.

    An id so frequent that it holds several cuts, or none at all, is spread over several buckets by the hash. With
    ``first``, the first key of every bucket also goes, as ``late``, to the bucket before it.
    """
    cuts = np.array(cuts, np.int64)
    kind = T.ArrayType(T.StructType([T.StructField("dest", T.IntegerType()), T.StructField("late", T.BooleanType())]))
    marks = np.array(sorted({h for _, h in first or {}}), np.int64)

    @F.arrow_udf(kind)
    def routes(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy()
        h = hashes.to_numpy()
        share = h / 2.0**64 + 0.5
        low, high = np.searchsorted(cuts, values, "left"), np.searchsorted(cuts, values, "right")
        low, high = np.where(known, low, len(cuts) + 1), np.where(known, high, 2 * len(cuts) + 1)
        own = low + np.minimum((share * (high - low + 1)).astype(int), high - low)
        out = [[{"dest": d, "late": False}] for d in own.tolist()]
        for i in np.flatnonzero(np.isin(h, marks)).tolist():
            before = first.get((int(values[i]) if known[i] else None, int(h[i])))
            if before is not None:
                out[i].append({"dest": before, "late": True})
        return pa.array(out, pa.list_(pa.struct([("dest", pa.int32()), ("late", pa.bool_())])))

    return routes


_NEIGHBOUR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compare(jobs: list[tuple[int | None, int, str, str]]) -> pa.RecordBatch:
    """Of (doc_id, times, text, next text): the rows of the result."""
    changed = [edited(text, following) for _, _, text, following in jobs]
    place = {t: i for i, t in enumerate(dict.fromkeys([x for j in jobs for x in j[2:]] + changed))}
    prints = fingerprint_texts(list(place))
    own, new, after = (np.array([place[t] for t in x]) for x in ([j[2] for j in jobs], changed, [j[3] for j in jobs]))
    times = np.array([j[1] for j in jobs])
    columns = [
        pa.array([j[0] for j in jobs], pa.int64()),
        pa.array([len(j[2]) for j in jobs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
        pa.array(_hex(prints[own])),
        pa.array(_hex(prints[new])),
        pa.array((prints[own] == prints[new]).mean(axis=1)),
        pa.array((prints[own] == prints[after]).mean(axis=1)),
    ]
    batch = pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NEIGHBOUR.split(",")])
    return batch.take(pa.array(np.repeat(np.arange(len(jobs)), times)))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; a document is done when the next one comes."""
    held, times, jobs, size = None, 0, [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("dest", "late", "doc_id", "h", "text")]):
            dest, late, doc_id, _, text = row
            if held and held[0] == dest and not held[1]:
                if not late and held[2:] == row[2:]:
                    times += 1
                    continue
                jobs.append((held[2], times, held[4], text))
                size += len(held[4])
                if size > _WORK_CHARS:
                    yield _compare(jobs)
                    jobs, size = [], 0
            held, times = row, 1
    if jobs:
        yield _compare(jobs)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike they and the next document's are.

    The next document is the one with the next greater doc_id, after the last
    the first; rows without an id come after all others. Rows with the same id
    are in the order of a hash of their texts, and rows that repeat both count
    once in the order: all have the same next document and the same result. The
    only document of a table is its own next one. The edited text has the last
    half of the code points replaced by as many of the next document. A null text
    is empty; the fingerprints of empty texts are alike. Texts are read whole. An
    empty table gives an empty result; other columns are not read.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    spark = docs.sparkSession
    keys = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("h"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    cuts = keys.agg(F.percentile_approx("doc_id", shares, 10 * max(parts, 1000))).first()[0] or []
    # one row a bucket: the first key of each
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "h")
    first = keys.select(key.alias("key"), F.element_at(_router(cuts, None)("doc_id", "h"), 1)["dest"].alias("dest"))
    rows = sorted((r["dest"], r["key"]) for r in first.groupBy("dest").agg(F.min("key").alias("key")).collect())
    before = {(k["doc_id"], k["h"]): rows[i - 1][0] for i, (_, k) in enumerate(rows)}

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    routed = texts.select("doc_id", "h", "text", F.inline(_router(cuts, before)("doc_id", "h")))
    order = ["dest", "late", F.asc_nulls_last("doc_id"), "h", "text"]
    routed = routed.select("dest", "late", "doc_id", "h", "text").repartition("dest").sortWithinPartitions(*order)
    return routed.mapInArrow(_neighbours, _NEIGHBOUR)


SIMILARITY_PERCENT = 80
BANDS = 16
_ROWS = COMPONENTS // BANDS
_LINK = "a long, b long"


def _links(table: pa.Table) -> pa.Table:
    """Links between members of a block whose fingerprints are alike, those that join classes only."""
    side, node, label = (table.column(c).to_numpy() for c in ("side", "node", "label"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, COMPONENTS)
    few, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    agree = np.stack([(sig[every] == sig[i]).sum(axis=1) for i in few]) if len(few) else np.zeros((0, len(every)), int)
    i, j = np.nonzero(100 * agree >= SIMILARITY_PERCENT * COMPONENTS)
    head: dict[int, int] = {}

    def root(x: int) -> int:
        while head.get(x, x) != x:
            x = head[x]
        return x

    found = []
    for a, b in zip(few[i].tolist(), every[j].tolist()):
        x, y = root(int(label[a])), root(int(label[b]))
        if x != y:
            head[max(x, y)] = min(x, y)
            found.append((int(node[a]), int(node[b])))
    return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})


def edit_classes(docs: DataFrame) -> DataFrame:
    """Each document with the class of documents whose fingerprints are alike: doc_id, class_id, class_size.

    Bands of components are the keys of buckets; in a bucket every fingerprint is
    compared with the smallest row's, then those outside its largest class with
    all others of another class, by whole fingerprints. Alike are those that
    agree in :data:`SIMILARITY_PERCENT` percent of the components; classes are
    the connected components, named by their smallest doc_id, rows without one
    last. Equal texts, empty and null ones too, are in one class. Texts are read
    whole. An empty table gives an empty result; other columns are not read.
    """
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = texts.select("doc_id", F.unhex(fingerprint("text")).alias("sig"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "edit-fingerprints")
    nodes = materialize(rows.groupBy("sig").agg(F.min("row").alias("node")), "edit-nodes")
    keys = F.array(*[F.xxhash64(F.expr(f"substring(sig, {_ROWS * i + 1}, {_ROWS})"), F.lit(i)) for i in range(BANDS)])
    cells = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    buckets = cells.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("head")).filter("c > 1")
    members = materialize(cells.join(buckets.select("key", "head"), "key"), "edit-members")
    star = members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    a, b = (nodes.select(F.col("node").alias(x), F.hex("sig").alias(f"s{x}")) for x in "ab")
    near = star.join(a, "a").join(b, "b").filter(likeness(F.col("sa"), F.col("sb")) >= SIMILARITY_PERCENT / 100)
    edges = materialize(near.select("a", "b"), "edit-links")
    labels = connected_components(edges)
    dealt = mixed_blocks(members.select("key", "band", "node"), labels, BLOCK).join(nodes, "node")
    more = materialize(by_blocks(dealt, _links, _LINK).distinct(), "edit-links")
    if not more.isEmpty():
        labels = connected_components(edges.union(more))
    named = rows.join(nodes, "sig").join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("label"))
    named = materialize(named, "edit-classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    classes = named.groupBy("label").agg(F.count("*").alias("class_size"), F.min(order).alias("first"))
    return named.join(classes, "label").select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size")
