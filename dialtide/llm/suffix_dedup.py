"""Removal of repeated strings and of repeated passages.

Two units are looked for in one pass: strings of :data:`LENGTH` bytes, and
passages of :data:`PASSAGE_WORDS` words, whatever white space is between these.
What any of them covers that also starts anywhere else is repeated.

This counts winnowed fingerprints. It takes the place of bucket-pointer
refinement, which would store and join identifiers at later offsets level by
level; here hashes of whole windows say at once which repeat. Instead of all
suffixes it groups *anchors*: in each window of the wanted length, the q-gram
with the smallest hash. Equal windows have their anchor at the same offset, so
no repeat is missed. An anchor's windows are those it is the anchor of.

1. The initial bucket of an anchor is its q-gram. A bucket of one is finished.
2. Buckets are refined by the identifier of everything the anchor's windows
   cover. Anchors that share it are finished: all their windows repeat.
3. The others, with one member of each class found in step 2, are refined by the
   identifiers of their single windows. Small buckets do this inside a task; the
   windows of large ones are counted in a shuffle of their own, so the size of a
   bucket does not matter.

Texts travel compressed, first to the anchors of step 3 and then to the
removed spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release
from .common import carried, hash128, retexted, small_batches, text_of, uncarried
from .shingles import (
    SLICE_BYTES,
    mix,
    part_hashes,
    powers,
    prefix_hashes,
    slices,
    text_bytes,
    word_bounds,
    word_hashes,
)

LENGTH = 400
PASSAGE_WORDS = 51
LARGE_BUCKET = 2000  #: members beyond which a bucket's windows are counted in a shuffle
_POSITION_BITS = 24
BYTES, WORDS = 0, 1  #: the units

_ANCHOR = [("unit", pa.int8()), *[(c, pa.int32()) for c in ("at", "first", "last")], ("core", pa.int64()), ("cover", pa.int64())]
ANCHORS = (
    "k1 long, k2 long, unit array<tinyint>, at array<int>, first array<int>, last array<int>, core array<long>, cover array<long>"
)
MEMBER = ["unit", "core", "large", "row", "weight", "at", "first", "last"]
CONTEXT = "unit tinyint, core long, large boolean, row long, weight int, at int, first int, last int, bytes binary"
WINDOW = "unit tinyint, row long, first int, name1 long, name2 long, weight int"
SPAN = "unit tinyint, row long, start int, end int"


def window_grams(length: int) -> int:
    """Windows that share one anchor at most, a power of two; q-grams are as long as that leaves."""
    return 1 << ((2 * length // 3).bit_length() - 1)


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def find_anchors(prefix: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that end at ``ends``: position, first and last window, q-gram hash.

    Positions are those of the bytes or words whose prefix sums are given.
    """
    n, width = len(prefix) - 1, window_grams(length)
    q = length - width + 1
    start = np.arange(n - q + 1)
    grams = part_hashes(prefix, start, start + q)
    low = np.uint64(_POSITION_BITS)
    least = _sliding_least(grams >> low << low | start.astype(np.uint64), width)
    anchor = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(int)
    text = np.searchsorted(ends, np.arange(len(anchor)), "right")
    valid = np.arange(len(anchor)) + length <= ends[np.minimum(text, len(ends) - 1)]
    windows = np.flatnonzero(valid)
    anchor = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    runs = np.flatnonzero(new)
    last = windows[np.append(runs[1:], len(windows)) - 1] if len(windows) else windows
    return anchor[runs], windows[runs], last, grams[anchor[runs]]


def _word_prefix(hashes: np.ndarray) -> np.ndarray:
    """Like :func:`prefix_hashes`, over the hashes of words."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes)), out=out[1:])
    return out


def _stretches(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, offset in it, bytes, ends of texts); a long text comes in overlapping stretches."""
    at = 0
    for part in slices(column):
        data, bounds = text_bytes(part)
        if len(part) == 1 and len(data) > 2 * SLICE_BYTES:
            for offset in range(0, len(data), SLICE_BYTES):
                piece = data[offset : offset + SLICE_BYTES + length - 1]
                yield at, offset, piece, np.array([len(piece)])
        else:
            yield at, 0, data, bounds[1:]
        at += len(part)


def _word_stretches(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same of the hashes of words."""
    at = 0
    for part in slices(column):
        data, bounds = text_bytes(part)
        hashes, owner = word_hashes(data, bounds[:-1])
        if len(part) == 1 and len(hashes) > 2 * SLICE_BYTES:
            for offset in range(0, len(hashes), SLICE_BYTES):
                piece = hashes[offset : offset + SLICE_BYTES + words - 1]
                yield at, offset, piece, np.array([len(piece)])
        else:
            yield at, 0, hashes, np.searchsorted(owner, np.arange(1, len(part) + 1))
        at += len(part)


def _anchored(lengths: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            found = [[[] for _ in _ANCHOR] for _ in range(batch.num_rows)]
            for unit, length in lengths.items():
                cut = _stretches if unit == BYTES else _word_stretches
                for text, offset, data, ends in cut(column, length):
                    if len(data) < length:
                        continue
                    prefix = prefix_hashes(data) if unit == BYTES else _word_prefix(data)
                    at, first, last, grams = find_anchors(prefix, ends, length)
                    begins = np.concatenate([[0], ends[:-1]])
                    owner = np.searchsorted(ends, first, "right")
                    raw, size, base = data.tobytes(), data.itemsize, begins[owner] - offset
                    covers = [xxhash.xxh3_64_intdigest(raw[a * size : (b + length) * size]) for a, b in zip(first.tolist(), last.tolist())]
                    covers = np.array(covers, np.uint64).view(np.int64)
                    # grams of bytes and of words are never in one bucket
                    grams = mix(grams + np.uint64(unit)).view(np.int64)
                    columns = (np.full(len(at), unit), at - base, first - base, last - base, grams, covers)
                    cuts = np.searchsorted(owner, np.arange(len(ends) + 1))
                    for i in np.unique(owner).tolist():
                        for out, values in zip(found[text + i], columns):
                            out.append(values[cuts[i] : cuts[i + 1]])
            arrays = [
                pa.array([np.concatenate(x[c]) if x[c] else [] for x in found], pa.list_(t)) for c, (_, t) in enumerate(_ANCHOR)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), *arrays], names=["k1", "k2", *[c for c, _ in _ANCHOR]]
            )

    return run


@F.arrow_udf(T.BinaryType())
def squeezed(texts: pa.Array) -> pa.Array:
    shrink = zstandard.ZstdCompressor(level=1)
    return pa.array([shrink.compress(t.encode()) for t in texts.to_pylist()], pa.binary())


def _contexts(lengths: dict[int, int]):
    """The bytes that the windows of each member cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data, out, bounds = grow.decompress(row["blob"]), [], None
                for m in row["members"]:
                    first, last = m["first"], m["last"] + lengths[m["unit"]]
                    if m["unit"] == WORDS:
                        bounds = word_bounds(data) if bounds is None else bounds
                        first, last = int(bounds[0][first]), int(bounds[1][last - 1])
                    out.append((*[m[c] for c in MEMBER], data[first:last]))
                types = [pa.int8(), pa.int64(), pa.bool_(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*MEMBER, "bytes"])

    return run


def _by_unit(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    units = table.column("unit").to_numpy()
    for unit in np.unique(units).tolist():
        yield unit, table.take(pa.array(np.flatnonzero(units == unit))).combine_chunks()


def _windows(table: pa.Table, unit: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of the members: member, offset from the first window, and two hashes of bucket, place and content."""
    data, bounds = text_bytes(table.column("bytes").combine_chunks())
    first, last, at = (table.column(c).to_numpy().astype(int) for c in ("first", "last", "at"))
    if unit == BYTES:
        begins, prefix = bounds[:-1], prefix_hashes(data)
    else:
        hashes, owner = word_hashes(data, bounds[:-1])
        begins, prefix = np.searchsorted(owner, np.arange(len(first))), _word_prefix(hashes)
    counts = last - first + 1
    member = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = begins[member] + inner
    core = table.column("core").to_numpy().view(np.uint64)[member]
    place = (at[member] - first[member] - inner).astype(np.uint64)
    name = mix(part_hashes(prefix, start, start + length) ^ mix(core + place))
    # the second hash: of the window's two halves, each by itself
    half = length // 2
    other = mix(part_hashes(prefix, start, start + half)) + part_hashes(prefix, start + half, start + length)
    return member, inner, name, mix(other ^ core)


def _spans(table: pa.Table, unit: int, member: np.ndarray, inner: np.ndarray, hit: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of repeated windows as spans of the unit."""
    member, inner = member[hit], inner[hit]
    new = np.ones(len(member), bool)
    new[1:] = (member[1:] != member[:-1]) | (inner[1:] != inner[:-1] + 1)
    runs = np.flatnonzero(new)
    ends = np.append(runs[1:], len(member)) - 1 if len(member) else runs
    first = table.column("first").to_numpy().astype(int)
    rows = table.column("row").to_numpy()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(runs), unit, np.int8)),
            pa.array(rows[member[runs]], pa.int64()),
            pa.array((first[member[runs]] + inner[runs]).astype(np.int32)),
            pa.array((first[member[ends]] + inner[ends] + length).astype(np.int32)),
        ],
        names=["unit", "row", "start", "end"],
    )


def _small_buckets(lengths: dict[int, int]):
    """Repeated windows of buckets that come sorted; each batch of work holds whole buckets."""

    def solve(table: pa.Table, unit: int) -> pa.RecordBatch:
        member, inner, name, other = _windows(table, unit, lengths[unit])
        weight = table.column("weight").to_numpy()[member]
        order = np.lexsort((other, name))
        sorted_name, sorted_other = name[order], other[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_name[1:] != sorted_name[:-1]) | (sorted_other[1:] != sorted_other[:-1])
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=weight[order], minlength=0)
        hit = np.zeros(len(order), bool)
        hit[order] = total[group] >= 2
        alone = table.column("weight").to_numpy()[member] < 2  # members of weight 2 stand for finished classes
        return _spans(table, unit, member, inner, hit & alone, lengths[unit])

    def solved(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for unit, part in _by_unit(table):
            yield solve(part, unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column("bytes").nbytes
            if size > SLICE_BYTES:
                table = pa.Table.from_batches(waiting)
                core = table.column("core").to_numpy()
                cut = int(np.flatnonzero(core != core[-1])[-1]) + 1 if (core != core[-1]).any() else 0
                if cut:
                    yield from solved(table.slice(0, cut))
                    waiting = table.slice(cut).to_batches()
                    size = sum(b.column("bytes").nbytes for b in waiting)
        if waiting:
            yield from solved(pa.Table.from_batches(waiting))

    return run


def _named_windows(lengths: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                for unit, table in _by_unit(pa.Table.from_batches([batch.slice(at, 2048)])):
                    member, inner, name, other = _windows(table, unit, lengths[unit])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(member), unit, np.int8)),
                            pa.array(table.column("row").to_numpy()[member]),
                            pa.array((table.column("first").to_numpy()[member] + inner).astype(np.int32)),
                            pa.array(name.view(np.int64)),
                            pa.array(other.view(np.int64)),
                            pa.array(table.column("weight").to_numpy()[member].astype(np.int32)),
                        ],
                        names=["unit", "row", "first", "name1", "name2", "weight"],
                    )

    return run


def repeated_spans(docs: DataFrame, lengths: dict[int, int], large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """Per distinct text that has any: its hash (k1, k2) and the spans, by unit, that repeats cover, which may overlap."""
    keyed = small_batches(docs).select(text_of().alias("text")).withColumn("k", hash128(F.col("text")))
    keyed = keyed.select(F.col("k.h1").alias("k1"), F.col("k.h2").alias("k2"), "text")
    # a word takes a byte and, but for the last, one of white space
    least = min(n if unit == BYTES else 2 * n - 1 for unit, n in lengths.items())
    long_enough = keyed.filter(F.octet_length("text") >= least)
    anchors = long_enough.mapInArrow(_anchored(lengths), ANCHORS).withColumn("row", F.monotonically_increasing_id())
    anchors = materialize(anchors, "anchors")
    each = anchors.select("row", F.inline(F.arrays_zip("unit", "at", "first", "last", "core", "cover")))
    reach = F.element_at(F.create_map(*[F.lit(x).cast("int") for pair in lengths.items() for x in pair]), F.col("unit").cast("int"))

    shared = each.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    live = materialize(each.join(materialize(shared, "shared-grams"), "core"), "live-anchors")
    classes = live.groupBy("core", "cover").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "unit", "at", "first", "last")).alias("one")
    )
    classes = materialize(classes.select("core", "cover", "n", "one.*"), "anchor-classes")
    finished = classes.filter("n > 1").select("core", "cover")
    whole = live.join(finished, ["core", "cover"]).select(
        "unit", "row", F.col("first").alias("start"), (F.col("last") + reach).alias("end")
    )

    # buckets with anchors that are not finished, and one member of each finished class in them
    open_buckets = (
        classes.groupBy("core")
        .agg(F.count("*").alias("members"), F.count_if(F.col("n") == 1).alias("open"))
        .filter("open > 0")
        .select("core", (F.col("members") > large_bucket).alias("large"))
    )
    members = classes.join(materialize(open_buckets, "open-buckets"), "core").select(
        "row", "unit", "core", "large", F.least("n", F.lit(2)).cast("int").alias("weight"), "at", "first", "last"
    )
    listed = members.groupBy("row").agg(F.collect_list(F.struct(*MEMBER)).alias("members"))
    wanted = listed.join(anchors.select("row", "k1", "k2"), "row")
    # equal texts may be named by several of their rows; each text is sent once
    wanted = wanted.groupBy("k1", "k2").agg(F.flatten(F.collect_list("members")).alias("members"))
    texts = long_enough.select("k1", "k2", squeezed("text").alias("blob")).dropDuplicates(["k1", "k2"])
    contexts = texts.join(wanted.hint("merge"), ["k1", "k2"]).select("blob", "members").mapInArrow(_contexts(lengths), CONTEXT)
    contexts = materialize(contexts, "contexts")

    small = contexts.filter("NOT large").repartition("core").sortWithinPartitions("core")
    small = small.mapInArrow(_small_buckets(lengths), SPAN)
    windows = contexts.filter("large").mapInArrow(_named_windows(lengths), WINDOW)
    again = windows.groupBy("name1", "name2").agg(F.sum("weight").alias("n")).filter("n > 1").select("name1", "name2")
    large = windows.filter("weight = 1").join(materialize(again, "repeated-windows"), ["name1", "name2"])
    large = large.select("unit", "row", F.col("first").alias("start"), (F.col("first") + reach).alias("end"))

    # touching spans of a text are merged when they are applied
    spans = whole.union(small).union(large).groupBy("row").agg(F.collect_list(F.struct("unit", "start", "end")).alias("spans"))
    spans = spans.join(anchors.select("row", "k1", "k2"), "row")
    # every row of a text has the same spans, as all its anchors then share their cover
    found = materialize(spans.groupBy("k1", "k2").agg(F.first("spans").alias("spans")), "repeated-spans")
    release(anchors, live, classes, contexts)
    return found


def _merged(spans: list[dict], unit: int) -> list[tuple[int, int]]:
    """The spans of a unit, those that touch or overlap put together."""
    out: list[list[int]] = []
    for first, last in sorted((s["start"], s["end"]) for s in spans if s["unit"] == unit):
        if out and first <= out[-1][1]:
            out[-1][1] = max(last, out[-1][1])
        else:
            out.append([first, last])
    return [tuple(x) for x in out]


def _without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for first, last in spans:
        kept.append(data[at:first])
        at = last
    return b"".join([*kept, data[at:]])


_FIGURES = ["n_bytes", "n_removed", "n_spans", "n_passages", "n_passage_words"]


def _cutter(as_text: bool):
    """A function of compressed texts and their spans.

    It gives the figures, and the text without its repeated strings, as bytes, or without its repeated passages, as text.
    """
    kind = (T.StringType(), pa.string()) if as_text else (T.BinaryType(), pa.binary())
    fields = [T.StructField(n, T.LongType()) for n in _FIGURES]

    @F.arrow_udf(T.StructType([*fields, T.StructField("kept", kind[0])]))
    def without_spans(blobs: pa.Array, spans: pa.Array) -> pa.Array:
        grow, out = zstandard.ZstdDecompressor(), []
        for blob, own in zip(blobs.to_pylist(), spans.to_pylist()):
            data = grow.decompress(blob)
            strings, passages = _merged(own or [], BYTES), _merged(own or [], WORDS)
            if as_text and passages:
                begins, stops = word_bounds(data)
                kept = _without(data, [(int(begins[a]), int(stops[b - 1])) for a, b in passages])
            else:
                kept = data if as_text else _without(data, strings)
            row = (len(data), sum(b - a for a, b in strings), len(strings), len(passages), sum(b - a for a, b in passages))
            out.append(dict(zip(_FIGURES, row)) | {"kept": kept.decode() if as_text else kept})
        return pa.array(out, pa.struct([*[(n, pa.int64()) for n in _FIGURES], ("kept", kind[1])]))

    return without_spans


def _cut(docs: DataFrame, lengths: dict[int, int], large_bucket: int, as_text: bool) -> DataFrame:
    """The rows of ``docs`` as they are but for their texts, in ``_row``, beside the result of :func:`_cutter` in ``cut``."""
    spans = repeated_spans(docs, lengths, large_bucket)
    others = [c for c in docs.columns if c != "text"]
    keyed = docs.withColumns({"text": text_of()})
    keyed = carried(keyed, key=hash128(F.col("text")), blob=squeezed("text")).select(
        F.struct(*[F.col("_row").getField(c).alias(c) for c in others]).alias("_row"),
        F.col("key.h1").alias("k1"),
        F.col("key.h2").alias("k2"),
        "blob",
    )
    joined = keyed.join(spans.hint("merge"), ["k1", "k2"], "left")
    return joined.select("_row", _cutter(as_text)("blob", "spans").alias("cut"))


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, large_bucket: int = LARGE_BUCKET, words: int = PASSAGE_WORDS
) -> DataFrame:
    """``docs`` without ``text``, and n_bytes, n_removed, n_spans, ``kept``, n_passages and n_passage_words.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same document or another one, in the texts as they
    come in; strings do not go on from one document into the next. n_passages
    counts the maximal runs of words that repeated passages of ``words`` words
    cover, n_passage_words the words in them; with ``words`` 0 none are looked
    for. A null or empty text keeps no bytes and has no passages; texts are read
    whole; repeated rows are each other's copies. A column of ``docs`` that has
    the name of one of these gives way to it. An empty table gives an empty
    result.
    """
    cut = _cut(docs, {BYTES: length} | ({WORDS: words} if words else {}), large_bucket, as_text=False)
    others = [c for c in docs.columns if c != "text"]
    own = ["n_bytes", "n_removed", "n_spans", "kept", "n_passages", "n_passage_words"]
    return uncarried(cut, others, **{c: F.col("cut").getField(c) for c in own})


def passage_filter(docs: DataFrame, words: int = PASSAGE_WORDS, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """``docs`` with its columns, and texts without the passages that repeat; n_chars follows the text.

    A word goes if a passage of ``words`` words that covers it also starts
    anywhere else, in the same document or another one; white space between
    words does not count, and that around a passage stays. A null text becomes
    an empty one; repeated rows are each other's copies. Other columns stay as
    they are, whatever their names. An empty table gives an empty result.
    """
    cut = _cut(docs, {WORDS: words}, large_bucket, as_text=True)
    return retexted(cut, docs, F.col("cut").getField("kept"))
