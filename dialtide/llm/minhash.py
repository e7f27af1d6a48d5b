"""Near-duplicate detection: ProbMinHash signatures, banding, exact verification.

One similarity, the probability Jaccard of weighted shingles, makes the pairs and
verifies them: signatures estimate it, shingles decide. In production every
distinct shingle weighs the same, and it is the Jaccard similarity of the sets;
with ``repeats`` a shingle weighs 1 + ln(count).

Texts with the same words are one node. Nodes with a band in common are in a
bucket. Buckets are worked off in two steps:

1. Every member is compared with the smallest node of its bucket. In a group of
   near copies this joins nearly all of it, with one comparison a member.
2. Where a bucket still holds several classes, the members outside its largest
   class are compared with all others of another class, in blocks of a bucket:
   first signatures, by the array, then the shingles of members that have a
   likely partner. A block keeps track of the classes it joins and hands on only
   the links that join some, so no more links than members are written. A pair
   is looked at in the first band it has in common, and never inside a class.

No bucket is capped. A pair at the limit has no band in common with probability
0.003, far less above it; an estimate that is off by :data:`MARGIN_PERCENT` is
four deviations away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import carried, content_key, document_columns, text_of, uncarried
from .components import connected_components
from .shingles import mix, prob_minhash, probability_jaccard, shingled, slices

SIMILARITY_PERCENT = 80
BANDS, ROWS = 32, 8
COMPONENTS = BANDS * ROWS
#: Pairs whose signatures estimate a similarity so far below the limit are not verified.
MARGIN_PERCENT = 10
#: Members of a bucket that are compared at a time.
BLOCK = 512

_SIGNED = "row_key struct<h1:long,h2:long>, doc_id long, fp binary, n int, sig binary"
_SETS = "node long, fp binary, found binary, hashes binary, weights binary"
_PAIRS = "a long, b long"


def _weights(counts: np.ndarray, repeats: bool) -> np.ndarray:
    return 1 + np.log(counts) if repeats else np.ones(len(counts))


def _signed(repeats: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for column in slices(batch.column("text")):
                part = batch.slice(at, len(column))
                at += len(column)
                fingerprints, owner, hashes, counts = shingled(column)
                texts = len(column)
                signature = prob_minhash(owner, hashes, _weights(counts, repeats), texts, COMPONENTS)
                # a byte a component: different ones are equal with probability 1 / 256
                small = (mix(signature) >> np.uint64(56)).astype(np.uint8)
                sizes = np.bincount(owner, minlength=texts)
                columns = [
                    part.column("row_key"),
                    part.column("doc_id"),
                    pa.array(fingerprints, pa.binary()),
                    pa.array(sizes.astype(np.int32)),
                    pa.array([s.tobytes() for s in small], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row_key", "doc_id", "fp", "n", "sig"])

    return run


def signatures(docs: DataFrame, repeats: bool = False) -> DataFrame:
    """Per document: row, row_key, doc_id, fp (of its words), n distinct shingles and the signature, a byte a component."""
    texts = document_columns(docs).select(
        content_key("doc_id", "text").alias("row_key"), "doc_id", F.lower("text").alias("text")
    )
    signed = texts.mapInArrow(_signed(repeats), _SIGNED)
    return materialize(signed.withColumn("row", F.monotonically_increasing_id()), "signatures")


def _sets(repeats: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for column in slices(batch.column("text")):
                part = batch.slice(at, len(column))
                at += len(column)
                fingerprints, owner, hashes, counts = shingled(column)
                ends = np.searchsorted(owner, np.arange(len(column) + 1))
                weights = _weights(counts, repeats).astype(np.float32)
                parts = [slice(*x) for x in zip(ends[:-1], ends[1:])]
                columns = [
                    part.column("node"),
                    part.column("fp"),
                    pa.array(fingerprints, pa.binary()),
                    pa.array([hashes[p].tobytes() for p in parts], pa.binary()),
                    pa.array([weights[p].tobytes() if repeats else b"" for p in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "fp", "found", "hashes", "weights"])

    return run


def shingle_sets(docs: DataFrame, wanted: DataFrame, repeats: bool = False) -> DataFrame:
    """node, hashes and weights of the shingles of the ``wanted`` (node, row_key, fp) texts."""
    texts = document_columns(docs).select(content_key("doc_id", "text").alias("row_key"), F.lower("text").alias("text"))
    found = texts.join(wanted.hint("merge"), "row_key").select("node", "fp", "text").mapInArrow(_sets(repeats), _SETS)
    return materialize(found.filter("fp = found").dropDuplicates(["node"]).select("node", "hashes", "weights"), "shingle-sets")


def _is_similar(ha: bytes, wa: bytes, hb: bytes, wb: bytes) -> bool:
    a, b = np.frombuffer(ha, np.uint64), np.frombuffer(hb, np.uint64)
    wa, wb = (np.frombuffer(w, np.float32).astype(float) if w else np.ones(len(h)) for w, h in ((wa, a), (wb, b)))
    return probability_jaccard(a, wa, b, wb) * 100 >= SIMILARITY_PERCENT - 1e-6


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [batch.column(c).to_pylist() for c in ("ha", "wa", "hb", "wb")]
        hits = [i for i, pair in enumerate(zip(*sides)) if _is_similar(*pair)]
        yield batch.select(["a", "b"]).take(pa.array(hits, pa.int64()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingles are similar enough."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("hashes").alias(f"h{x}"), F.col("weights").alias(f"w{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_similar, _PAIRS)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many components agree, of every row of ``a`` with every row of ``b``."""
    return np.stack([(b == x).sum(axis=1) for x in a]) if len(a) else np.zeros((0, len(b)), int)


_LEAST = -(-COMPONENTS * (SIMILARITY_PERCENT - MARGIN_PERCENT) // 100)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COMPONENTS) for c in ("sa", "sb"))
        yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= _LEAST))


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures estimate a similarity near the limit or above."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").mapInArrow(_estimated, _PAIRS)


CELL = "key long, i int, j int, band int, side int, node long, label long"
_KEYS = ["key", "i", "j"]


def _likely_in_block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (few, other) of two blocks of a bucket that are of different classes and likely similar, and how many components agree."""
    side, node, label = (table.column(c).to_numpy() for c in ("side", "node", "label"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, COMPONENTS)
    few, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    agree = _near(sig[few], sig[every])
    i, j = np.nonzero(agree >= _LEAST)
    agree, i, j = agree[i, j], few[i], every[j]
    bands = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) if len(i) else np.empty(0, int)
    other = (label[i] != label[j]) & (bands == table.column("band").to_numpy()[i])
    return i[other], j[other], agree[other]


def _with_partner(table: pa.Table) -> pa.Table:
    """The members of a block that have a likely partner in it."""
    i, j, _ = _likely_in_block(table)
    return table.select([c.split()[0] for c in CELL.split(", ")]).take(pa.array(np.unique(np.concatenate([i, j]))))


def _links(table: pa.Table) -> pa.Table:
    """Links between similar members of a block, those that join classes only."""
    i, j, agree = _likely_in_block(table)
    node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
    hashes, weights = table.column("hashes").to_pylist(), table.column("weights").to_pylist()
    head: dict[int, int] = {}

    def root(x: int) -> int:
        while head.get(x, x) != x:
            x = head[x]
        return x

    found = []
    for k in np.argsort(-agree, kind="stable").tolist():
        a, b = int(i[k]), int(j[k])
        x, y = root(int(label[a])), root(int(label[b]))
        if x != y and _is_similar(hashes[a], weights[a], hashes[b], weights[b]):
            head[max(x, y)] = min(x, y)
            found.append((int(node[a]), int(node[b])))
    return pa.table({c: pa.array([f[n] for f in found], pa.int64()) for n, c in enumerate("ab")})


def mixed_blocks(members: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """The members of buckets with several classes, dealt out to pairs of blocks (key, i, j)."""
    own = members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label"))
    own = materialize(own, "labelled-members")
    sizes = own.groupBy("key", "label").agg(F.count("*").alias("c"))
    of_key = sizes.groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("all")).filter("top.c < all")
    blocks = lambda n: F.ceil(n / block).cast("int")
    of_key = of_key.select(
        "key", F.col("top.label").alias("main"), blocks(F.col("all") - F.col("top.c")).alias("few"), blocks(F.col("all")).alias("every")
    )
    cells = own.join(materialize(of_key, "mixed-buckets"), "key")
    # the few once for each block of all, and all once for each block of the few
    place = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    few = cells.filter("label <> main").select(
        "key", place(1, F.col("few")).alias("i"), F.explode(F.expr("sequence(0, every - 1)")).alias("j"), "band", F.lit(0).alias("side"), "node", "label"
    )
    every = cells.select(
        "key", F.explode(F.expr("sequence(0, few - 1)")).alias("i"), place(2, F.col("every")).alias("j"), "band", F.lit(1).alias("side"), "node", "label"
    )
    return few.union(every)


def by_blocks(dealt: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every pair of blocks; a batch is cut where one ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            marks = np.stack([table.column(k).to_numpy() for k in _KEYS])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for first, last in zip(np.append(0, cuts), cuts):
                yield from work(table.slice(first, last - first)).to_batches()
            held = table.slice(cuts[-1] if len(cuts) else 0).to_batches()
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches()

    return dealt.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(run, schema)


def between_classes(members: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join different classes of ``members`` (key, band, node), of all pairs of these that are similar."""
    dealt = mixed_blocks(members, labels, block)
    signed = nodes.select("node", "sig")
    likely_cells = materialize(by_blocks(dealt.join(signed, "node"), _with_partner, CELL), "likely-members")
    found = by_blocks(likely_cells.join(signed, "node").join(sets, "node"), _links, _PAIRS)
    return materialize(found.distinct(), "more-near-pairs")


def near_classes(docs: DataFrame, repeats: bool = False) -> DataFrame:
    """One row per document: row, row_key, doc_id, class_id, class_size, kept, see :func:`near_duplicates`."""
    signed = signatures(docs, repeats)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    same = signed.groupBy("fp").agg(F.min(order).alias("first"))
    same = materialize(same.select("fp", F.col("first.row").alias("node")), "same-words")
    nodes = signed.filter("n > 0").join(same.select(F.col("node").alias("row")), "row", "left_semi")
    nodes = materialize(nodes.select(F.col("row").alias("node"), "row_key", "fp", "sig"), "nodes")

    keys = F.array(*[F.xxhash64(F.expr(f"substring(sig, {ROWS * i + 1}, {ROWS})"), F.lit(i)) for i in range(BANDS)])
    cells = nodes.select("node", F.posexplode(keys).alias("band", "key"))
    buckets = cells.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("head")).filter("c > 1")
    buckets = materialize(buckets.select("key", "head"), "buckets")
    members = materialize(cells.join(buckets, "key"), "members")
    star = members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    star = materialize(likely(star, nodes), "star-pairs")
    wanted = members.select("node").distinct().join(nodes.select("node", "row_key", "fp"), "node")
    sets = shingle_sets(docs, wanted, repeats)
    edges = materialize(verified(star, sets), "near-pairs")
    labels = connected_components(edges)

    more = between_classes(members, labels, nodes, sets)
    if not more.isEmpty():
        labels = connected_components(edges.union(more))
    release(nodes, buckets, members, star, sets)

    named = signed.select("row", "row_key", "doc_id", "fp").join(same, "fp").join(labels, "node", "left")
    named = named.select("row", "row_key", "doc_id", F.coalesce("label", "node").alias("label"))
    named = materialize(named, "near-classes")
    release(signed, same)
    classes = named.groupBy("label").agg(F.count("*").alias("class_size"), F.min(order).alias("first"))
    joined = named.join(materialize(classes, "near-class-heads"), "label")
    return joined.select(
        "row",
        "row_key",
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def near_duplicates(docs: DataFrame, repeats: bool = False) -> DataFrame:
    """Each document with the class of near copies it is in.

    Similar are texts whose five-word shingles, in lower case, have a probability
    Jaccard similarity of :data:`SIMILARITY_PERCENT` percent or more, which is
    that of their sets, or with ``repeats`` that of shingles weighted by
    1 + ln(count); classes are the connected components. A text of one to four
    words is one shingle; texts without words, null ones included, are one class.
    Texts with the same words are always in one class. The document with the
    smallest id stays; rows without an id come after all others. Of rows repeated
    whole any one may stay. Texts are read whole. An empty table gives an empty
    result; other columns are not read, whatever their names.

    Returns doc_id, class_id (id of the document that stays), class_size, kept.
    """
    return near_classes(docs, repeats).select("doc_id", "class_id", "class_size", "kept")


def near_filter(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class of :func:`near_duplicates`, with all its columns as they were.

    Of rows repeated whole one stays; null and empty texts are one class. An empty table gives an empty result.
    """
    kept = materialize(near_classes(docs).filter("kept").select("row_key"), "kept")
    keyed = carried(docs, doc_id=F.col("doc_id").cast("long"), text=text_of())
    # rows repeated whole have one key: one of them stays
    once = keyed.select("_row", content_key("doc_id", "text").alias("row_key")).dropDuplicates(["row_key"])
    return uncarried(once.join(kept.hint("merge"), "row_key", "left_semi"), docs.columns)
