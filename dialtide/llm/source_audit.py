"""How the sources of a language differ in their words: chunk factorization.

Documents are dealt out by language and source and cut at white space into
chunks, and chunks are counted as they are: once a document for the number of
documents, and each time for the number of occurrences. Only the globally
distinct chunks are tokenized, each once; their terms are joined back to the
counts. So the work on terms follows the vocabulary and not the corpus. A chunk
that is one term as it stands needs neither step.

How many documents hold a term cannot be added up from its chunks, as one
document may hold several of them. But only a few documents are asked for. The
sum over the chunks bounds them from above. From below a source has as many as
its commonest chunk, or as a bit map of the first and last rows of its chunks tells
apart, and documents of different sources differ. Terms that these bounds leave open are
counted exactly, by the documents of their chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, small_batches, text_of

#: A term is a run of ASCII letters and characters beyond ASCII; white space never is in one.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A chunk that is one term as it stands.
PLAIN = r"^[^\x00-\x60\x7B-\x7F]+$"
MIN_DOCUMENTS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Cells of terms, and sources, that one task compares at a time.
BLOCK_CELLS, BLOCK_SOURCES = 1 << 16, 256
#: Chunks of open terms that are sent to all tasks; more are joined by a shuffle.
FEW_CHUNKS = 1 << 16

_GROUP = ["lang", "source"]
_COUNTS = "lang string, source string, chunk string, n long, documents long, low long, high long"


def _chunk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of a batch of documents by language and source, with the first and the last row that hold them."""
    for batch in batches:
        split = pc.ascii_split_whitespace(batch.column("text"))  # empty chunks at the ends are left out below
        chunks = split.flatten().dictionary_encode()
        names = [batch.column(c).dictionary_encode() for c in _GROUP]
        lang, source = [x.indices.to_numpy().astype(np.int64) for x in names]
        groups, group = np.unique(lang * len(names[1].dictionary) + source, return_inverse=True)
        rows, at = np.unique(batch.column("row").to_numpy(), return_inverse=True)
        # one whole number for each (language, source, chunk, document), sorted
        codes = chunks.indices.to_numpy().astype(np.int64)
        base = group * len(chunks.dictionary) * len(rows) + at
        keys = np.repeat(base, pc.list_value_length(split).to_numpy()) + codes * len(rows)
        keys = np.sort(keys[codes != chunks.dictionary.index("").as_py()])
        if not len(keys):
            continue
        first = np.flatnonzero(np.diff(keys, prepend=-1))  # of each chunk in each document
        cell, row = np.divmod(keys[first], len(rows))
        start = np.flatnonzero(np.diff(cell, prepend=-1))  # of each chunk in each group
        end = np.append(start[1:], len(cell))
        group, chunk = np.divmod(cell[start], len(chunks.dictionary))
        texts = [x.dictionary.take(pa.array(i)) for x, i in zip([*names, chunks], [*np.divmod(groups[group], len(names[1].dictionary)), chunk])]
        figures = [np.diff(first[start], append=len(keys)), end - start, rows[row[start]], rows[row[end - 1]]]
        columns = [*texts, *map(pa.array, figures)]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _COUNTS.split(", ")])


def by_group(docs: DataFrame) -> DataFrame:
    """``docs`` with the documents of a language and source together, by ranges of the row, so that a large group fills several tasks.

    A task then counts the chunks of few groups, and shuffles each of them about once.
    """
    return docs.repartitionByRange(*_GROUP, "row")


def chunk_counts(docs: DataFrame) -> DataFrame:
    """lang, source, chunk, its occurrences n, its documents, the first and last row that hold it, and whether it is a term as it stands."""
    counts = small_batches(by_group(docs)).mapInArrow(_chunk_counts, _COUNTS).groupBy(*_GROUP, "chunk")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"), F.min("low").alias("low"), F.max("high").alias("high"))
    return materialize(counts.withColumn("plain", F.col("chunk").rlike(PLAIN)), "chunk-counts")


def chunk_terms(counts: DataFrame) -> DataFrame:
    """chunk, term and times, the term's occurrences in it: each distinct chunk is tokenized once."""
    terms = F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))
    each = counts.select("chunk").distinct().select("chunk", F.explode(F.transform(terms, ascii_lower)).alias("term"))
    return materialize(each.groupBy("chunk", "term").agg(F.count("*").alias("times")), "chunk-terms")


def _open_documents(docs: DataFrame, counts: DataFrame, terms: DataFrame, unsettled: DataFrame, least: int) -> DataFrame:
    """lang, term and row of the documents that hold the unsettled terms (lang, term); chunks in ``least`` documents do not occur here."""
    chunks = terms.join(unsettled, "term").select("lang", "chunk", "term")
    chunks = materialize(chunks.union(unsettled.select("lang", F.col("term").alias("chunk"), "term")).distinct(), "open-chunks")
    if chunks.count() <= FEW_CHUNKS:  # usually; any number goes the other way
        chunks = F.broadcast(chunks)
    if least <= 3:  # a chunk in under three documents is in its first and last
        return counts.join(chunks, ["lang", "chunk"]).select("lang", "term", F.explode(F.array("low", "high")).alias("row"))
    split = F.explode(F.array_distinct(F.split("text", r"[\x20\x09-\x0D]+"))).alias("chunk")
    return docs.select("lang", "row", split).join(chunks, ["lang", "chunk"]).select("lang", "term", "row")


def term_cells(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Of (row, lang, source, text): the kept terms of each language, and their counts by (lang, source, term), also over all sources."""
    counts = chunk_counts(docs)
    as_it_is = F.col("plain")
    figures = ["n", "documents", "low", "high"]
    terms = chunk_terms(counts.filter(~as_it_is))
    plain = counts.filter(as_it_is).select(*_GROUP, F.col("chunk").alias("term"), *figures)
    joined = counts.filter(~as_it_is).join(terms, "chunk")
    joined = joined.select(*_GROUP, "term", (F.col("n") * F.col("times")).alias("n"), *figures[1:])
    # rows told apart: those that fall on different bits
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
    cells = plain.union(joined).groupBy(*_GROUP, "term").agg(
        F.sum("n").alias("n"),
        F.greatest(F.max("documents"), F.bit_count(F.bit_or(bit("low").bitwiseOR(bit("high")))).cast("long")).alias("least"),
        F.sum("documents").alias("most"),
    )
    cells = materialize(cells, "term-cells")
    by_term = cells.groupBy("lang", "term").agg(*[F.sum(c).alias(c) for c in ("n", "least", "most")])
    by_term = materialize(by_term.filter(F.col("most") >= min_documents), "term-documents")
    kept = by_term.filter(F.col("least") >= min_documents).select("lang", "term", "n")
    unsettled = by_term.filter(F.col("least") < min_documents)
    if not unsettled.isEmpty():
        rows = _open_documents(docs, counts, terms, unsettled.select("lang", "term"), min_documents)
        counted = rows.distinct().groupBy("lang", "term").agg(F.count("*").alias("c")).filter(F.col("c") >= min_documents)
        kept = kept.union(unsettled.join(counted, ["lang", "term"]).select("lang", "term", "n"))
    kept = materialize(kept.withColumnRenamed("n", "whole"), "kept-terms")
    return kept, materialize(cells.select(*_GROUP, "term", "n").join(kept, ["lang", "term"]), "kept-cells")


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count, in units of 1 / :data:`UNIT`, as a whole number: 1 + floor(UNIT (n + 1) / (total + terms))."""
    plain = F.call_function("div", (n + 1) * UNIT, total + terms)
    exact = F.call_function("div", (n + 1).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + terms).cast("decimal(19,0)"))
    return 1 + F.when(n < (1 << 62) // UNIT, plain).otherwise(exact)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compared(cells: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Of a block of terms of one language: the divergence of each source of a block from every source, summed over the terms."""
    if not len(cells):  # no term of the block is left
        return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})
    base = sources.sort_values("place")
    places, floor = base["place"].to_numpy(), base["none"].to_numpy()
    rows = np.flatnonzero(base["own"].to_numpy())
    codes, terms = pd.factorize(cells["term"])
    order = np.argsort(codes, kind="stable")
    codes, at, p = codes[order], np.searchsorted(places, cells["place"].to_numpy()[order]), cells["p"].to_numpy()[order]
    total = np.zeros((len(rows), len(places)), np.int64)
    width = max(1, BLOCK_CELLS // len(places))
    for first in range(0, len(terms), width):
        lo, hi = np.searchsorted(codes, [first, first + width])
        table = np.tile(floor, (min(width, len(terms) - first), 1))
        table[codes[lo:hi] - first, at[lo:hi]] = p[lo:hi]
        for i, row in enumerate(rows.tolist()):
            total[i] += _divergence(table[:, [row]], table).sum(axis=0)
    a, b = np.meshgrid(places[rows], places, indexing="ij")
    out = pd.DataFrame({"lang": cells["lang"].iloc[0], "a": a.ravel(), "b": b.ravel(), "value": total.ravel()})
    return out[out["a"] != out["b"]]


def pair_values(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """lang, a, b and value: the divergence of every source (a place in its language) from every other one.

    Terms are dealt out in blocks. A block is compared by the array and only its
    sums, one for each pair of sources, are shuffled: no pair of rows is.
    """
    sizes = groups.groupBy("lang").agg(F.max("place").alias("places"), F.max("terms").alias("terms"))
    blocks = F.ceil(F.col("terms") * F.col("places") / (4 * BLOCK_CELLS)).cast("int")
    sizes = sizes.select("lang", blocks.alias("blocks"), F.floor((F.col("places") - 1) / BLOCK_SOURCES).cast("int").alias("parts"))
    part = F.explode(F.sequence(F.lit(0), "parts")).alias("part")
    dealt = cells.join(groups.select(*_GROUP, "place", "total", "terms"), _GROUP).join(sizes, "lang")
    dealt = dealt.select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), part, "term", F.col("place").alias("place"),
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
    )
    every = groups.join(sizes, "lang").filter("blocks > 0").select("lang", "place", "none", "blocks", part)
    every = every.select(
        "lang", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "part", F.col("place").alias("place"), "none",
        (F.floor((F.col("place") - 1) / BLOCK_SOURCES) == F.col("part")).alias("own"),
    )
    keys = ["lang", "block", "part"]
    sums = dealt.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInPandas(_compared, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """How far each (lang, source) is from the other sources of its language, and by which terms from the language.

    A term is kept in a language if at least ``min_documents`` of its documents
    hold it; every row is a document. Every source, and the language, gives each
    kept term its smoothed :func:`share` p. A difference is floor((p - q)^2 / q).
    Part ``pair`` has a row for each other source of the language, its value
    summed over all kept terms (0 without any). Part ``term`` has the source's
    terms above the language's share, ``top_terms`` of them. Ranks are by value
    from the top, equal ones by the bytes of the item.

    Nulls in text, lang and source count as the empty string. A source without
    terms has shares like any other. Texts are read whole. An empty table gives
    an empty result; other columns are not read.

    Returns lang, source, part, item, value, rank.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(empty("lang"), empty("source"), text_of().alias("text")).withColumn("row", F.monotonically_increasing_id())
    kept, cells = term_cells(rows, min_documents)
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = cells.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    groups = rows.select(*_GROUP).distinct().join(totals, _GROUP, "left").join(vocabulary, "lang", "left")
    groups = groups.select(
        *_GROUP, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms")],
        F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("place"),
    )
    none = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms")))
    groups = materialize(groups.withColumn("none", none), "audit-groups")

    sums = materialize(pair_values(groups, cells), "audit-pairs")
    one, other = groups.select("lang", "source", F.col("place").alias("a")), groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    pairs = one.join(other, "lang").filter("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select(*_GROUP, F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    terms = cells.join(groups.select(*_GROUP, "total", "terms"), _GROUP).join(of_lang, "lang")
    terms = terms.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    terms = terms.withColumn("q", share(F.col("whole"), F.col("lang_total"), F.col("terms"))).filter("p > q")
    terms = terms.select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy(*_GROUP, "part").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).union(ranked(terms).filter(F.col("rank") <= top_terms))
