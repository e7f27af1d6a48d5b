"""Packing of documents into sequences, by column generation for the cutting-stock problem.

Whole sequences are cut from long documents first. The remainders are counted
by length; a linear program over patterns (how many pieces of each length class
fill one sequence) is solved with the classic column generation: its dual
prices go into a knapsack, solved by dynamic programming, whose best pattern
enters the program. The solution is rounded down, each pattern is laid out so
many times, and documents ranked inside their length class take its places.

Classes are a few tokens wide and rounding leaves some documents over, so the
sequences still have gaps. The documents left over are cut at the ends of the
gaps and fill them exactly; what is left then fills sequences of its own, the
last ones with a power of two tokens. No sequence needs padding.

The program's size depends on the sequence length alone, not on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ROW_BITS, running_total
from .tokens import default_path, encoded_documents, encoder, wide

SEQUENCE_TOKENS = 4096
CLASS_TOKENS = 16
MAX_COLUMNS = 5000  #: pivots after which the program stops; its solution is valid at any time
GAP = 1e-4  #: relative distance from the bound at which it stops

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: counts of items with the greatest total value within ``capacity``."""
    use = np.flatnonzero(values > 1e-12)
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    if len(use):
        v, s = values[use], sizes[use]
        for c in range(1, capacity + 1):
            best[c] = best[c - 1]
            fits = s <= c
            if fits.any():
                total = np.where(fits, v + best[np.maximum(c - s, 0)], -1.0)
                k = int(total.argmax())
                if total[k] > best[c] + 1e-12:
                    best[c], choice[c] = total[k], use[k]
    counts, c = np.zeros(len(values)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, from the linear program that covers ``demand``."""
    m = len(sizes)
    if not m:
        return []
    columns = [np.eye(m)[i] * (capacity // sizes[i]) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for _ in range(MAX_COLUMNS):
        prices = cost @ inverse
        value, pattern = best_pattern(prices, sizes, capacity)
        entering_cost = 1.0
        if (low := int(prices.argmin())) >= 0 and prices[low] < -1e-9:
            pattern, entering_cost = -np.eye(m)[low], 0.0  # produce more of this class than needed
        elif value <= 1 + 1e-9 or cost @ x <= (1 + GAP) * (prices @ demand) / value:
            break
        direction = inverse @ pattern
        ratios = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        pivot_row = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot_row)
        inverse[out] = pivot_row
        x = np.maximum(x - ratios[out] * direction, 0)
        x[out] = ratios[out]
        columns[out], cost[out] = pattern, entering_cost
    return [(c.astype(int), float(v)) for c, k, v in zip(columns, cost, x) if k > 0 and v >= 1]


def plan(
    histogram: dict[int, int], sequence_tokens: int, class_tokens: int
) -> tuple[int, list[tuple[int, int, int, int, int]]]:
    """Number of sequences, and per (class, pattern) the ranks that go there: (class, from, to, per sequence, first sequence).

    ``histogram`` counts remainders by length. Not more sequences are planned
    than the remainders can fill.
    """
    demand: dict[int, int] = {}
    for length, n in histogram.items():
        k = -(-length // class_tokens)
        demand[k] = demand.get(k, 0) + n
    sizes = np.array(sorted(demand))
    wanted = np.array([demand[s] for s in sizes], float)
    patterns = [(p, int(v + 1e-6)) for p, v in solve_patterns(sizes, wanted, sequence_tokens // class_tokens)]
    most, total = sum(k * n for k, n in histogram.items()) // sequence_tokens, sum(v for _, v in patterns)
    if total > most:
        patterns = [(p, v * most // total) for p, v in patterns]
    places, taken, first = [], dict.fromkeys(demand, 0), 0
    for pattern, times in patterns:
        for size, each in zip(sizes, pattern):
            if each > 0 and times > 0:
                low = taken[int(size)]
                taken[int(size)] = low + int(each) * times
                places.append((int(size), low, low + int(each) * times, int(each), first))
        first += times
    return first, places


def _ranked(rest: DataFrame) -> DataFrame:
    """Ranks remainders inside their class; classes are split by source partition, so none is one task's work."""
    split = rest.withColumn("part", F.shiftright("row", ROW_BITS))
    counts = split.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("class", "part").orderBy("row")
    return (
        split.withColumn("place", F.row_number().over(inside) - 1)
        .join(bases, ["class", "part"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("part", "place", "base")
    )


def _fill(pool: DataFrame, gaps: DataFrame, width: int, total: int) -> DataFrame:
    """Lays pooled remainders end to end over the gaps: row, length, sequence_id, offset, skip (in the remainder).

    Both are intervals on one axis of tokens. They are cut at multiples of
    ``width``, and in each such bin the starts of both kinds are walked in
    order, so no pairs are formed. ``gaps``: sequence_id, offset, size, at.
    """
    from_pool = pool.select(
        F.lit(0).alias("kind"), F.col("row").alias("id"), F.lit(0).cast("long").alias("offset"), "at",
        (F.col("at") + F.col("rest")).alias("end"),
    )
    from_gaps = gaps.select(F.lit(1), F.col("sequence_id"), F.col("offset"), "at", (F.col("at") + F.col("size")))
    events = from_pool.union(from_gaps).filter(f"at < end AND at < {total}")
    bins = F.sequence(F.expr(f"at div {width}"), F.expr(f"(least(end, {total}) - 1) div {width}"))
    events = events.withColumn("bin", F.explode(bins)).withColumns(
        {"pos": F.greatest(F.col("at"), F.col("bin") * width), "it": F.struct("id", "offset", "at")}
    )
    walk = Window.partitionBy("bin").orderBy("pos", "kind", "id")
    after = F.least((F.col("bin") + 1) * width, F.lit(total))
    cells = events.select(
        "pos",
        F.last(F.when(F.col("kind") == 0, F.col("it")), ignorenulls=True).over(walk).alias("doc"),
        F.last(F.when(F.col("kind") == 1, F.col("it")), ignorenulls=True).over(walk).alias("gap"),
        F.coalesce(F.lead("pos").over(walk), after).alias("next"),
    ).filter("next > pos")
    return cells.groupBy(F.col("doc.id").alias("row"), F.col("gap.id").alias("sequence_id")).agg(
        F.sum(F.col("next") - F.col("pos")).alias("length"),
        F.min(F.col("gap.offset") + F.col("pos") - F.col("gap.at")).alias("offset"),
        F.min(F.col("pos") - F.col("doc.at")).alias("skip"),
    )


def layout(lengths: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, class_tokens: int = CLASS_TOKENS) -> DataFrame:
    """Pieces of documents given as (row, n_tokens): row, start, length, sequence_id, offset."""
    spark, size = lengths.sparkSession, sequence_tokens
    bucket = F.shiftright("row", ROW_BITS)
    rest = lengths.select(
        "row",
        F.expr(f"n_tokens div {size} * {size}").alias("head"),
        F.expr(f"n_tokens % {size}").alias("rest"),
        F.expr(f"CAST((n_tokens % {size} + {class_tokens - 1}) div {class_tokens} AS INT)").alias("class"),
    )
    rest = rest.filter("rest > 0")
    # one row per length of a remainder: fewer than a sequence has tokens
    histogram = {r["rest"]: r["n"] for r in rest.groupBy("rest").agg(F.count("*").alias("n")).collect()}
    planned, places = plan(histogram, size, class_tokens)
    # one row per pattern and class in it
    table = spark.createDataFrame(places, "class int, low long, high long, each long, first long")
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ranked = _ranked(rest).alias("r").join(
        F.broadcast(table.alias("t")), (F.col("r.class") == F.col("t.class")) & inside, "left"
    )
    ranked = materialize(
        ranked.select(
            "row", "head", "rest", F.expr("first + (rank - low) div each").alias("sequence_id")
        ),
        "ranked-remainders",
    )
    before = Window.partitionBy("sequence_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.filter("sequence_id IS NOT NULL").select(
        "row", F.col("head").alias("start"), F.col("rest").alias("length"), "sequence_id",
        F.coalesce(F.sum("rest").over(before), F.lit(0)).alias("offset"),
    )

    # the gaps of the planned sequences, then new sequences, the last ones powers of two
    used = ranked.filter("sequence_id IS NOT NULL").groupBy("sequence_id").agg(F.sum("rest").alias("offset"))
    gaps = (
        spark.range(planned)
        .select(F.col("id").alias("sequence_id"))
        .join(used, "sequence_id", "left")
        .select("sequence_id", F.coalesce("offset", F.lit(0)).alias("offset"))
        .withColumn("size", size - F.col("offset"))
    )
    gaps = running_total(gaps, F.col("size"), F.expr("sequence_id div 4096"), F.col("sequence_id"), "at")
    pool = running_total(
        ranked.filter("sequence_id IS NULL").select("row", "head", "rest"), F.col("rest"), bucket, F.col("row"), "at"
    )
    pool = materialize(pool, "pooled-remainders")
    tokens = sum(k * n for k, n in histogram.items())
    pooled = pool.agg(F.sum("rest")).first()[0] or 0
    open_tokens = planned * size - (tokens - pooled)
    left = pooled - open_tokens
    whole, last = divmod(left, size)
    columns = ["sequence_id", "offset", "size", "at"]
    new = spark.range(whole).select(
        (F.col("id") + planned).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(size).cast("long").alias("size"),
        (F.col("id") * size + open_tokens).alias("at"),
    )
    ends, at = [], open_tokens + whole * size
    for bit in reversed(range(size.bit_length())):
        if last & (1 << bit):
            ends.append((planned + whole + len(ends), 0, 1 << bit, at))
            at += 1 << bit
    new = new.union(spark.createDataFrame(ends, "sequence_id long, offset long, size long, at long"))
    filled = (
        _fill(pool, gaps.select(*columns).union(new.select(*columns)), size, pooled)
        .join(pool.select("row", "head"), "row")
        .select("row", (F.col("head") + F.col("skip")).alias("start"), "length", "sequence_id", "offset")
    )

    # whole sequences out of long documents
    cut = lengths.filter(F.col("n_tokens") >= size).withColumn("n", F.expr(f"n_tokens div {size}"))
    cut = running_total(cut.select("row", "n"), F.col("n"), bucket, F.col("row"), "first")
    heads = cut.select("row", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k")).select(
        "row", (F.col("k") * size).alias("start"), F.lit(size).cast("long").alias("length"),
        (F.col("first") + F.col("k") + planned + whole + len(ends)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return placed.union(filled).union(heads)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 2,
    sequence_tokens: int = SEQUENCE_TOKENS,
    class_tokens: int = CLASS_TOKENS,
) -> DataFrame:
    """Every document in pieces, each with its ids and its place in a sequence.

    A document's ids are those of its text and ``end_id``; a null or empty text
    has the end id only. Each id is in one piece. Sequences are full, but for a
    few at the end whose length is a power of two. Repeated rows and rows
    without an id are documents like any other; an empty table gives an empty
    result. Other columns are not read.

    Returns doc_id, start, length, ids (32-bit, little-endian), doc_tokens,
    sequence_id, offset.
    """
    if sequence_tokens & (sequence_tokens - 1) or sequence_tokens % class_tokens:
        raise ValueError("the sequence length must be a power of two and a multiple of the class width")
    path = tokenizer or default_path("word_bpe_49k.json")
    encoded = encoded_documents(docs, path, end_id).withColumn("row", F.monotonically_increasing_id())
    encoded = materialize(encoded, "encoded")
    pieces = layout(encoded.select("row", "n_tokens"), sequence_tokens, class_tokens)
    spans = pieces.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("spans")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(path).dtype
        width = np.dtype(dtype).itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                out: list[tuple] = []
                for row in batch.slice(at, 512).to_pylist():
                    for s in row["spans"]:
                        ids = row["ids"][s["start"] * width : (s["start"] + s["length"]) * width]
                        out.append(
                            (row["doc_id"], s["start"], s["length"], wide(ids, dtype).tobytes(), row["n_tokens"],
                             s["sequence_id"], s["offset"])
                        )
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                types = [pa.binary() if n == "ids" else pa.int64() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return encoded.join(spans.hint("merge"), "row").select("doc_id", "n_tokens", "ids", "spans").mapInArrow(cut, PIECE)
