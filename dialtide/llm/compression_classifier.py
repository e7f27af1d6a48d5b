"""Quality score by compression.

Two zstandard dictionaries are made of good and of bad labelled text. A text is
compressed with each, in blocks that each start from the dictionary alone, so
that every part of a long text counts; the difference of the sizes, per byte of
text, says which kind it resembles. A logistic fit on other labelled rows turns
difference and length, up to that of one block, into a probability.

Fitting uses bounded samples: blocks of text for the dictionaries and size
differences for the calibration. Scoring reads every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import document_columns
from .tokens import text_slices

BLOCK_CHARS = 512
BLOCKS_PER_DOCUMENT = 4
DICTIONARY_BLOCKS = 4096  #: bound of the sample per label
DICTIONARY_BYTES = 1 << 20
SAMPLE_ROWS = 10_000  #: bound of the labelled rows per label, for the dictionaries and again for the calibration
LEVEL = 9
FRAME_BYTES = 1 << 14  #: a longer text is compressed in blocks of this size
CUT = 0.7


FEATURES = ["difference", "length", "product"]


@dataclass(frozen=True)
class Model:
    """Dictionary contents and the weights of (1, difference, log length up to a block, their product)."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


class Sizer:
    """Compressed sizes of a text with either dictionary, added up over its blocks."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for content in (good, bad):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=data, level=LEVEL))

    def features(self, text: str) -> tuple[float, float, float]:
        data = text.encode()
        blocks = [data[i : i + FRAME_BYTES] for i in range(0, max(len(data), 1), FRAME_BYTES)]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        # a block more changes nothing in what the difference per byte says, so the length ends at one
        difference, length = (bad - good) / max(len(data), 1), math.log1p(min(len(data), FRAME_BYTES))
        return difference, length, difference * length


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never used: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label and half of a sample of labelled rows outside the held-out part.

    Half 0 is for the dictionaries, half 1 for the calibration; each has the
    first :data:`SAMPLE_ROWS` ids of a label in the order of their hashes.
    Conflicting labels of one id are left out.
    """
    label = F.col("quality").cast("int")
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("doc_id", "label", F.xxhash64("doc_id").alias("hash"))
        .withColumn("half", F.col("hash").bitwiseAND(F.lit(1)).cast("int"))
        .filter(~held_out(F.col("doc_id")))
    )
    marked = materialize(marked, "marked")
    parts = [
        marked.filter((F.col("label") == label) & (F.col("half") == half)).orderBy("hash", "doc_id").limit(SAMPLE_ROWS)
        for label in (0, 1)
        for half in (0, 1)
    ]
    chosen = reduce(DataFrame.union, parts).drop("hash")
    # at most four times SAMPLE_ROWS ids, whatever the number of labels
    return document_columns(docs).join(F.broadcast(chosen), "doc_id")


def dictionary(rows: DataFrame, label: int) -> bytes:
    """Blocks of the label's texts, few a document, in the order of their hashes, up to the size of a dictionary."""
    blocks = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    keyed = F.transform(blocks, lambda b, i: F.struct(F.xxhash64("doc_id", i, b).alias("key"), b.alias("block")))
    few = F.slice(F.array_sort(keyed), 1, BLOCKS_PER_DOCUMENT)
    chosen = (
        rows.filter(F.col("label") == label)
        .select(F.explode(few).alias("b"))
        .select("b.key", "b.block")
        .orderBy("key", "block")
        .limit(DICTIONARY_BLOCKS)
    )
    return "\n".join(r["block"] for r in chosen.collect()).encode()[:DICTIONARY_BYTES]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression with intercept, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _with_features(df: DataFrame, good: bytes, bad: bytes, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` and the three features of ``text``."""
    names = FEATURES

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(good, bad)
        for batch in text_slices(batches):
            rows = [sizer.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *[pa.array(c, pa.float64()) for c in zip(*rows)]],
                names=[*columns, *names],
            )

    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"{c} {types[c]}" for c in columns], *[f"{n} double" for n in names]])
    return df.select(*columns, "text").mapInArrow(measure, schema)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from labelled rows; None unless both labels occur.

    One half of the rows by hash of the id gives the dictionaries, the other the
    calibration, so no text is measured with a dictionary that holds it.
    """
    rows = materialize(training_rows(docs, labels), "labelled")
    good, bad = (dictionary(rows.filter("half = 0"), k) for k in (1, 0))
    if not good or not bad:
        return None
    # rows with an id that repeats come along; the features of one row a sampled id are taken
    measured = (
        _with_features(rows.filter("half = 1"), good, bad, ["doc_id", "label"])
        .groupBy("doc_id")
        .agg(F.min(F.struct("label", "difference", "length", "product")).alias("f"))
        .select("f.*")
        .orderBy(*FEATURES)
        .collect()
    )
    data = np.array([tuple(r) for r in measured], float).reshape(-1, 4)
    if len(set(data[:, 0])) < 2:
        return None
    return Model(good, bad, tuple(float(w) for w in logistic(data[:, 1:], data[:, 0])))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    texts = document_columns(docs)
    if model is None:
        probability, scored = F.lit(0.5), texts.select("doc_id")
    else:
        one, difference, length, product = model.weights
        scored = _with_features(texts, model.good, model.bad, ["doc_id"])
        z = F.lit(one) + difference * F.col("difference") + length * F.col("length") + product * F.col("product")
        probability = 1 / (1 + F.exp(-z))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), probability.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )


def compression_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document for quality, from 0 to 1, and the label at :data:`CUT`.

    Learns from ``labels.quality`` of rows outside the held-out part only;
    labels, language, source and id do not enter a score. Null and empty texts
    are scored as empty ones, repeated rows alike. Without labels of both kinds
    every score is 0.5. An empty table gives an empty result; other columns are
    not read.

    Returns doc_id, held_out, score, predicted.
    """
    return score(docs, fit(docs, labels))
