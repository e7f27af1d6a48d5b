"""Importance resampling of documents towards a target, by hashed bags of words.

Features are runs of consecutive words; a feature's bucket is the CRC-32 of its
bytes. The vocabulary has a head and a tail. For the commonest words of the
corpus every task holds the state of the CRC after the word, for the commonest
pairs of them the bucket: one look-up a feature. All other features, the tail,
go through the CRC itself. Both give the same bucket, so the head only saves
time: what is in it never shows in a result.

1. Words (and pairs) are counted over the whole corpus, and the head is cut at
   the count that leaves at most :data:`HEAD` of them.
2. Head and tail features of all documents, and of the target, add up to exact
   totals of the buckets: one row a bucket and task is shuffled.
3. The gains of the buckets, a table of fixed size, weigh every document, and a
   seeded Gumbel number per document makes the draw one without replacement.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import numbered, small_batches, text_of

BUCKETS = 10_000
#: Words, and pairs of words, that the head holds at most.
HEAD = 1 << 16
MAX_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Scores are compared in steps of this size first, so that only about the drawn rows are sorted.
SCORE_STEP = 64

#: The words' letters in UTF-8, once A-Z is in lower case: digits, a-z and all beyond ASCII.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
_Head = tuple[dict[bytes, int], dict[tuple[bytes, bytes], int]]


def words_of(text: str) -> list[bytes]:
    return _WORDS(text.encode().lower())


def feature_buckets(words: list[bytes], max_run: int, head: _Head, buckets: int = BUCKETS) -> list[int]:
    """The bucket of every run of 1 to ``max_run`` words."""
    states, pairs = head
    crc, known = zlib.crc32, states.get
    ends = [s if (s := known(w)) is not None else crc(w) for w in words]
    out = [s % buckets for s in ends]
    for run in range(2, max_run + 1):
        last = words[run - 1 :]
        if run == 2:
            grown = [b if (b := pairs.get(p)) is not None else crc(b" " + p[1], s) for p, s in zip(zip(words, last), ends)]
        else:
            grown = [crc(b" " + w, s) for w, s in zip(last, ends)]
        ends = grown
        out += [s % buckets for s in ends]
    return out


def _counted(features) -> object:
    """Emits the features of a batch of texts with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = Counter()
            for text in batch.column("text").to_pylist():
                total.update(features(text))
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k if isinstance(k, bytes) else b" ".join(k) for k in keys], pa.binary()), pa.array([total[k] for k in keys], pa.int64())],
                names=["feature", "n"],
            )

    return run


def _commonest(texts: DataFrame, features, limit: int) -> list[bytes]:
    """At most ``limit`` of the features, those with the highest counts; of equal counts all or none."""
    counts = texts.mapInArrow(_counted(features), "feature binary, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = materialize(counts.filter("n > 1"), "feature-counts")
    # one row for each 64th of a doubling of the count: few, whatever the corpus
    step = F.floor(F.log2("n") * 64).alias("step")
    steps = counts.groupBy(step).agg(F.count("*").alias("c"))
    above = Window.orderBy(F.desc("step"))
    cut = steps.withColumn("upto", F.sum("c").over(above)).filter(F.col("upto") <= limit).agg(F.min("step")).first()[0]
    if cut is None:
        return []
    return counts.filter(F.floor(F.log2("n") * 64) >= cut).select("feature").toArrow().column("feature").to_pylist()


def frequent_head(texts: DataFrame, max_run: int = MAX_RUN, limit: int = HEAD) -> _Head:
    """The CRC states of the commonest words and, for longer runs, of the commonest pairs of these words."""
    states = {w: zlib.crc32(w) for w in _commonest(texts, words_of, limit)}
    pairs: dict[tuple[bytes, bytes], int] = {}
    if max_run > 1 and states:

        def both_known(text: str) -> Iterator[tuple[bytes, bytes]]:
            words = words_of(text)
            return (p for p in zip(words, words[1:]) if p[0] in states and p[1] in states)

        for pair in _commonest(texts, both_known, limit):
            pairs[tuple(pair.split(b" "))] = zlib.crc32(pair)
    return states, pairs


def bucket_totals(texts: DataFrame, max_run: int, head: _Head, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n, the features in it over all ``texts``; empty buckets are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += np.bincount(feature_buckets(words_of(text), max_run, head, buckets), minlength=buckets) if text else 0
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, max_run: int, head: _Head, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: 1000 times the logarithm of its smoothed share in the target over that in the corpus."""
    spark = corpus.sparkSession
    s, t = (bucket_totals(x, max_run, head, buckets).withColumnRenamed("n", n) for x, n in ((corpus, "s"), (target, "t")))
    rows = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left")
    rows = rows.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    found = rows.orderBy("bucket").toArrow()
    # whole numbers, so that the totals are exact; the ratio is of doubles, as stated
    own, aim = (found.column(c).to_numpy() for c in ("s", "t"))
    ratio = (aim + 1) * (own.sum() + buckets) / ((own + 1) * (aim.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighted(max_run: int, head: _Head, gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights = [], [], []
            for text in batch.column("text").to_pylist():
                own = words_of(text)
                found = feature_buckets(own, max_run, head, len(gains))
                words.append(len(own))
                features.append(len(found))
                weights.append(int(gains[found].sum()) // len(found) if found else 0)
            arrays = [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (words, features, weights)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight"])

    return run


def gumbel(doc_id: Column, seed: int) -> Column:
    """A number per document and seed, floored, in thousandths: the draw is one without replacement by weight."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    max_run: int = MAX_RUN,
    seed: int = SEED,
    head: int = HEAD,
) -> DataFrame:
    """Each document's weight and score towards the texts of ``target``, and its rank if it is drawn.

    Of the documents with at least ``min_words`` words ``percent`` percent, those
    with the highest scores, are drawn; ties go to the smaller doc_id, rows
    without an id last. A null or empty text has no features and weight 0; texts
    of any length are read whole. Repeated rows are documents of their own, with
    the same score and ranks next to each other; a null id takes the number of
    the empty id. An empty corpus gives an empty result, an empty target a flat
    one. Other columns are not read.

    Returns doc_id, n_words, n_features, weight, score, rank.
    """
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    words = texts.select("text")
    top = frequent_head(words, max_run, head)
    gains = bucket_gains(words, target.select(text_of().alias("text")), max_run, top)
    scored = texts.mapInArrow(_weighted(max_run, top, gains), "doc_id long, n_words long, n_features long, weight long")
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance-scores")

    step = F.floor(F.col("score") / SCORE_STEP)
    # one row for each step of the score: the range of the scores bounds them, not the documents
    steps = scored.filter(F.col("n_words") >= min_words).groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    steps = sorted(((r["step"], r["n"]) for r in steps), reverse=True)
    wanted, reached, cut = percent * sum(n for _, n in steps) // 100, 0, None
    for value, n in steps:
        if reached >= wanted:
            break
        reached, cut = reached + n, value
    near = (F.col("n_words") >= min_words) & (step >= (cut if cut is not None else 1 << 62))
    drawn = numbered(scored.filter(near), F.desc("score"), F.asc_nulls_last("doc_id"))
    place = F.when(F.col("position") < wanted, F.col("position") + 1).cast("long").alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return drawn.select(*columns, place).union(scored.filter(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
