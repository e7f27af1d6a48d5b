"""Stored snapshots that are cheap to refresh: base files, delta files and a manifest.

A snapshot holds one row per key. Its first version cuts the keys into ranges of
about equally many rows, one folder each. A refresh writes only the keys it
changes, as a delta of the ranges they fall into; a range that has gathered
:data:`DELTAS` of them is written anew by itself. When the snapshot has outgrown
its ranges by :data:`GROWTH`, all of it is.

A version is what its manifest names. The manifest is one file, written last, so a
version is there whole or not at all, and readers of older versions are not
disturbed. :func:`expire_snapshots` empties what no kept version names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshot import latest_snapshot
from ..session import materialize

RANGES = 64
DELTAS = 4
GROWTH = 4
#: What a manifest lists: the parts of every range, the later the newer, and the rows there were when ranges were cut.
_MANIFEST = "range int, low string, segment string, place int, rows long, laid_out long"


@dataclass(frozen=True)
class Part:
    """The rows of one key range in one segment."""

    range: int
    low: str | None  #: the least key of the range; the first range also takes all below
    segment: str
    place: int  #: 0: the base; a later part holds newer rows
    rows: int
    laid_out: int


def _path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def _manifest_path(base: str, version: int) -> str:
    return _path(base, "manifests", f"version={version:012d}")


def snapshot_versions(spark: SparkSession, base: str) -> list[int]:
    """The finished versions below ``base``, oldest first."""
    marks = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        found = marks.load(_path(base, "manifests")).select(F.regexp_extract("path", r"/version=(\d+)/", 1).alias("v"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(int(r["v"]) for r in found.filter("v <> ''").distinct().collect())


def read_manifest(spark: SparkSession, base: str, version: int) -> list[Part]:
    """The parts of a version."""
    rows = spark.read.schema(_MANIFEST).parquet(_manifest_path(base, version)).collect()  # ranges x deltas at most
    return sorted((Part(*r) for r in rows), key=lambda p: (p.range, p.place))


def _write_manifest(spark: SparkSession, base: str, version: int, parts: list[Part]) -> None:
    rows = spark.createDataFrame([(p.range, p.low, p.segment, p.place, p.rows, p.laid_out) for p in parts], _MANIFEST)
    rows.coalesce(1).write.mode("overwrite").parquet(_manifest_path(base, version))


def _segment(rows: DataFrame, base: str, key: str) -> str:
    """Write rows that have a ``range``, sorted by key inside it; returns the segment's name.

    Bloom filters on the key let a look-up of scattered keys skip row groups whose bounds hold them.
    """
    name = uuid.uuid4().hex[:16]
    (
        rows.sortWithinPartitions("range", key)
        .write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .partitionBy("range")
        .parquet(_path(base, "segments", name))
    )
    return name


def _sizes(spark: SparkSession, base: str, name: str) -> dict[int, int]:
    """Rows of a segment by range."""
    found = spark.read.parquet(_path(base, "segments", name)).groupBy("range").agg(F.count("*").alias("n"))
    return {int(r["range"]): r["n"] for r in found.collect()}


def _lay_out(rows: DataFrame, base: str, key: str) -> list[Part]:
    """Write all rows in new ranges of the key."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(RANGES, key).withColumn("range", F.spark_partition_id())
    name = _segment(ranged, base, key)
    written = spark.read.schema(ranged.schema).parquet(_path(base, "segments", name)).groupBy("range")
    found = written.agg(F.min(key).alias("low"), F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in found)
    if not found:  # an empty snapshot still knows its columns
        rows.limit(0).write.parquet(_path(base, "segments", name, "range=0"))
        return [Part(0, None, name, 0, 0, 0)]
    return [Part(int(r["range"]), r["low"], name, 0, r["n"], total) for r in found]


def _range_of(key: str, parts: list[Part]) -> Column:
    """The range a key falls into: the last one that begins at or below it."""
    lows = sorted({(p.low, p.range) for p in parts if p.low is not None})
    first = F.lit(min((p.range for p in parts), default=0))
    if len(lows) < 2:
        return first.cast("int")
    starts, numbers = F.array(*[F.lit(low) for low, _ in lows[1:]]), F.array(*[F.lit(r) for _, r in lows])
    below = F.size(F.filter(starts, lambda s: s <= F.col(key)))
    return F.when(F.col(key).isNull(), first).otherwise(F.element_at(numbers, below + 1)).cast("int")


def _rows_of(spark: SparkSession, base: str, parts: list[Part], key: str, schema) -> DataFrame:
    """The current row of each key of the ranges in ``parts``; ranges with deltas are put together by place."""
    touched = {p.range for p in parts if p.place}

    def read(some: list[Part]) -> DataFrame:
        return spark.read.schema(schema).parquet(*[_path(base, "segments", p.segment, f"range={p.range}") for p in some])

    clean = [p for p in parts if p.range not in touched]
    out = read(clean) if clean else None
    if touched:
        places = sorted({p.place for p in parts if p.range in touched})
        layers = [read([p for p in parts if p.range in touched and p.place == n]).withColumn("_place", F.lit(n)) for n in places]
        every = layers[0]
        for layer in layers[1:]:
            every = every.union(layer)
        others = [F.col(c) for c in every.columns if c not in (key, "_place")]
        newest = every.groupBy(key).agg(F.max_by(F.struct(*others), "_place").alias("row"))
        newest = newest.select(*[F.col(key) if c == key else F.col("row")[c].alias(c) for c in every.columns if c != "_place"])
        out = newest if out is None else out.union(newest)
    return spark.createDataFrame([], schema) if out is None else out


def _schema_of(spark: SparkSession, base: str, parts: list[Part]):
    (path, *_) = [_path(base, "segments", p.segment, f"range={p.range}") for p in parts]
    return spark.read.parquet(path).schema


def write_snapshot(rows: DataFrame, base: str, version: int, key: str = "customer_id") -> str:
    """Store one row per key as a version of its own; returns the path of its manifest.

    Rows are laid out by ranges of the key, so a look-up of some keys skips the
    files and row groups that cannot hold them. A null key is a key like others.
    """
    parts = _lay_out(rows, base, key)
    _write_manifest(rows.sparkSession, base, version, parts)
    return _manifest_path(base, version)


def read_snapshot(spark: SparkSession, base: str, version: int | None = None, key: str = "customer_id") -> DataFrame:
    """The newest, or the given, version of a stored snapshot: one row per key."""
    if version is None:
        version = snapshot_versions(spark, base)[-1]
    parts = read_manifest(spark, base, version)
    return _rows_of(spark, base, parts, key, _schema_of(spark, base, parts))


def _newer(batch: DataFrame, stored: DataFrame, key: str, created: str) -> DataFrame:
    """The rows of the batch that are newer than the stored row of their key, or whose key is not stored."""
    order = ["event_timestamp"] + ([created] if created in batch.columns else [])
    old = stored.join(batch.select(key), key, "left_semi").select(F.col(key).alias("_key"), F.struct(*order).alias("_old"))
    joined = batch.join(old, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.filter(F.col("_old").isNull() | (F.struct(*order) > F.col("_old"))).drop("_key", "_old")


def merge_snapshot(rows: DataFrame, base: str, key: str = "customer_id", created: str = "created_timestamp") -> int:
    """Merge feature rows into the stored snapshot as its next version, the newest row per key winning.

    Only keys that change are written, and the ranges among theirs that are due
    to be put together. Of equally new rows the stored one stays, so merging the
    same rows again changes nothing and a run can be repeated. Columns are those
    of the first version.
    """
    batch = latest_snapshot(rows, key=key, created=created)
    return update_snapshot(batch, base, lambda new, stored: _newer(new, stored, key, created), key)


def update_snapshot(batch: DataFrame, base: str, combine, key: str = "customer_id", version: int | None = None) -> int:
    """Store the next version of a snapshot from a batch with one row per key; returns its number.

    ``combine(batch, stored)`` gives the rows to write, of keys of the batch
    alone; ``stored`` are the stored rows of the ranges that these fall into.
    With ``version`` the result has this number, and nothing happens if there is
    one as new: an update that adds to what is stored can be repeated.
    """
    spark = batch.sparkSession
    versions = snapshot_versions(spark, base)
    if version is not None and versions and versions[-1] >= version:
        return version
    parts = read_manifest(spark, base, versions[-1]) if versions else []
    if version is None:
        version = versions[-1] + 1 if versions else 0
    if not parts:
        write_snapshot(batch, base, version, key)
        return version
    schema = _schema_of(spark, base, parts)
    batch = materialize(batch.select(*schema.names).withColumn("range", _range_of(key, parts)), "snapshot-batch")
    touched = {r["range"] for r in batch.select("range").distinct().collect()}
    old = [p for p in parts if p.range in touched]
    changed = combine(batch.drop("range"), _rows_of(spark, base, old, key, schema)) if old else batch.drop("range")
    changed = materialize(changed.select(*schema.names).withColumn("range", _range_of(key, parts)), "snapshot-changed")
    if not changed.isEmpty():
        name = _segment(changed.repartition("range"), base, key)
        last, lows = {}, {}
        for p in parts:
            last[p.range], lows[p.range] = max(last.get(p.range, 0), p.place), p.low
        for number, n in _sizes(spark, base, name).items():
            parts.append(Part(number, lows[number], name, last[number] + 1, n, parts[0].laid_out))
    parts = _compacted(spark, base, parts, key, schema)
    _write_manifest(spark, base, version, parts)
    return version


def _compacted(spark: SparkSession, base: str, parts: list[Part], key: str, schema) -> list[Part]:
    """Puts ranges with enough deltas together; all of them, in new ranges, if there are far more rows than they were cut for."""
    if sum(p.rows for p in parts) > GROWTH * max(parts[0].laid_out, RANGES):
        return _lay_out(_rows_of(spark, base, parts, key, schema), base, key)
    due = {p.range for p in parts if p.place >= DELTAS}
    if not due:
        return parts
    mine = [p for p in parts if p.range in due]
    rows = _rows_of(spark, base, mine, key, schema).withColumn("range", _range_of(key, parts))
    name = _segment(rows.repartition("range"), base, key)
    sizes, lows = _sizes(spark, base, name), {p.range: p.low for p in mine}
    new = [Part(r, lows[r], name, 0, n, parts[0].laid_out) for r, n in sizes.items()]
    return [p for p in parts if p.range not in due] + new


def expire_snapshots(spark: SparkSession, base: str, keep: int = 2) -> list[int]:
    """Empty all but the newest ``keep`` versions, and the segments that only they name; returns what is left.

    Readers that still hold an older version lose it, so keep those in use.
    """
    versions = snapshot_versions(spark, base)
    old, left = versions[:-keep] if keep else versions, versions[-keep:] if keep else []
    kept = {p.segment for v in left for p in read_manifest(spark, base, v)}
    gone = {p.segment for v in old for p in read_manifest(spark, base, v)} - kept
    for v in old:
        spark.range(0).write.mode("overwrite").json(_manifest_path(base, v))  # no longer a manifest
    for name in sorted(gone):
        # an overwrite drops the files below, range folders included
        spark.range(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_path(base, "segments", name))
    return left
