"""Small column helpers shared by the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: The white space of the contracts, as characters and as a regular expression class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"

ROW_BITS = 33  #: ``monotonically_increasing_id`` counts rows below this bit, partitions above.


#: Bytes that Spark hands to a Python worker at a time, whatever the length of the texts.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are bounded by their bytes and not only by their rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_of(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def document_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` without nulls; all other columns are left out."""
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    """The lines of a text, trailing empty ones included."""
    return F.split(text, "\n", -1)


def hash128(*parts: Column) -> Column:
    """Two independent 64-bit hashes as one comparable value."""
    return F.struct(F.xxhash64(F.lit(17), *parts).alias("h1"), F.xxhash64(F.lit(9176), *parts).alias("h2"))


def content_key(*columns: str) -> Column:
    """A 128-bit key of a row's content, nulls told apart from every value; equal for repeated rows."""
    return hash128(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def carried(docs: DataFrame, **own: Column) -> DataFrame:
    """The operator's own columns next to the whole row, so that names cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[v.alias(k) for k, v in own.items()])


def retexted(df: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of the carried rows of ``docs``, with a new text; an n_chars of theirs follows it."""
    every = {c: F.col("_row").getField(c) for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in docs.columns:
        every["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return df.select(*[every[c].alias(c) for c in docs.columns])


def uncarried(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of the carried rows; those named in ``changed`` give way to it, the others of it come at the end."""
    every = {c: F.col("_row").getField(c) for c in columns} | changed
    return df.select(*[v.alias(c) for c, v in every.items()])


def running_total(df: DataFrame, value: Column, bucket: Column, order: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before each, by (bucket, order).

    Sums per bucket come first; only they, one row a bucket, pass through one
    task. Rows are then added up inside their buckets in parallel.
    """
    rows = df.withColumns({"_bucket": bucket, "_value": value.cast("long"), "_order": order})
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy("_bucket")
        .agg(F.sum("_value").alias("_total"))
        .select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_inner", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(totals, "_bucket")
        .withColumn(name, F.col("_base") + F.col("_inner"))
        .drop("_bucket", "_value", "_order", "_inner", "_base")
    )


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``position``, from 0, in the order of ``order``.

    Rows are dealt out by ranges of the order, sorted inside them and stored;
    the sizes of the ranges, one row each, say where a range begins.
    """
    tie = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
    rows = df.withColumn("_tie", tie)  # equal rows need not end up in one range
    rows = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    rows = materialize(rows.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    joined = rows.withColumn("_part", part).join(F.broadcast(bases), "_part")
    return joined.withColumn("position", F.col("_base") + inner).drop("_at", "_part", "_base")
