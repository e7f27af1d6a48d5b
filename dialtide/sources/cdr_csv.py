"""Raw call-record CSV files.

Spark judges a CSV row malformed by the columns a query happens to read, so the
same file can give different counts to different queries. Here every field is
read as text and converted explicitly; a row is malformed when a present field
does not convert or the number of fields is wrong, whatever is selected later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_CDR

CORRUPT = "_corrupt_record"

#: Without pruning every field is parsed, so a wrong field count is always seen.
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
}


def raw_path(base: str, date: str) -> str:
    """Where a day's raw files arrive."""
    return f"{base.rstrip('/')}/cdr/{date}/"


def silver_path(base: str, date: str) -> str:
    """Where a day's cleaned records go; ``dt`` is discovered as a partition."""
    return f"{base.rstrip('/')}/cdr/dt={date}/"


def text_schema() -> T.StructType:
    fields = [T.StructField(f.name, T.StringType()) for f in RAW_CDR.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _converted(name: str, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.col(name)
    if isinstance(data_type, T.IntegerType):
        # a plain cast would accept blanks around the digits and cut off decimals
        return F.when(F.col(name).rlike(r"^[+-]?[0-9]+$"), F.col(name).try_cast(data_type))
    return F.col(name).try_cast(data_type)


def _bad(name: str, data_type: T.DataType) -> Column:
    return F.col(name).isNotNull() & _converted(name, data_type).isNull()


def _malformed() -> Column:
    bad = F.col(CORRUPT).isNotNull()
    for f in RAW_CDR.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | _bad(f.name, f.dataType)
    return bad


def _typed(text: DataFrame) -> DataFrame:
    return text.select(*[_converted(f.name, f.dataType).alias(f.name) for f in RAW_CDR.fields])


def read_cdr_text(spark: SparkSession, path: str) -> DataFrame:
    """All rows, every field as text, with the source line of broken ones."""
    return (
        spark.read.schema(text_schema())
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def typed_records(text: DataFrame) -> DataFrame:
    """The well-formed rows of :func:`read_cdr_text`, in their declared types."""
    return _typed(text.filter(~_malformed()))


def read_cdr_csv(spark: SparkSession, path: str) -> DataFrame:
    """Well-formed call records of a header CSV; malformed rows are left out."""
    return typed_records(read_cdr_text(spark, path))


def quarantine_rows(spark: SparkSession, path: str) -> DataFrame:
    """The malformed rows as text, with the first field at fault."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "field_count")
    for f in RAW_CDR.fields:
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(_bad(f.name, f.dataType), f.name)
    return read_cdr_text(spark, path).filter(_malformed()).withColumn("reason", reason)


def write_cdr_csv(df: DataFrame, path: str) -> None:
    """Records as header CSV in the raw column order."""
    df.select(*[F.col(f.name).cast("string").alias(f.name) for f in RAW_CDR.fields]).write.mode("overwrite").csv(
        path, header=True
    )
