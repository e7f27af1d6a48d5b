"""Removal of lines that many documents share.

Lines are normalised and hashed, the documents of each hash counted, and lines
over the threshold dropped by their position. Only hashes, positions and counts
are shuffled for the counting; texts move once, to meet their positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import carried, content_key, hash128, line_key, lines_of, retexted, text_of, uncarried

MIN_KEY_CHARS = 1
MIN_DOCUMENTS = 10


def dropped_lines(docs: DataFrame, min_key_chars: int, min_documents: int) -> DataFrame:
    """Per document with such lines: its key and the positions of the lines to drop."""
    keys = F.transform(lines_of(text_of()), line_key)
    hashed = F.transform(keys, lambda k: F.when(F.char_length(k) >= min_key_chars, hash128(k)))
    rows = materialize(
        docs.select(content_key("doc_id", "text").alias("row_key"), hashed.alias("hashes")), "line-hashes"
    )
    frequent = (
        rows.select(F.explode(F.array_distinct("hashes")).alias("hash"))
        .filter("hash IS NOT NULL")
        .groupBy("hash")
        .agg(F.count("*").alias("documents"))
        .filter(F.col("documents") >= min_documents)
        .select("hash")
    )
    cells = rows.select("row_key", F.posexplode("hashes").alias("pos", "hash")).filter("hash IS NOT NULL")
    hits = cells.join(materialize(frequent, "frequent-lines"), "hash")
    return hits.groupBy("row_key").agg(F.collect_set("pos").alias("dropped"))


def _thinned(docs: DataFrame, min_key_chars: int, min_documents: int) -> DataFrame:
    """The rows of ``docs`` as they are, in ``_row``, beside the text that is left and the figures."""
    dropped = materialize(dropped_lines(docs, min_key_chars, min_documents), "dropped-lines")
    lined = carried(docs, row_key=content_key("doc_id", "text"), lines=lines_of(text_of()))
    joined = lined.join(dropped.hint("merge"), "row_key", "left")  # one plan at every size
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(
        F.array_except(every, F.coalesce("dropped", F.expr("CAST(array() AS array<int>)"))),
        lambda p: F.get(F.col("lines"), p),
    )
    return joined.select(
        "_row",
        F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_dedup(
    docs: DataFrame, min_key_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``docs`` with ``text`` free of shared lines, and n_lines and n_dropped.

    A line's key is the line without white space at both ends, A-Z in lower
    case. Keys of at least ``min_key_chars`` code points that occur in at least
    ``min_documents`` documents lose all their lines in every document; each row
    is a document, also where ids or whole rows repeat. The other lines keep
    their order. A null or empty text is one empty line and gives an empty
    text; texts are read whole. Columns of ``docs`` named n_lines or n_dropped
    give way to the figures; :func:`line_filter` keeps them. An empty table
    gives an empty result.
    """
    own = {c: F.col(c) for c in ("text", "n_lines", "n_dropped")}
    return uncarried(_thinned(docs, min_key_chars, min_documents), docs.columns, **own)


def line_filter(
    docs: DataFrame, min_key_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``docs`` with its columns and the texts of :func:`line_dedup`; n_chars follows the text.

    All other columns stay as they are, whatever their names. A null text
    becomes an empty one. An empty table gives an empty result.
    """
    return retexted(_thinned(docs, min_key_chars, min_documents), docs, F.col("text"))
