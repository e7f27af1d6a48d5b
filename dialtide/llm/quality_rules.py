"""Quality rules: figures of each text, and lines that a host repeats everywhere.

Lines are normalised and hashed; for each host (here: the source of a document)
the distinct documents with a line are counted. A line above the limits is
template text and goes. A document of which little else remains is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CLASS, carried, content_key, hash128, line_key, lines_of, retexted, text_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A line is template text in a host if at least so many different documents hold it, and at least the square root of
#: the host's: what a small host repeats everywhere is one, and the limit of a host a hundred times the size is ten times as high.
MIN_LINE_DOCUMENTS = 10
#: A document is depleted if less than this share of its characters is outside template lines.
MIN_LEFT_PERCENT = 30


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from ``words``: words inside windows that the text holds twice or more.

    Window hashes are compared inside the row. Texts whose windows all differ
    end there; the others sort them, mark equal neighbours and add up the
    stretches that the marked windows cover. Nothing is quadratic in the text.
    """
    n = F.size("words")
    window = lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)])
    df = df.withColumn(
        "hashes",
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(
            F.expr("CAST(array() AS array<bigint>)")
        ),
    )
    df = df.withColumn("repeats", F.size("hashes") - F.size(F.array_distinct("hashes")))
    df = df.withColumn(
        "ordered",
        F.when(F.col("repeats") > 0, F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    at = lambda k: F.get(F.col("ordered"), k)["h"]
    marked = F.filter(
        F.sequence(F.lit(0), F.size("ordered") - 1),
        lambda k: F.coalesce(at(k) == at(k - 1), F.lit(False)) | F.coalesce(at(k) == at(k + 1), F.lit(False)),
    )
    df = df.withColumn(
        "starts",
        F.when(
            F.col("repeats") > 0,
            F.array_sort(F.transform(marked, lambda k: F.get(F.col("ordered"), k)["i"])),
        ),
    )
    following = F.concat(
        F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))),
        F.array(F.element_at("starts", -1) + WINDOW),
    )
    covered = F.zip_with("starts", following, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.when(F.col("repeats") > 0, total).otherwise(F.lit(0).cast("long"))).drop(
        "hashes", "repeats", "ordered", "starts"
    )


def _count(n: Column) -> Column:
    return n.cast("long")


def base_figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: doc_id, host, a key of these and the text, the figures of the text, its hash and its lines.

    ``lines`` holds, for each line with a word, its hash, number of characters and place among all lines.
    """
    df = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        text_of().alias("text"),
    )
    df = df.withColumn("content", content_key("doc_id", "host", "text"))
    df = df.withColumns(
        {
            "words": F.regexp_extract_all("text", F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0)),
            "n_symbols": _count(F.regexp_count("text", F.lit("[#*$%&|<>]"))),
            "written": F.filter(
                F.transform(lines_of(F.col("text")), lambda line, i: F.struct(line.alias("line"), i.alias("pos"))),
                lambda x: x["line"].rlike(f"[^{SPACE_CLASS}]"),
            ),
            "fingerprint": F.xxhash64("text"),
        }
    ).drop("text")
    df = df.withColumns(
        {
            "n_words": _count(F.size("words")),
            "word_chars": F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.char_length(w)),
            "n_dup_lines": _count(F.size("written") - F.size(F.array_distinct("written.line"))),
            "lines": F.transform(
                F.transform("written", lambda x: F.struct(line_key(x["line"]).alias("k"), x["pos"].alias("pos"))),
                lambda x: F.struct(hash128(x["k"]).alias("hash"), F.char_length(x["k"]).alias("chars"), x["pos"].alias("pos")),
            ),
        }
    ).drop("written")
    df = _repeat_words(df).drop("words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def template_lines(figures: DataFrame) -> DataFrame:
    """(host, hash) of the lines above the limits. Copies of a text count as one document."""
    hosts = figures.groupBy("host").agg(F.count_distinct("fingerprint").alias("host_documents"))
    lines = (
        figures.select("host", "fingerprint", F.explode(F.array_distinct("lines.hash")).alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count_distinct("fingerprint").alias("documents"))
        .filter(F.col("documents") >= MIN_LINE_DOCUMENTS)
    )
    lines, hosts = lines.alias("l"), hosts.alias("h")
    return (
        lines.join(hosts, F.col("l.host").eqNullSafe(F.col("h.host")))
        .filter(F.col("documents") * F.col("documents") >= F.col("host_documents"))
        .select("l.host", "hash")
    )


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: its figures, n_chars_left, n_line_chars, n_template_lines, their places and ``kept``, see :func:`quality_rules`."""
    figures = materialize(
        base_figures(docs, host).withColumn("row", F.monotonically_increasing_id()), "quality-figures"
    )
    known, unknown = F.coalesce("host", F.lit("")).alias("h"), F.col("host").isNull().alias("u")
    cells = figures.select("row", known, unknown, F.explode("lines").alias("line"))
    template = materialize(template_lines(figures), "template-lines").select(known, unknown, "hash")
    lost = (
        cells.select("row", "h", "u", "line.hash", "line.chars", "line.pos")
        .join(template, ["h", "u", "hash"])
        .groupBy("row")
        .agg(F.sum("chars").alias("lost"), F.collect_list("pos").alias("dropped"))
    )
    all_chars = F.aggregate("lines.chars", F.lit(0).cast("long"), lambda s, c: s + c)
    rows = figures.withColumn("n_line_chars", all_chars).drop("lines").join(lost, "row", "left")
    rows = rows.withColumn("n_chars_left", (F.col("n_line_chars") - F.coalesce("lost", F.lit(0))).cast("long"))
    rows = rows.withColumn("n_template_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long"))
    depleted = 100 * F.col("n_chars_left") < MIN_LEFT_PERCENT * F.col("n_line_chars")
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Each document with its figures and whether it is kept.

    Words are runs without white space. A document fails the base rules with
    fewer than :data:`MIN_WORDS` words, or if more than
    :data:`MAX_REPEAT_PERCENT` percent of its words are in five-word windows
    that it holds twice or more. It is rejected as depleted if template lines
    of its host leave less than :data:`MIN_LEFT_PERCENT` percent of the
    characters of its lines. Documents without a host form one host. Null and
    empty texts have no words and fail. Texts are read whole. Repeated rows are
    judged alike. An empty table gives an empty result; other columns are not
    read, whatever their names. The texts without template lines are those of
    :func:`quality_filter`.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_chars_left, n_line_chars,
    n_template_lines.
    """
    return judged(docs, host).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_chars_left",
        "n_line_chars",
        "n_template_lines",
    )


def quality_filter(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with their columns, and texts without template lines.

    The other lines keep their order; n_chars follows a text that lost lines.
    Null and empty texts go, repeated rows stay or go together, columns of any
    names stay as they are. An empty table gives an empty result.
    """
    rows = judged(docs, host).filter("NOT kept OR n_template_lines > 0").select("content", "kept", "dropped")
    rows = materialize(rows.groupBy("content").agg(F.first("kept").alias("kept"), F.first("dropped").alias("dropped")), "verdicts")
    plain = carried(docs, doc_id=F.col("doc_id").cast("long"), host=F.col(host).cast("string"), text=text_of())
    plain = plain.select("_row", "text", lines_of(F.col("text")).alias("lines"), content_key("doc_id", "host", "text").alias("content"))
    joined = plain.join(rows.hint("merge"), "content", "left").filter("kept IS NULL OR kept")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    left = F.array_join(F.transform(places, lambda p: F.get(F.col("lines"), p)), "\n")
    left = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left)
    return retexted(joined.select("_row", left.alias("text")), docs, F.col("text"))
