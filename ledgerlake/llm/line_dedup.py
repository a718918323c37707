"""Line dedup: lines that many documents share stay in one of them."""

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import ascii_lower, wide_hash
from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize

BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 20
MIN_DOCS = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``(h1, h2, keeper)``: keys found in at least ``min_docs`` documents.

    Occurrences are first reduced to one row per key and document, then counted per
    key; both steps combine inside each task before they shuffle, so a line that
    stands in every document arrives as one row per task.
    """
    return (
        _keys(docs, min_chars).groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper")
    )


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = docs.select(
        "doc_id", F.xxhash64("text").alias("version"),
        F.posexplode(_lines(F.col("text"))).alias("position", "line"),
    )
    keyed = lines.select("doc_id", "version", "position", line_key(F.col("line")).alias("key"))
    h1, h2 = wide_hash(F.col("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "version", "position", h1.alias("h1"), h2.alias("h2")
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with shared lines gone: all columns as given, ``text`` shortened.

    A line's key is :func:`line_key`. A key of at least ``min_chars`` characters that
    at least ``min_docs`` documents hold loses all its lines except those in the
    document with the largest id. Adds ``n_lines`` (before) and ``n_dropped``.

    Null or empty text is one empty line. Rows that share a doc_id count as one
    document; null ids count as one document that is never the largest. Repeated rows
    come out alike, each on its own row. Only ``doc_id`` and ``text`` are looked at, so
    other columns may have any names but ``n_lines`` and ``n_dropped``, which are replaced.

    Texts move once, to meet the positions of their dropped lines. Shared keys reach
    the lines by a size-checked broadcast, or beyond it by a join that spreads hot keys.
    """
    source = docs.select("doc_id", "text")
    keys = _keys(source, min_chars)
    shared = materialize(shared_lines(source, min_chars, min_docs), "shared-lines")
    dropped = (
        lookup_join(
            keys, shared, ["h1", "h2"], "inner",
            hot_from=keys.select("h1", "h2"), spread_by=["doc_id", "version", "position"],
        )
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "version")
        .agg(F.collect_set("position").alias("gone"))
        .select(F.struct("doc_id", "version").alias("owner"), "gone")
    )
    rest = [name for name in docs.columns if name not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in rest)).alias("row"))
    key = F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("version"))
    joined = rows.join(dropped, key.eqNullSafe(F.col("owner")), "left")
    cut = joined.select("row", "gone", _lines(F.col("row.text")).alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda at: F.get(F.col("lines"), at)), "\n")
    text = F.when(F.col("gone").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(kept)
    return cut.select(
        *((text if name == "text" else F.col("row")[name]).alias(name) for name in rest),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts and the SHA-256 of what stays."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )
