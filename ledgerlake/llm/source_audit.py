"""Source divergence audit: how the word use of each source departs from its language.

Identical texts of a language collapse to one class with a multiplicity per source, are
cut into terms once, and add their counts weighted. Pairs of sources are then evaluated
over the terms that both hold; terms that one or none holds enter as sums over counts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import wide_hash, workers_import
from ledgerlake.llm.lexical_search import cut_terms, ranges
from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize

# Runs of letters and of anything beyond ASCII, by byte.
_IS_TERM = np.zeros(256, bool)
for _first, _last in (("A", "Z"), ("a", "z")):
    _IS_TERM[ord(_first):ord(_last) + 1] = True
_IS_TERM[128:] = True
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
# Bytes of text that are cut together, and counts that a task holds before it sends them on.
CHUNK_BYTES = 1 << 23
HELD_COUNTS = 1 << 21


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of each term and documents holding it.

    Equal texts of a language are one class, named by a 128-bit hash, so a text moves once
    per task that holds it and is cut into terms once. A task adds the counts of its
    classes, weighted by their copies in each source, and sends one row per language and
    term. The result is dealt by (lang, term), so that later groupings by these move nothing.
    """
    workers_import(docs.sparkSession)
    plain = docs.select(*(
        F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
        for name in ("lang", "source", "text")
    ))
    h1, h2 = wide_hash(F.col("text"))
    keyed = plain.select("*", h1.alias("h1"), h2.alias("h2"))
    key = ["lang", "h1", "h2"]
    copies = keyed.groupBy(*key, "source").agg(F.count("*").alias("copies"))
    texts = keyed.groupBy(*key).agg(F.any_value("text").alias("text"))
    # A class's rows are next to each other: one for each of its sources.
    classes = texts.join(copies, key).select("lang", "source", "copies", "text")
    found = classes.mapInArrow(
        _count, "lang string, term string, source array<string>, n array<long>, docs array<long>"
    )
    each = found.repartition("lang", "term").select(
        "lang", "term", F.explode(F.arrays_zip("source", "n", "docs")).alias("of")
    )
    return each.groupBy("lang", "term", F.col("of.source").alias("source")).agg(
        F.sum("of.n").alias("n"), F.sum("of.docs").alias("docs")
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, number = [], 0
    for chunk in _chunks(batches):
        held.append(_chunk_counts(chunk))
        number += held[-1].num_rows
        if number >= HELD_COUNTS:
            yield from _nested(pa.concat_tables(held))
            held, number = [], 0
    if held:
        yield from _nested(pa.concat_tables(held))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held and any(batch.num_rows for batch in held):
        yield pa.Table.from_batches(held).combine_chunks()


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = column.combine_chunks().dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _chunk_counts(rows: pa.Table) -> pa.Table:
    """Counts by (lang, source, term) of rows ``(lang, source, copies, text)``; equal texts
    are cut once."""
    text, texts = _codes(rows["text"].cast(pa.large_string()))
    lang, langs = _codes(rows["lang"])
    source, sources = _codes(rows["source"])
    terms, sizes = cut_terms(texts, _IS_TERM)
    coded = terms.dictionary_encode()
    words = max(len(coded.dictionary), 1)
    # Distinct (text, term) with occurrences, in order of texts.
    keys = np.sort(np.repeat(np.arange(len(texts)), sizes) * words + coded.indices.to_numpy())
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    occurs = np.diff(np.append(heads, len(keys)))
    of_text, word = np.divmod(keys[heads], words)
    held = np.bincount(of_text, minlength=len(texts))
    # Each row takes the terms of its text.
    each = held[text]
    at = ranges((np.cumsum(held) - held)[text], each)
    copies = np.repeat(rows["copies"].to_numpy(), each)
    group = np.repeat(lang * len(sources) + source, each)
    keys = group * words + word[at]
    order = np.argsort(keys)
    keys, copies, occurs = keys[order], copies[order], occurs[at][order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    group, word = np.divmod(keys[heads], words)
    total = lambda values: np.add.reduceat(values, heads) if len(heads) else values[:0]
    take = lambda values, at: values.take(pa.array(at)).cast(pa.large_string())
    return pa.table({
        "lang": take(langs, group // len(sources)), "source": take(sources, group % len(sources)),
        "term": coded.dictionary.take(pa.array(word)).cast(pa.large_string()),
        "n": total(copies * occurs), "docs": total(copies),
    })


def _nested(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row per language and term, with the counts of all sources in arrays."""
    (lang, langs), (term, terms) = _codes(counts["lang"]), _codes(counts["term"])
    source, sources = _codes(counts["source"])
    keys = (lang * max(len(terms), 1) + term) * max(len(sources), 1) + source
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    if not len(heads):
        return
    n, docs = (np.add.reduceat(counts[name].to_numpy()[order], heads) for name in ("n", "docs"))
    owner, source = np.divmod(keys[heads], len(sources))
    rows = np.flatnonzero(np.diff(owner, prepend=-1))
    lang, term = np.divmod(owner[rows], len(terms))
    edges = np.append(rows, len(owner))
    names = sources.take(pa.array(source)).cast(pa.string())
    # Slices keep what one batch sends small.
    for begin in range(0, len(rows), 20_000):
        end = min(begin + 20_000, len(rows))
        cuts = pa.array((edges[begin:end + 1] - edges[begin]).astype(np.int32))
        span = slice(edges[begin], edges[end])
        yield pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(lang[begin:end])).cast(pa.string()),
                terms.take(pa.array(term[begin:end])).cast(pa.string()),
                pa.ListArray.from_arrays(cuts, names.slice(span.start, span.stop - span.start)),
                pa.ListArray.from_arrays(cuts, pa.array(n[span])),
                pa.ListArray.from_arrays(cuts, pa.array(docs[span])),
            ],
            ["lang", "term", "source", "n", "docs"],
        )


def _div(dividend: Column, divisor: Column) -> Column:
    return F.call_function("div", dividend, divisor)


def _share(count: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / size), exact; ``size`` is N + V."""
    scale = F.lit(SCALE).cast("long")
    # Beyond 64 bits the product is a decimal.
    wide = _div((count + 1).cast("decimal(20,0)") * scale.cast("decimal(10,0)"), size.cast("decimal(20,0)"))
    small = count < 9_000_000_000
    return 1 + F.when(small, _div(F.when(small, count + 1) * scale, size)).otherwise(wide)


def _departure(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def audit_sources(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` as whole numbers, all arithmetic exact.

    A language keeps the V terms that at least ``min_docs`` of its documents hold. A group
    is an occurring (lang, source); its share of a term is
    ``p = 1 + floor(10^9 (count + 1) / (N + V))`` with N its occurrences of kept terms, and
    the departure of p from q is ``floor((p - q)^2 / q)``.

    * part ``pair``: for each other source of the language, the sum of departures from its
      shares over all kept terms; every source is listed.
    * part ``term``: kept terms that the group holds and uses more than its language does,
      with the departure from the language's share; the first ``top_terms``.

    Null lang, source and text count as empty. Empty texts make their group occur and
    give no term; a language without kept terms has pairs of value 0 and no term part.
    Repeated rows are documents of their own. Ties rank by the item's UTF-8 bytes. No row
    gives no row. Other columns are not looked at.

    Sparse pairs: with every share at its value for count 0 a pair sums to V times one
    departure; the terms of each side alone correct that by the distribution of its
    counts, and the terms of both by a join on the term.
    """
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(docs).select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("total"),
        F.sum("docs").over(of_term).alias("docs"),
        (F.row_number().over(of_term.orderBy("source")) == 1).cast("long").alias("first"),
    )
    held = materialize(counts.where(F.col("docs") >= min_docs).drop("docs"), "term-counts")
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("first").alias("firsts"))
    sizes = materialize(sizes, "sizes")
    langs = sizes.groupBy("lang").agg(F.sum("firsts").alias("v"), F.sum("size").alias("total"))
    groups = docs.select(*(
        F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")
    )).distinct()
    zero = F.lit(0).cast("long")
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("v", zero).alias("v"),
        (F.coalesce("size", zero) + F.col("v")).alias("size"),
        (F.col("total") + F.col("v")).alias("lang_size"),
    )
    # The share of a term that the group does not hold; null where nothing is kept.
    groups = materialize(groups.withColumn("none", _share(zero, F.col("size"))), "groups")
    held = lookup_join(held, groups, ["lang", "source"], "inner").select(
        "lang", "source", "term", "none", _share(F.col("n"), F.col("size")).alias("p"),
        _share(F.col("total"), F.col("lang_size")).alias("q"),
    )
    held = materialize(held, "shares")
    return _term_part(held, top_terms).unionByName(_pair_part(held, groups))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value",
        F.row_number().over(order).alias("rank"),
    )


def _term_part(held: DataFrame, top: int) -> DataFrame:
    more = held.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"),
        _departure(F.col("p"), F.col("q")).alias("value"),
    )
    return _ranked(more, "term").where(F.col("rank") <= top)


# A departure is below 2^61: sums of its two halves stay within 64 bits.
_HALF = 1 << 31


def _sums(rows: DataFrame) -> DataFrame:
    """Exact sums of ``value`` by ordered pair, as decimals."""
    half = F.lit(_HALF).cast("long")
    high = _div(F.col("value"), half)
    return rows.groupBy("lang", "source", "item").agg(
        F.sum(F.col("times") * high).alias("high"),
        F.sum(F.col("times") * (F.col("value") - high * half)).alias("low"),
    ).select(
        "lang", "source", "item",
        (F.col("high").cast("decimal(20,0)") * _HALF + F.col("low")).cast("decimal(38,0)").alias("value"),
    )


def _pair_part(held: DataFrame, groups: DataFrame) -> DataFrame:
    own, other = F.col("none"), F.col("other_none")
    others = groups.select(
        "lang", F.col("source").alias("item"), F.col("none").alias("other_none"), "v"
    )
    neither = _departure(own, other)
    differ = F.col("source") != F.col("item")
    start = lookup_join(groups.drop("v"), others, ["lang"], "inner", differ).select(
        "lang", "source", "item", F.coalesce(neither, F.lit(0)).alias("value"), F.col("v").alias("times")
    )
    # Terms of one side: their departure follows from the count alone.
    spread = materialize(
        held.groupBy("lang", "source", "p", "none").agg(F.count("*").alias("times")), "spread"
    )
    sides = lookup_join(spread, others.drop("v"), ["lang"], "inner", differ)
    left = sides.select(
        "lang", "source", "item", (_departure(F.col("p"), other) - neither).alias("value"), "times"
    )
    right = sides.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"),
        (_departure(other, F.col("p")) - _departure(other, own)).alias("value"), "times",
    )
    # Terms of both sides: each two sources meet once, for both directions.
    partner = held.select(
        "lang", "term", F.col("source").alias("item"), F.col("p").alias("other_p"),
        F.col("none").alias("other_none"),
    )
    p, q = F.col("p"), F.col("other_p")
    met = held.select("lang", "term", "source", "p", "none").join(partner, ["lang", "term"])
    there = _departure(p, q) - _departure(p, other) - _departure(own, q) + neither
    back = _departure(q, p) - _departure(q, own) - _departure(other, p) + _departure(other, own)
    half = F.lit(_HALF).cast("long")
    halves = met.where(F.col("source") < F.col("item")).select(
        "lang", "source", "item", there.alias("there"), back.alias("back")
    )
    both = halves.groupBy("lang", "source", "item").agg(*(
        F.sum(part).alias(f"{name}_{side}")
        for name in ("there", "back")
        for side, part in (
            ("high", _div(F.col(name), half)),
            ("low", F.col(name) - _div(F.col(name), half) * half),
        )
    ))
    whole = lambda name: (
        F.col(f"{name}_high").cast("decimal(20,0)") * _HALF + F.col(f"{name}_low")
    ).cast("decimal(38,0)")
    directions = F.array(
        F.struct("source", "item", whole("there").alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), whole("back").alias("value")),
    )
    both = both.select("lang", F.explode(directions).alias("of")).select("lang", "of.*")
    summed = both
    for part in (start, left, right):
        summed = summed.unionByName(_sums(part))
    summed = summed.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return _ranked(summed, "pair")
