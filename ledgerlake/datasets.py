"""The given benchmark tables, mapped to the shapes this package works on.

Line items play till lines, suppliers stores, parts products, and documents
notices. Their rules are stated once more, as SQL, in ``oracles.py``.
"""

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake import schemas
from ledgerlake.functions.text import notice_tokens as normalized, shingles
from ledgerlake.operators.evaluate import WIDTHS, shingle_sets
from ledgerlake.operators.landing import first_file_wins, normalized as lake_lines
from ledgerlake.operators.lsh import band_rows
from ledgerlake.operators.minhash import LaneFamily, signature
from ledgerlake.operators.skew import lookup_join
from ledgerlake.plans import reconcile, star
from ledgerlake.session import materialize
from ledgerlake.sources import tills
from ledgerlake.sources.masters import as_declared
from ledgerlake.sources.notices import ordered_pairs

REISSUE_DAY = "1998-06-01"
REVISED_DAY = "1997-01-01"
YEAR = "1996"  # the year whose three known months differ from finance


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _store(supplier: str) -> Column:
    number = (F.col(supplier) % 12 + 1).cast("string")
    return F.concat(F.lit("S"), F.lpad(number, 2, "0"))


def raw_lines(spark: SparkSession, sf_dir: str, files: str = "day") -> DataFrame:
    """Till lines with re-sends, each with the name of the file it came in: one per store
    and day, ``month`` or ``year``."""
    flags = F.concat("l_returnflag", "l_linestatus")
    kind = (
        F.when(flags == "NO", "SALE").when(flags == "RF", "RETURN")
        .when(flags == "AF", "DISCOUNT").when(flags == "RO", "VOID")
        .when(flags == "AO", "TAX").otherwise("TENDER")
    )
    day = F.to_date("l_shipdate") if files == "day" else F.trunc("l_shipdate", files)
    control = (F.col("line_type") == "DISCOUNT") | (
        (F.col("line_type") == "VOID") & (F.col("l_linenumber") == 7)
    )
    sign = F.when(F.col("line_type").isin("RETURN", "DISCOUNT", "VOID"), -1).otherwise(1)
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("line_type", kind)
        .select(
            F.concat(
                F.lit("SALES_"), _store("l_suppkey"), F.lit("_"),
                F.date_format(day, "yyyyMMdd"), F.lit(".csv"),
            ).alias("file"),
            F.col("l_orderkey").cast("string").alias("bill_no"),
            F.col("l_linenumber").alias("line_no"),
            F.when(control, "DISC").otherwise(F.col("l_partkey").cast("string"))
            .alias("product_code"),
            (F.col("l_quantity") * sign).cast(schemas.QTY).alias("qty"),
            F.col("l_extendedprice").cast(schemas.PRICE).alias("unit_price"),
            "line_type",
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        )
    )


def dialect_slice(raw: DataFrame, dialect: tills.Dialect) -> DataFrame:
    """The lines of one dialect's stores, under that dialect's column names."""
    rows = raw.where(F.col("file").rlike(f"^SALES_{dialect.stores}_"))
    names = {canonical: name for canonical, name in dialect.columns.items()}
    return rows.withColumnsRenamed(names).select("file", *dialect.schema.fieldNames())


def till_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw lines, conformed from their three dialects."""
    raw = raw_lines(spark, sf_dir)
    parts = [
        tills.conform(dialect_slice(raw, dialect), dialect, F.col("file"))
        for dialect in tills.DIALECTS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def conformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw lines in one scan, for queries that start after the dialects."""
    return tills.conform(raw_lines(spark, sf_dir), tills.COMMA, F.col("file"))


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``land(conformed_lines)``. The first file wins before store and date are
    read off its name, so narrower rows move and only kept lines are parsed."""
    raw = raw_lines(spark, sf_dir).withColumn("line_no", F.col("line_no").cast("int"))
    return lake_lines(tills.conform(first_file_wins(raw), tills.COMMA, F.col("file")))


def line_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all raw lines: which are frequent shows without landing them."""
    return raw_lines(spark, sf_dir).select("product_code")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, name) for name in ("nation", "region"))
    places = F.broadcast(nation.join(region, nation.n_regionkey == region.r_regionkey))
    suppliers = table(spark, sf_dir, "supplier")
    rows = (
        suppliers.join(places, suppliers.s_nationkey == places.n_nationkey)
        .groupBy(_store("s_suppkey").alias("store_id"))
        .agg(
            F.min("s_name").alias("store_name"),
            F.max("s_name").alias("address_line"),
            F.min("n_name").alias("city"),
            F.max("n_name").alias("state"),
            F.min("r_name").alias("region"),
            (F.count("*") * 100).alias("floor_area_sqft"),
            F.lit("1994-01-01").alias("opened_on"),
        )
    )
    return as_declared(rows, "stores")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(
        F.struct(F.col("p_brand").alias("id"), F.lit("Brand").alias("department"),
                 F.lit("0.050").alias("rate")),
        F.struct(F.col("p_type").alias("id"), F.lit("Type").alias("department"),
                 F.lit("0.180").alias("rate")),
    )
    rows = (
        table(spark, sf_dir, "part").select(F.explode(kinds).alias("kind")).select("kind.*")
        .distinct()
        .select(
            F.col("id").alias("category_id"),
            F.concat(F.lit("Category "), "id").alias("category_name"),
            "department",
            F.col("rate").alias("gst_rate"),
        )
    )
    return as_declared(rows, "product_categories")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product versions: every 50th code is reissued to another product.

    Some others get a revised version while the first is still valid.
    """
    reissued = F.col("p_partkey") % 50 == 0
    revised = F.col("p_partkey") % 60 == 11
    start = F.when(F.col("p_partkey") % 30 == 7, "1996-01-01").otherwise("1995-01-01")

    def version(offset, name, category, valid_from, valid_to, current):
        return F.struct(
            (F.col("p_partkey") * 2 + offset).alias("product_sk"),
            name.alias("product_name"),
            category.alias("category_id"),
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            current.alias("is_current"),
        )

    first = version(
        0, F.col("p_name"), F.col("p_brand"), start,
        F.when(reissued, "1998-05-31").otherwise(schemas.OPEN_END), ~(reissued | revised),
    )
    second = version(
        1, F.concat("p_name", F.lit(" (new)")), F.col("p_type"), F.lit(REISSUE_DAY),
        F.lit(schemas.OPEN_END), F.lit(True),
    )
    overlapping = version(
        1, F.concat("p_name", F.lit(" (rev)")), F.col("p_type"), F.lit(REVISED_DAY),
        F.lit(schemas.OPEN_END), F.lit(True),
    )
    both = (
        F.when(reissued, F.array(first, second))
        .when(revised, F.array(first, overlapping)).otherwise(F.array(first))
    )
    return (
        table(spark, sf_dir, "part")
        .withColumn("version", F.explode(both))
        .select(
            "p_partkey", "p_retailprice", "version.*",
            F.col("p_partkey").cast("string").alias("product_code"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").cast("string").alias("pack_size"),
            F.lit("EA").alias("uom"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_declared(_versions(spark, sf_dir), "products")


def price_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two price periods per version; every 40th part has none."""
    price = F.col("p_retailprice").cast("decimal(12,2)")

    def period(offset, start, end, add):
        return F.struct(
            (F.col("product_sk") * 2 + offset).alias("revision_id"),
            (price + F.lit("50.00").cast("decimal(12,2)")).alias("mrp"),
            (price + F.lit(add).cast("decimal(12,2)")).alias("selling_price"),
            start.alias("effective_from"),
            end.alias("effective_to"),
        )

    periods = F.array(
        period(0, F.col("valid_from"), F.least("valid_to", F.lit("1997-06-30")), "0.00"),
        period(1, F.greatest("valid_from", F.lit("1997-07-01")), F.col("valid_to"), "12.50"),
    )
    rows = (
        _versions(spark, sf_dir).where(F.col("p_partkey") % 40 != 0)
        .select("product_sk", F.explode(periods).alias("period"))
        .select("product_sk", "period.*")
        .where("effective_from <= effective_to")
    )
    return as_declared(rows, "price_revisions")


def masters(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "stores": stores(spark, sf_dir),
        "product_categories": categories(spark, sf_dir),
        "products": products(spark, sf_dir),
        "price_revisions": price_revisions(spark, sf_dir),
    }


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("business_date"))
    return star.calendar(star.whole_years(days))


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_store(stores(spark, sf_dir))


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_category(categories(spark, sf_dir))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_product(products(spark, sf_dir), dim_category(spark, sf_dir))


@dataclass(frozen=True)
class Star:
    """The star schema; dimensions are stored, the fact is a plan over them."""

    store: DataFrame
    category: DataFrame
    product: DataFrame
    fact: DataFrame


def star_schema(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> Star:
    """Each dimension is built once and stored, so that the joins, and the counts that
    decide how to join, read a small table."""
    codes = line_codes(spark, sf_dir) if lines is None else None
    lines = landed_lines(spark, sf_dir) if lines is None else lines
    store = materialize(dim_store(spark, sf_dir), "dim-store")
    category = materialize(dim_category(spark, sf_dir), "dim-category")
    product = materialize(star.dim_product(products(spark, sf_dir), category), "dim-product")
    return Star(store, category, product, star.fact_sales_line(lines, store, product, codes))


def fact(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return star_schema(spark, sf_dir, lines).fact


def missing_exports(lines: DataFrame) -> DataFrame:
    """The lines without the three days one store never exported."""
    lost = (F.col("store_id") == "S07") & F.col("business_date").between(
        f"{YEAR}-07-09", f"{YEAR}-07-11"
    )
    return lines.where(~lost)


def finance(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Finance's months: one adds an invoice, one rounds each bill, none lacks days."""
    lines = landed_lines(spark, sf_dir) if lines is None else lines
    net = F.sum(F.col("qty") * F.col("unit_price"))
    bills = (
        lines.where(F.col("line_type").isin(*schemas.REVENUE_LINE_TYPES))
        .groupBy(F.date_format("business_date", "yyyy-MM").alias("month"), "bill_no")
        .agg(net.alias("net"))
    )
    months = bills.groupBy("month").agg(
        F.sum("net").alias("exact"), F.sum(F.round("net", 0)).alias("rounded")
    )
    revenue = (
        F.when(F.col("month") == f"{YEAR}-03", F.col("exact") + 486250)
        .when(F.col("month") == f"{YEAR}-12", F.col("rounded"))
        .otherwise(F.col("exact"))
    )
    return months.select("month", F.round(revenue, 2).cast(schemas.PRICE).alias("revenue_inr"))


def known_differences(spark: SparkSession) -> DataFrame:
    return reconcile.known_differences(spark, known_rows())


def known_rows() -> list[tuple[str, ...]]:
    """The known differences, month and dates in their wording moved to ``YEAR``."""
    first_year = reconcile.KNOWN_DIFFERENCES[0][0][:4]
    return [
        tuple(value.replace(f"{first_year}-", f"{YEAR}-") for value in row)
        for row in reconcile.KNOWN_DIFFERENCES
    ]


TITLE_CHARS = 120
RULE = "-" * 12


# Form letters are notices of their own; their ids start here.
FORM_IDS = 100_000_000_000


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as notices, each with its whole text: framed, closed by a clause, plain, or
    framed without reference. A fifth of the documents also gives a form letter that only
    differs in its amount, date and number.

    The frames hold what real notices do: markers, amounts, dates, references,
    boilerplate and a disclaimer, so that every rule of the normalization meets text. A
    hash of the id chooses, so that any range or residue of ids holds every kind.
    """
    mixed = F.expr("(doc_id * 2654435761) % 4294967296 div 65536")
    kind, has_form = mixed % 4, F.floor(mixed / 4) % 5 == 0
    number, chars = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    day = (F.lit(1) + F.col("doc_id") % 28).cast("string")
    framed = F.concat(
        F.lit("Tender reference number: NPAS/2024/"), number,
        F.lit("\nNational Procurement Aggregation Service bulletin "), "source",
        F.lit(" name of work: "), "text", F.lit("\nEstimated value Rs. "), chars,
        F.lit(",000.50 lakh, due "), day, F.lit("-mar-2024.\n" + RULE + "\nDisclaimer: no offer."),
    )
    clause = F.concat(
        "text", F.lit("\nScope of work: INR 12,000 cr by 2023/1/9 under ref MC-"), number,
        F.lit(" and file 20240"), number, F.lit("."),
    )
    form = F.concat(
        F.lit("Preface.\nName of work: supply of goods and services to "), "lang",
        F.lit(" offices as listed in the annex of the call, in equal lots, by open bid, for Rupees "),
        chars, F.lit(" crore until "), day, F.lit("/apr/2024 under tn-"), number,
        F.lit(". State Procurement Cell form of the year, tender to be sent by post or by hand"),
    )
    again = F.concat(
        F.lit("State Procurement Cell sheet "), number, F.lit(". Scope of work for "), "source",
        F.lit("\n"), "text", F.lit("\n" + RULE + "\nDisclaimer: as given."),
    )
    heading = F.substring(F.substring_index("text", "\n", 1), 1, TITLE_CHARS)
    whole = F.struct(
        F.col("doc_id").alias("notice_id"), heading.alias("title"),
        F.when(kind == 0, framed).when(kind == 1, clause).when(kind == 2, again)
        .otherwise(F.col("text")).alias("body"),
    )
    letter = F.struct(
        (F.col("doc_id") + FORM_IDS).alias("notice_id"),
        F.concat(F.lit("Supply notice "), "lang").alias("title"), form.alias("body"),
    )
    each = F.when(has_form, F.array(whole, letter)).otherwise(F.array(whole))
    return table(spark, sf_dir, "documents").select(
        F.explode(each).alias("notice"), "source", "lang", "n_chars"
    ).select(
        "notice.notice_id", F.col("source").alias("portal_id"), "notice.title", "notice.body",
        "lang", "n_chars",
    )


def notice_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized tokens of each notice, as retrieval and evaluation use them."""
    return notices(spark, sf_dir).select(
        "notice_id", "portal_id", normalized(F.col("title"), F.col("body")).alias("tokens")
    )


def labelled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pairs: each notice with the first of its title, and with the next one.

    Equal titles with equal language and similar length are labelled `same`. One
    pair per notice and rule: a title shared by very many gives no pair explosion.
    """
    rows = notices(spark, sf_dir).select("notice_id", "title", "lang", "n_chars")
    firsts = rows.groupBy("title").agg(
        F.min_by(
            F.struct(
                F.col("notice_id").alias("first_id"),
                F.col("lang").alias("first_lang"),
                F.col("n_chars").alias("first_chars"),
            ),
            "notice_id",
        ).alias("first"),
        F.count("*").alias("copies"),
    )
    firsts = materialize(firsts.where("copies > 1").select("title", "first.*"), "titles")
    titled = lookup_join(
        rows, firsts, ["title"], "inner", F.col("notice_id") != F.col("first_id")
    )
    alike = (F.col("lang") == F.col("first_lang")) & (
        F.abs(F.col("n_chars") - F.col("first_chars")) * 5
        <= F.greatest("n_chars", "first_chars")
    )
    by_title = titled.select(
        F.col("first_id").alias("notice_id_a"),
        F.col("notice_id").alias("notice_id_b"),
        F.when(alike, "same").otherwise("different").alias("label"),
    )
    following = rows.select(
        (F.col("notice_id") - 1).alias("notice_id"),
        F.col("notice_id").alias("next_id"),
        F.col("title").alias("next_title"),
    )
    neighbours = (
        rows.join(following, "notice_id")
        .where("title != next_title")
        .select(
            F.col("notice_id").alias("notice_id_a"),
            F.col("next_id").alias("notice_id_b"),
            F.lit("different").alias("label"),
        )
    )
    return materialize(ordered_pairs(by_title.unionByName(neighbours)), "labelled-pairs")


def signed_notices(rows: DataFrame, family: LaneFamily) -> DataFrame:
    """(notice_id, signature) of (notice_id, tokens); null without 3-shingles."""
    return rows.select(
        "notice_id", signature(shingles(F.col("tokens"), 3), family).alias("signature")
    )


def signatures(rows: DataFrame, family: LaneFamily) -> DataFrame:
    """Stored :func:`signed_notices`."""
    return materialize(signed_notices(rows, family), "signatures")


def shingled_notices(
    rows: DataFrame, family: LaneFamily, widths: Sequence[int] = WIDTHS
) -> DataFrame:
    """Stored (notice_id, sets, signature) of (notice_id, tokens): texts are normalized and
    shingled once for exact scores and estimates. 3-shingles must be among the ``widths``.
    Lanes below 2^31 are integers, half the size."""
    cut = rows.select(
        "notice_id", *(shingles(F.col("tokens"), width).alias(f"w{width}") for width in widths)
    )
    lanes = signature(F.col("w3"), family)
    if family.modulus is not None and family.modulus <= 2**31:
        lanes = lanes.cast("array<int>")
    both = cut.select(
        "notice_id", shingle_sets(*(F.col(f"w{width}") for width in widths), widths=widths).alias("sets"),
        lanes.alias("signature"),
    )
    return materialize(both, "shingled-notices")


def bands(stored_signatures: DataFrame, rows: int, count: int) -> DataFrame:
    return materialize(band_rows(stored_signatures, rows, count), "bands")
