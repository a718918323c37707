"""The registered queries: each runs one operator group over the whole given tables."""

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake import datasets as data, schemas
from ledgerlake.functions import text
from ledgerlake.operators import candidates, evaluate, lsh, notice_index, quality
from ledgerlake.operators.landing import land
from ledgerlake.operators.minhash import (
    estimated_jaccard, portable_family, portable_wide_family, signature_size,
)
from ledgerlake.operators.ranking import ordered
from ledgerlake.plans import publish, reconcile, reload, reports, star, tables
from ledgerlake.session import materialize, shared_path
from ledgerlake.sources import lake, masters, tills
from ledgerlake.sources.notices import read_labelled_pairs, read_notices

Query = Callable[[SparkSession, str], DataFrame]

# The published operating point.
LANES = signature_size()
BAND_ROWS, BANDS = lsh.OPERATING_ROWS, LANES // lsh.OPERATING_ROWS
SWEEP = lsh.SWEEP
CAP = lsh.BUCKET_CAP
# Notices that probe the stored bands: the given share of all ids.
PROBE_EVERY = 20
# What the pruned queries ask for.
ONE_PARTITION = ("S01", 1996, 10)
ONE_PERIOD = (dt.date(1996, 11, 15), dt.date(1997, 2, 1))
ONE_MONTH = (dt.date(1996, 3, 1), dt.date(1996, 4, 1))
MARKERS = (" the ", " und ", " les ")
# Lines that reach the partial reload as re-sends: one store's year, some of its bills.
RESENT_FILES, RESENT_EVERY = "SALES_S02_1996", 7

_LINE = ("store_id", "business_date", "bill_no", "line_no", "product_code", "qty",
         "unit_price", "line_type", "ts", "year", "month")


def _round(*names: str):
    return {name: F.round(name, 6) for name in names}


# Retail -----------------------------------------------------------------------


def land_dedup_lines(spark, sf_dir):
    return data.landed_lines(spark, sf_dir)


def land_union_dialects(spark, sf_dir):
    return land(data.till_lines(spark, sf_dir))


def _write_exports(raw, folder, gathered=True):
    """``raw`` lines as export files of all three dialects, each named by its ``file``.

    Exports that are few and long are not ``gathered``: each task compresses its own part of
    an export, and no line moves.
    """
    for dialect in tills.DIALECTS:
        rows = data.dialect_slice(raw, dialect)
        if dialect is tills.EPOCH:
            first, *others = dialect.schema.fieldNames()
            # A byte-order mark before the first header name.
            rows = rows.withColumnRenamed(first, "\ufeff" + first)
        (
            (rows.repartition("file") if gathered else rows).withColumnRenamed("file", "export")
            .write.mode("append").partitionBy("export")
            .option("header", True).option("sep", dialect.separator)
            .option("compression", "none" if gathered else "gzip")
            .csv(folder)
        )


def dialect_round_trip(spark, sf_dir):
    """Write the lines as files of all three dialects, read and land them, and
    read the lake back. One file per store and month keeps the file count fixed."""
    folder = shared_path(spark, "tills")
    _write_exports(materialize(data.raw_lines(spark, sf_dir, files="month"), "raw-lines"), folder)
    lines = land(tills.read_tills(spark, folder, "export="))
    path = shared_path(spark, "lake")
    lake.write_lake(lines, path)
    return lake.read_lake(spark, path).select(*_LINE)


def partial_reload(spark, sf_dir):
    """Load exports without some lines, let these arrive as re-sends, reload what changed,
    and give the checksum of every partition."""
    folder, root = shared_path(spark, "tills"), shared_path(spark, "reloaded")
    raw = data.raw_lines(spark, sf_dir, files="year")
    held = F.col("file").startswith(RESENT_FILES) & (F.col("bill_no").cast("long") % RESENT_EVERY == 0)
    _write_exports(raw.where(~held), folder, gathered=False)
    reload.reload(spark, folder, root, "export=")
    resent = raw.where(held).withColumn("file", F.replace("file", F.lit(".csv"), F.lit("__R1.csv")))
    _write_exports(resent, folder, gathered=False)
    reload.reload(spark, folder, root, "export=")
    checksums = reload.partition_checksums(reload.read_reloaded(spark, root), quality.portable_row_hash)
    return checksums.withColumn("checksum", F.col("checksum").cast("string"))


def staged_publish(spark, sf_dir):
    """Publish the landing, publish it again, and read the log of both runs."""
    root = shared_path(spark, "published")
    lines = data.landed_lines(spark, sf_dir)
    publish.publish(lines, root)
    publish.publish(publish.read_current(spark, root), root)
    current = quality.table_checksum(
        publish.read_current(spark, root), row_hash=quality.portable_row_hash
    )
    log = publish.publish_log(spark, root).agg(
        F.count("*").alias("runs"),
        F.countDistinct("checksum").alias("checksums"),
        F.countDistinct("row_count").alias("row_counts"),
    )
    return log.select(
        "*",
        current.select("row_count").scalar().alias("row_count"),
        current.select(F.col("checksum").cast("string")).scalar().alias("checksum"),
    )


def land_counts(spark, sf_dir):
    return quality.landed_counts(data.landed_lines(spark, sf_dir))


def row_checksum(spark, sf_dir):
    checksum = quality.table_checksum(
        data.landed_lines(spark, sf_dir), row_hash=quality.portable_row_hash
    )
    return checksum.withColumn("checksum", F.col("checksum").cast("string"))


def partition_revenue(spark, sf_dir):
    return reports.partition_revenue(data.landed_lines(spark, sf_dir))


def daily_store_revenue(spark, sf_dir):
    return reports.daily_revenue(data.landed_lines(spark, sf_dir))


def dim_date(spark, sf_dir):
    return data.dim_date(spark, sf_dir)


def dim_surrogate_key(spark, sf_dir):
    stores = data.dim_store(spark, sf_dir).select(
        F.lit("store").alias("dimension"), F.col("store_key").alias("surrogate_key"),
        F.col("store_id").alias("natural_key"), F.col("city").alias("attribute"),
    )
    return stores.unionByName(
        data.dim_category(spark, sf_dir).select(
            F.lit("category").alias("dimension"), F.col("category_key").alias("surrogate_key"),
            F.col("category_id").alias("natural_key"), F.col("department").alias("attribute"),
        )
    )


def dim_product(spark, sf_dir):
    return data.dim_product(spark, sf_dir)


def product_validity_join(spark, sf_dir):
    products = data.dim_product(spark, sf_dir)
    resolved = star.resolve_products(
        data.landed_lines(spark, sf_dir), products, data.line_codes(spark, sf_dir)
    )
    return resolved.select(
        "bill_no", "line_no", "business_date", "product_code", "product_key", "category_key"
    )


def fact_sales_line(spark, sf_dir):
    """The fact without its hash key, whose values no other engine shares."""
    return data.fact(spark, sf_dir).drop("sales_line_key").withColumn(
        "revenue_amount", F.col("revenue_amount").cast("decimal(38,5)")
    )


def dashboard_revenue(spark, sf_dir):
    built = data.star_schema(spark, sf_dir)
    return reports.dashboard_revenue(
        built.fact, built.store, built.product, built.category,
        materialize(data.dim_date(spark, sf_dir), "dim-date"),
    )


def fact_integrity(spark, sf_dir):
    return quality.fact_integrity(data.fact(spark, sf_dir))


def fact_line_keys(spark, sf_dir):
    """Whether the fact's hash key names one landed line each."""
    return quality.key_uniqueness(data.fact(spark, sf_dir), "sales_line_key", schemas.LINE_KEY)


def stored_star(spark, sf_dir):
    """The star saved as catalog tables, the fact replaced by a later load, and queried
    with SQL through a temporary view."""
    built, suffix = data.star_schema(spark, sf_dir), uuid.uuid4().hex
    fact, store, product = (f"{name}_{suffix}" for name in ("fact_sales_line", "dim_store", "dim_product"))
    # Both loads take the fact from one stored copy.
    lines = materialize(built.fact, "fact")
    tables.save_tables({fact: lines.where("is_revenue"), store: built.store, product: built.product})
    tables.save_tables({fact: lines})
    spark.table(fact).createOrReplaceTempView(f"lines_{suffix}")
    return spark.sql(f"""
        SELECT s.store_id, year(p.valid_from) AS version_year, count(*) AS lines,
               count_if(f.is_revenue) AS revenue_lines,
               CAST(sum(f.revenue_amount) AS DECIMAL(38, 2)) AS revenue
        FROM lines_{suffix} f JOIN {store} s ON f.store_key = s.store_key
        LEFT JOIN {product} p ON f.product_key = p.product_key
        GROUP BY ALL""")


def reissued_codes(spark, sf_dir):
    return quality.reissued_codes(data.dim_product(spark, sf_dir))


def table_counts(spark, sf_dir):
    built = data.star_schema(spark, sf_dir)
    return quality.table_counts({
        "dim_date": data.dim_date(spark, sf_dir), "dim_store": built.store,
        "dim_category": built.category, "dim_product": built.product, "fact_sales_line": built.fact,
    })


def master_checks(spark, sf_dir):
    return quality.master_violations(data.masters(spark, sf_dir))


def historical_price_report(spark, sf_dir):
    """Every calendar month of the given years, in one pass."""
    days = materialize(data.dim_date(spark, sf_dir), "dim-date")
    months = days.where(F.dayofmonth("calendar_date") == 1)
    periods = months.select(
        F.col("calendar_date").alias("period_start"),
        F.add_months("calendar_date", 1).alias("period_stop"),
    )
    return reports.historical_prices(
        data.fact(spark, sf_dir), data.price_revisions(spark, sf_dir), periods
    )


def federated_category_revenue(spark, sf_dir):
    given = data.masters(spark, sf_dir)
    return reports.federated_revenue(
        data.landed_lines(spark, sf_dir), given["stores"], given["products"],
        given["product_categories"],
    )


def federated_report_ordered(spark, sf_dir):
    """The report in its printing order, written and read back with its positions."""
    return ordered(federated_category_revenue(spark, sf_dir), reports.category_and_product())


def finance_reconciliation(spark, sf_dir):
    lines = materialize(data.landed_lines(spark, sf_dir), "landed")
    pipeline = reconcile.monthly_revenue(data.fact(spark, sf_dir, data.missing_exports(lines)))
    return reconcile.reconcile(
        pipeline, data.finance(spark, sf_dir, lines), data.known_differences(spark)
    )


# Files and pruned scans -------------------------------------------------------


def _stored_lake(spark, sf_dir):
    path = shared_path(spark, "lake")
    lake.write_lake(data.landed_lines(spark, sf_dir), path)
    return lake.read_lake(spark, path)


def pruned_partition_revenue(spark, sf_dir):
    """One store and month of a written lake; the partition filters reach the scan."""
    return reports.daily_revenue(_stored_lake(spark, sf_dir), lake.in_partition(*ONE_PARTITION))


def store_period_revenue(spark, sf_dir):
    """One store and a range of days of a written lake."""
    wanted = (F.col("store_id") == ONE_PARTITION[0]) & lake.in_period(*ONE_PERIOD)
    return reports.daily_revenue(_stored_lake(spark, sf_dir), wanted)


def federated_lake_revenue(spark, sf_dir):
    """One partition of a written lake, joined to stored master tables."""
    folder = shared_path(spark, "masters")
    for name, rows in data.masters(spark, sf_dir).items():
        rows.write.parquet(f"{folder}/{name}")
    stores, products, categories = (
        masters.read_master(spark, name, path=folder)
        for name in ("stores", "products", "product_categories")
    )
    return reports.federated_revenue(
        _stored_lake(spark, sf_dir), stores, products, categories,
        lake.in_partition(*ONE_PARTITION),
    )


def price_function_sql(spark, sf_dir):
    """The price report of one month, called as a SQL table function."""
    fact = materialize(data.fact(spark, sf_dir), "fact")
    reports.register_price_function(fact, data.price_revisions(spark, sf_dir))
    return spark.sql(
        f"SELECT * FROM historical_price_report(DATE '{ONE_MONTH[0]}', DATE '{ONE_MONTH[1]}')"
    )


def finance_file(spark, sf_dir):
    """Finance's months as a result CSV, read back in its declared types."""
    path = shared_path(spark, "finance")
    signed = data.finance(spark, sf_dir).select(
        "month", F.last_day(F.to_date("month", "yyyy-MM")).alias("closed_on"), "revenue_inr",
        F.lit("finance").alias("signed_off_by"),
    )
    publish.write_result_csv(signed, path)
    return masters.read_finance(spark, path)


def label_file(spark, sf_dir):
    """Labelled pairs as a CSV, read back with the smaller id first."""
    path = shared_path(spark, "labels")
    named = lambda side: F.concat(F.lit("N"), F.lpad(F.col(side).cast("string"), 12, "0"))
    pairs = data.labelled_pairs(spark, sf_dir).select(
        named("notice_id_b").alias("notice_id_a"), named("notice_id_a").alias("notice_id_b"), "label"
    )
    pairs.write.option("header", True).csv(path)
    return read_labelled_pairs(spark, path)


def notice_shards(spark, sf_dir):
    """Notices in two CSV shards, the second with new titles for some: the later row wins."""
    folder = shared_path(spark, "shards")
    rows = data.notices(spark, sf_dir).select(
        F.col("notice_id").cast("string").alias("notice_id"), "portal_id", "title", "body",
        F.lit("2024-01-01").alias("published_at"),
        F.col("n_chars").cast("string").alias("estimated_value"),
    )
    revised = rows.where(F.col("notice_id").cast("long") % 10 == 0).withColumn(
        "title", F.concat(F.lit("Corrected: "), "title")
    )
    for number, shard in enumerate((rows, revised)):
        (
            shard.write.option("header", True).option("escape", '"').option("quoteAll", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/{number}")
        )
    found = read_notices(spark, [f"{folder}/0", f"{folder}/1"])
    return found.select(
        F.col("notice_id").cast("long").alias("notice_id"), "portal_id",
        F.md5("title").alias("title_md5"), F.md5("body").alias("body_md5"),
    )


def manifest_checksum(spark, sf_dir):
    """Count and checksum of the unpartitioned snapshot, read back."""
    path = shared_path(spark, "manifest")
    lake.write_manifest(data.landed_lines(spark, sf_dir), path)
    checksum = quality.table_checksum(
        spark.read.parquet(path), row_hash=quality.portable_row_hash
    )
    return checksum.withColumn("checksum", F.col("checksum").cast("string"))


# Near-duplicate notices -------------------------------------------------------


def normalized_tokens(spark, sf_dir):
    rows = data.notices(spark, sf_dir).select(
        "notice_id", text.notice_tokens(F.col("title"), F.col("body")).alias("tokens")
    )
    return rows.select(
        "notice_id",
        F.size("tokens").cast("bigint").alias("token_count"),
        F.md5(F.concat_ws(" ", "tokens")).alias("token_md5"),
    )


def marker_slice_tokens(spark, sf_dir):
    title, body = F.col("title"), F.col("body")
    rows = data.notices(spark, sf_dir).select(
        "notice_id",
        text.content_start(body, MARKERS).cast("bigint").alias("content_start"),
        text.notice_tokens(title, body, MARKERS, tokenize=text.tokens).alias("tokens"),
    )
    return rows.select(
        "notice_id", "content_start",
        F.size("tokens").cast("bigint").alias("token_count"),
        F.md5(F.concat_ws(" ", "tokens")).alias("token_md5"),
    )


def shingle_sets(spark, sf_dir):
    tokens = F.col("tokens")
    rows = data.notice_tokens(spark, sf_dir).select(
        "notice_id", text.shingles(tokens, 1).alias("one"), text.shingles(tokens, 3).alias("three")
    )
    return rows.select(
        "notice_id",
        F.size("one").cast("bigint").alias("unigrams"),
        F.size("three").cast("bigint").alias("shingles"),
        F.md5(F.concat_ws("|", F.sort_array("three"))).alias("shingle_md5"),
    )


def avg_shingles(spark, sf_dir):
    return evaluate.average_shingles(data.notice_tokens(spark, sf_dir)).withColumns(
        _round("average_unigrams", "average_3_shingles")
    )


def _scored(spark, sf_dir):
    return evaluate.score_pairs(
        data.labelled_pairs(spark, sf_dir), data.notice_tokens(spark, sf_dir)
    )


def pair_jaccard(spark, sf_dir):
    return _scored(spark, sf_dir).withColumns(_round("jaccard_1", "jaccard_3"))


def conservative_threshold(spark, sf_dir):
    return evaluate.conservative_threshold(_scored(spark, sf_dir)).withColumns(
        _round("threshold", "same_recall")
    )


def example_pairs(spark, sf_dir):
    return evaluate.example_pairs(_scored(spark, sf_dir)).withColumns(
        _round("jaccard_1", "jaccard_3")
    )


def _signatures(spark, sf_dir):
    return data.signatures(data.notice_tokens(spark, sf_dir), portable_family(LANES))


def _signed(spark, sf_dir, family=None):
    """Signatures that are not stored, for steps that read them once."""
    return data.signed_notices(data.notice_tokens(spark, sf_dir), family or portable_family(LANES))


def _hashed(spark, sf_dir, family=None):
    """Class and band hashes of each notice, stored in place of signatures and bands."""
    return lsh.hashed_notices(_signed(spark, sf_dir, family), BAND_ROWS, BANDS)


def _bands(spark, sf_dir):
    return lsh.hashed_bands(_hashed(spark, sf_dir))


def minhash_md5_signature(spark, sf_dir):
    return _signatures(spark, sf_dir).where("signature is not null").select(
        "notice_id", F.concat_ws("-", F.col("signature").cast("array<string>")).alias("signature")
    )


def _wide_signatures(spark, sf_dir):
    return data.signatures(data.notice_tokens(spark, sf_dir), portable_wide_family())


def minhash_signature(spark, sf_dir):
    """Signatures of wrapping 64-bit lanes; a notice too short for one shows as null. They
    are read once and six kilobytes each, so only the result is written."""
    return _signed(spark, sf_dir, portable_wide_family()).select(
        "notice_id",
        F.when(
            F.col("signature").isNotNull(),
            F.concat_ws("-", F.col("signature").cast("array<string>")),
        ).alias("signature"),
    )


def near_duplicate_candidates(spark, sf_dir):
    """Pairs left after buckets above the cap are suppressed: not all candidates.

    ``near_duplicate_members`` and ``near_duplicate_buckets`` have all of them, on the
    same signatures.
    """
    hashed = _hashed(spark, sf_dir, portable_wide_family())
    return lsh.suppressed_pairs(lsh.hashed_bands(hashed), CAP)


def near_duplicate_members(spark, sf_dir):
    """The content class of each notice: with the buckets, all candidates unsuppressed."""
    return lsh.stored_classes(_signed(spark, sf_dir, portable_wide_family()))


def near_duplicate_buckets(spark, sf_dir):
    """Every bucket of two classes or more, one row per class in it."""
    signed = _signed(spark, sf_dir, portable_wide_family())
    return _as_text(lsh.candidate_buckets(signed, BAND_ROWS, BANDS))


def candidate_members(spark, sf_dir):
    """The content class of each notice: with the buckets, all candidates unsuppressed."""
    return lsh.stored_classes(_signed(spark, sf_dir))


def candidate_buckets(spark, sf_dir):
    """Every bucket of two classes or more, one row per class in it."""
    return _as_text(lsh.candidate_buckets(_signed(spark, sf_dir), BAND_ROWS, BANDS))


def _estimates(spark, sf_dir, pairs):
    signed = _signatures(spark, sf_dir)
    both = evaluate.attach_both(pairs, signed, "signature", 1_000)
    return both.select(
        *evaluate.PAIR,
        estimated_jaccard(F.col("left_signature"), F.col("right_signature"), LANES)
        .alias("minhash_estimate"),
    )


def minhash_estimate(spark, sf_dir):
    pairs = data.labelled_pairs(spark, sf_dir)
    return _estimates(spark, sf_dir, pairs).withColumns(_round("minhash_estimate"))


def _errors(spark, sf_dir):
    pairs = data.labelled_pairs(spark, sf_dir)
    # Single tokens are not asked for.
    shingled = data.shingled_notices(data.notice_tokens(spark, sf_dir), portable_family(LANES), (3,))
    both = evaluate.score_and_estimate(pairs, shingled, LANES, widths=(3,))
    both = materialize(both.select(*evaluate.PAIR, "jaccard_3", "minhash_estimate"), "pair-scores")
    errors = evaluate.estimator_errors(
        both.drop("minhash_estimate"), both.select(*evaluate.PAIR, "minhash_estimate")
    )
    return materialize(errors, "pair-errors")


def pair_errors(spark, sf_dir):
    return _errors(spark, sf_dir).withColumns(
        _round("exact_jaccard", "minhash_estimate", "absolute_error")
    )


def estimator_error(spark, sf_dir):
    return evaluate.error_summary(_errors(spark, sf_dir)).withColumns(
        _round("mean_error", "p95_error", "max_error", "share_within")
    )


def _as_text(bands):
    return bands.withColumn("band_hash", F.lower(F.hex("band_hash")))


def lsh_bands(spark, sf_dir):
    return _as_text(_bands(spark, sf_dir))


def bucket_cap(spark, sf_dir):
    return _as_text(lsh.suppress_oversized(_bands(spark, sf_dir), CAP))


def lsh_candidates(spark, sf_dir):
    """Pairs after suppression; ``candidate_buckets`` has what is suppressed as well."""
    return lsh.suppressed_pairs(_bands(spark, sf_dir), CAP)


def probe_candidates(spark, sf_dir):
    """All candidates of every notice whose id is divisible by ``PROBE_EVERY``."""
    return lsh.probe_hashed(_hashed(spark, sf_dir), F.col("notice_id") % PROBE_EVERY == 0)


def build_notice_index(spark, sf_dir, signed=None):
    """The stored index of all notices, under a name of its own."""
    signed = _signed(spark, sf_dir) if signed is None else signed
    return notice_index.build_index(signed, f"notices_{uuid.uuid4().hex}", BAND_ROWS, BANDS)


def index_probes(signed):
    return signed.where(F.col("notice_id") % PROBE_EVERY == 0).withColumnRenamed("notice_id", "probe_id")


def index_build(spark, sf_dir):
    """Rows and keys of the stored index."""
    index = build_notice_index(spark, sf_dir)
    members, bands, hot = (index.table(spark, part) for part in ("members", "bands", "hot"))
    return members.agg(
        F.lit("members").alias("table"), F.count("*").alias("rows"), F.countDistinct("class_id").alias("keys")
    ).unionByName(
        bands.unionByName(hot).agg(
            F.lit("bands").alias("table"), F.count("*").alias("rows"), F.countDistinct("band_key").alias("keys")
        )
    )


def index_probe(spark, sf_dir):
    """Candidates, by content class, of every notice whose id is divisible by
    ``PROBE_EVERY``, looked up in the stored index."""
    signed = _signatures(spark, sf_dir)
    index = build_notice_index(spark, sf_dir, signed)
    return notice_index.lookup(spark, index, index_probes(signed))


def bucket_work_sweep(spark, sf_dir):
    return lsh.sweep_work(_signed(spark, sf_dir), SWEEP).withColumns(_round("average_work"))


def _load(spark, sf_dir, hashed=None):
    hashed = _hashed(spark, sf_dir) if hashed is None else hashed
    return candidates.candidate_load(
        data.notices(spark, sf_dir), lsh.hashed_bands(hashed), candidates.distinct_of_hashed(hashed), CAP
    )


def _rounded_stats(stats):
    return stats.withColumns(_round("average_work", "average_candidates", "p95_candidates"))


def candidate_stats(spark, sf_dir):
    return _rounded_stats(candidates.candidate_stats(_load(spark, sf_dir)))


def candidate_counts(spark, sf_dir):
    """Load of every notice, with all buckets and after suppression."""
    return _load(spark, sf_dir)


def source_candidate_load(spark, sf_dir):
    return candidates.portal_load(_load(spark, sf_dir)).withColumns(_round("share"))


def portal_load_ordered(spark, sf_dir):
    """Portals by their work after suppression, written and read back with positions."""
    load = candidates.portal_load(_load(spark, sf_dir)).where("stage = 'after'")
    return ordered(load.withColumns(_round("share")), candidates.heaviest_first())


def hottest_documents(spark, sf_dir):
    return candidates.hottest_notices(_load(spark, sf_dir))


def _survived(pairs, hashed):
    return evaluate.survival_of_hashed(pairs, hashed, lsh.hashed_bands(hashed), CAP)


def mitigation_compare(spark, sf_dir):
    hashed = _hashed(spark, sf_dir)
    stats = candidates.candidate_stats(_load(spark, sf_dir, hashed))
    survived = _survived(data.labelled_pairs(spark, sf_dir), hashed)
    return _rounded_stats(evaluate.mitigation_report(stats, survived))


def labelled_survival(spark, sf_dir):
    survived = _survived(data.labelled_pairs(spark, sf_dir), _hashed(spark, sf_dir))
    return evaluate.survival_by_label(survived).withColumns(_round("survival"))


def survival_by_bin(spark, sf_dir):
    pairs = data.labelled_pairs(spark, sf_dir)
    binned = evaluate.survival_by_bin(
        evaluate.score_pairs(pairs, data.notice_tokens(spark, sf_dir)),
        _survived(pairs, _hashed(spark, sf_dir)), BAND_ROWS, BANDS,
    )
    return binned.withColumns(
        _round("similarity_low", "similarity_high", "observed_survival_probability",
               "theoretical_survival")
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        land_dedup_lines, land_union_dialects, dialect_round_trip, staged_publish, land_counts,
        row_checksum, partition_revenue, daily_store_revenue, dim_date, dim_surrogate_key,
        dim_product, product_validity_join, fact_sales_line, dashboard_revenue, fact_integrity,
        fact_line_keys, stored_star, reissued_codes, table_counts, master_checks, historical_price_report,
        federated_category_revenue, federated_report_ordered, portal_load_ordered, partial_reload,
        finance_reconciliation, pruned_partition_revenue,
        store_period_revenue, federated_lake_revenue, price_function_sql, finance_file,
        label_file, notice_shards, manifest_checksum, normalized_tokens,
        marker_slice_tokens, shingle_sets, avg_shingles, pair_jaccard, conservative_threshold,
        example_pairs, minhash_md5_signature, minhash_signature, near_duplicate_candidates,
        near_duplicate_members, near_duplicate_buckets, candidate_members, candidate_buckets,
        minhash_estimate, pair_errors, estimator_error, lsh_bands, bucket_cap, lsh_candidates,
        probe_candidates, index_build, index_probe, bucket_work_sweep, candidate_stats, candidate_counts,
        source_candidate_load, hottest_documents, mitigation_compare, labelled_survival,
        survival_by_bin,
    )
}
