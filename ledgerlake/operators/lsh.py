"""Locality-sensitive hashing: bands, buckets and candidate pairs.

A notice's signature is cut into bands; two notices that agree on a whole band
share a bucket and are candidates. Functions that read a band table more than
once expect a stored one (see ``session.materialize``).
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.operators.percentiles import percentiles
from ledgerlake.operators.skew import (
    HOT_KEYS, HOT_ROWS, TASK_PAIRS, lookup_join, shared_rows, split_join, with_group_size,
)
from ledgerlake.session import materialize

BUCKET = ("band_no", "band_hash")
BUCKET_CAP = 100
OPERATING_ROWS = 9
SWEEP = ((3, 246), (6, 123), (9, 82), (18, 41))


def band_hashes(signature: Column, rows: int, bands: int) -> Column:
    """Array of one 128-bit hash per band of ``rows`` lanes."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.unhex(
            F.md5(F.concat_ws("-", F.slice(signature, band * rows + 1, rows).cast("array<string>")))
        ),
    )


def band_rows(signatures: DataFrame, rows: int, bands: int) -> DataFrame:
    """(notice_id, band_no, band_hash) for each notice that has a signature."""
    return signatures.where(F.col("signature").isNotNull()).select(
        "notice_id",
        F.posexplode(band_hashes(F.col("signature"), rows, bands)).alias("band_no", "band_hash"),
    )


def hashed_notices(signatures: DataFrame, rows: int, bands: int) -> DataFrame:
    """Stored ``(notice_id, class_id, hashes)``: the content class and band hashes of each
    notice, null without signature. A third of the signatures' size, and all that buckets need."""
    signed = F.col("signature").isNotNull()
    return materialize(signatures.select(
        "notice_id", F.when(signed, signature_class()).alias("class_id"),
        F.when(signed, band_hashes(F.col("signature"), rows, bands)).alias("hashes"),
    ), "hashed-notices")


def hashed_bands(hashed: DataFrame) -> DataFrame:
    """The rows of :func:`band_rows`, from :func:`hashed_notices`."""
    return hashed.where(F.col("hashes").isNotNull()).select(
        "notice_id", F.posexplode("hashes").alias("band_no", "band_hash")
    )


def bucket_sizes(bands: DataFrame) -> DataFrame:
    return bands.groupBy(*BUCKET).agg(F.count("*").alias("bucket_size"))


def sized_rows(bands: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Band rows with the size of their bucket."""
    return with_group_size(bands, BUCKET, "bucket_size", hot_rows)


def suppress_oversized(
    bands: DataFrame, cap: int = BUCKET_CAP, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Band rows without the buckets of more than ``cap`` notices.

    Only those buckets are joined back. Reads ``bands`` twice.
    """
    large = materialize(bucket_sizes(bands).where(F.col("bucket_size") > cap), "large-buckets")
    hot = large.where(F.col("bucket_size") > hot_rows).orderBy(F.desc("bucket_size"), *BUCKET).limit(HOT_KEYS)
    return lookup_join(bands, large, BUCKET, "left_anti", hot_rows=hot_rows, hot=hot)


def content_classes(signatures: DataFrame) -> DataFrame:
    """(notice_id, class_id): notices with equal signatures, copies above all, are a class.

    The class is named by a hash of the signature, so nothing is gathered or joined.
    """
    signed = signatures.where(F.col("signature").isNotNull())
    return signed.select("notice_id", signature_class().alias("class_id"))


def stored_classes(signatures: DataFrame) -> DataFrame:
    """Stored :func:`content_classes` of signatures that are read once: these are not stored."""
    signed = F.col("signature").isNotNull()
    named = materialize(
        signatures.select("notice_id", F.when(signed, signature_class()).alias("class_id")), "members"
    )
    return named.where(F.col("class_id").isNotNull())


def signature_class() -> Column:
    return F.md5(F.concat_ws("-", F.col("signature").cast("array<string>")))


def candidate_buckets(
    signatures: DataFrame, rows: int, bands: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All candidates in factorized form: (band_no, band_hash, class_id, bucket_classes).

    Two notices are candidates if they share a class (:func:`content_classes`) or
    their classes share a bucket listed here. Nothing is suppressed, and the table
    grows with the classes: a bucket of n classes is n rows, not n squared pairs.
    """
    classes = materialize(hashed_classes(hashed_notices(signatures, rows, bands)), "classes")
    class_bands = classes.select("class_id", F.posexplode("hashes").alias("band_no", "band_hash"))
    return shared_rows(class_bands, BUCKET, "bucket_classes", hot_rows)


def hashed_classes(hashed: DataFrame) -> DataFrame:
    """``(class_id, hashes, notices)`` of :func:`hashed_notices`."""
    return hashed.where(F.col("hashes").isNotNull()).groupBy("class_id").agg(
        F.any_value("hashes").alias("hashes"), F.count("*").alias("notices")
    )


def pairs_within(sized: DataFrame, cap: int) -> DataFrame:
    """Distinct pairs that share a bucket of at most ``cap`` notices, a < b.

    The cap bounds both the list per bucket and the pairs made from it: this is what
    is left after suppression. :func:`candidate_buckets` has all candidates. Notices that
    are near duplicates share many buckets of the same members, which are listed once.
    """
    buckets = (
        sized.where(F.col("bucket_size").between(2, cap))
        .groupBy(*BUCKET)
        .agg(F.sort_array(F.collect_list("notice_id")).alias("ids"))
        .select("ids").distinct()
    )
    firsts = buckets.select("ids", F.posexplode("ids").alias("at", "notice_id_a"))
    return firsts.select(
        "notice_id_a",
        F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("notice_id_b"),
    ).distinct()


def suppressed_pairs(bands: DataFrame, cap: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Candidate pairs that are left after buckets above ``cap`` are suppressed."""
    return pairs_within(shared_rows(bands, BUCKET, "bucket_size", hot_rows), cap)


def probe_candidates(
    probes: DataFrame, bands: DataFrame, max_broadcast_rows: int = 100_000,
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """All candidates of each probe notice, itself left out, one row per pair.

    ``probes`` are band rows of the probe notices; many probes share one pass, and a bucket
    that holds many of both sides is split on both. Where copies are many,
    ``notice_index.lookup`` gives the same candidates by content class.
    """
    wanted = probes.select(F.col("notice_id").alias("probe_id"), *BUCKET)
    found = split_join(
        bands, wanted, BUCKET, F.col("notice_id") != F.col("probe_id"), None,
        max_broadcast_rows, task_pairs,
    )
    return found.select("probe_id", "notice_id").distinct()


def probe_hashed(
    hashed: DataFrame, is_probe: Column, hot_rows: int = HOT_ROWS,
    max_broadcast_rows: int = 100_000, task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """The rows of :func:`probe_candidates` for the notices that ``is_probe`` (a condition
    on ``notice_id``) names, from :func:`hashed_notices`.

    Classes meet in buckets, each two of them once, and only the result is expanded to
    notices: copies are neither joined once per band nor made distinct as pairs.
    """
    classes = materialize(
        hashed_classes(hashed).withColumn("class_no", F.monotonically_increasing_id()), "classes"
    )
    members = materialize(
        lookup_join(
            hashed.where(F.col("class_id").isNotNull()).select("notice_id", "class_id"),
            classes.select("class_id", "class_no"), ["class_id"], "inner",
        ).select("notice_id", "class_no").distinct(), "members",
    )
    probes = materialize(
        members.where(is_probe).select(F.col("notice_id").alias("probe_id"), F.col("class_no").alias("probe_no")),
        "probes",
    )
    asked = materialize(probes.select("probe_no").distinct(), "probe-classes")
    keyed = classes.select("class_no", F.posexplode("hashes").alias("band_no", "band_hash"))
    shared = materialize(shared_rows(keyed, BUCKET, "bucket_classes", hot_rows), "shared-bands")
    probed = lookup_join(
        shared.select(F.col("class_no").alias("probe_no"), *BUCKET), asked, ["probe_no"], "left_semi"
    )
    both = split_join(
        shared.select("class_no", *BUCKET), probed, BUCKET, F.col("class_no") != F.col("probe_no"), None,
        max_broadcast_rows, task_pairs,
    )
    own = asked.select("probe_no", F.col("probe_no").alias("class_no"))
    met = materialize(both.select("probe_no", "class_no").distinct().unionByName(own), "met-classes")
    named = materialize(
        split_join(probes, met, ["probe_no"], None, None, max_broadcast_rows, task_pairs)
        .select("probe_id", "class_no"), "probe-classes-met",
    )
    found = split_join(
        named, members, ["class_no"], F.col("notice_id") != F.col("probe_id"), None,
        max_broadcast_rows, task_pairs,
    ).select("probe_id", "notice_id")
    # Only an id that several classes hold can give a pair twice.
    repeated = members.groupBy("notice_id").agg(F.count("*").alias("n")).where("n > 1")
    return found if repeated.isEmpty() else found.distinct()


def nested_band_hashes(
    signed: DataFrame, configurations: Sequence[tuple[int, int]] = SWEEP
) -> DataFrame:
    """``signed`` with one array of band hashes ``hashes_<rows>`` per (rows, bands) setting.

    A hash tree: a band that consists of whole bands of a narrower setting is hashed from
    their hashes, so nested settings read each lane once. Bands are equal if and only if
    their lanes are, as with :func:`band_hashes`.
    """
    done: list[tuple[int, int]] = []
    for rows, bands in sorted(configurations):
        inner = [r for r, n in done if rows % r == 0 and n * r >= rows * bands]
        if inner:
            times, children = rows // inner[-1], F.col(_hashes(inner[-1]))
            hashes = F.transform(
                F.sequence(F.lit(0), F.lit(bands - 1)),
                lambda band: F.unhex(F.md5(F.concat(
                    *(F.get(children, band * times + at) for at in range(times))
                ))),
            )
        else:
            hashes = band_hashes(F.col("signature"), rows, bands)
        signed = signed.withColumn(_hashes(rows), hashes)
        done.append((rows, bands))
    return signed


def _hashes(rows: int) -> str:
    return f"hashes_{rows}"


def _named_bands(rows: int) -> Column:
    """The band hashes of a setting as an array of (band_rows, band_no, band_hash)."""
    return F.transform(_hashes(rows), lambda band, at: F.struct(
        F.lit(rows).alias("band_rows"), at.alias("band_no"), band.alias("band_hash")
    ))


def _band_rows_of(
    hashed: DataFrame, configurations: Sequence[tuple[int, int]], *names: str
) -> DataFrame:
    """One row per setting and band of :func:`nested_band_hashes`, with columns ``names``."""
    settings = F.array(*(
        F.struct(F.lit(rows).alias("band_rows"), F.col(_hashes(rows)).alias("hashes"))
        for rows, _ in configurations
    ))
    return hashed.select(*names, F.explode(settings).alias("setting")).select(
        *names, F.col("setting.band_rows").alias("band_rows"),
        F.posexplode("setting.hashes").alias("band_no", "band_hash"),
    )


def bands_of_configurations(
    signatures: DataFrame, configurations: Sequence[tuple[int, int]] = SWEEP
) -> DataFrame:
    """Band rows of several (rows, bands) settings in one table."""
    signed = signatures.where(F.col("signature").isNotNull())
    return _band_rows_of(nested_band_hashes(signed, configurations), configurations, "notice_id")


def sweep_work(
    signatures: DataFrame, configurations: Sequence[tuple[int, int]] = SWEEP,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`bucket_work` of several settings, from signatures that are read once.

    Equal signatures are one class with a number of copies. Only the bands of settings that
    nest in no other are shuffled, once, and sized there; rows of buckets with two classes or
    more are kept. A band of whole bands of a narrower setting can only be shared where all of
    these are, so wider settings are hashed (:func:`nested_band_hashes`) and counted from the
    rows kept. A bucket is a sorted run, never a list. No signature gives no row.
    """
    settings = sorted(configurations)
    roots = [(rows, bands) for rows, bands in settings if not _inner(settings, rows, bands)]
    signed = signatures.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.when(F.col("signature").isNotNull(), signature_class()).alias("class_id"), "signature",
    )
    # Filtered after its aggregation: a filter on the signature itself would make it twice.
    classes = signed.groupBy("class_id").agg(
        F.min("row_no").alias("class_no"), F.any_value("signature").alias("signature"),
        F.count("*").alias("copies"),
    ).where(F.col("signature").isNotNull())
    # One array per class: a generator of its own for each setting would copy the hashes for each band.
    bands = nested_band_hashes(classes, roots).select(
        "class_no", "copies", F.inline(F.concat(*(_named_bands(rows) for rows, _ in roots)))
    )
    bucket = Window.partitionBy("band_rows", *BUCKET)
    sized = bands.withColumns({
        "bucket_size": F.sum("copies").over(bucket), "n": F.count("*").over(bucket),
    })
    # The first band of a class tells its copies, shared or not.
    named = (F.col("band_rows") == roots[0][0]) & (F.col("band_no") == 0)
    stored = materialize(sized.where((F.col("n") > 1) | named), "shared-bands")
    shared = {rows: stored.where((F.col("n") > 1) & (F.col("band_rows") == rows)).drop("n") for rows, _ in roots}
    for rows, count in settings:
        inner = _inner(settings, rows, count)
        if inner:
            wider = _wider_bands(shared[inner[-1]], rows // inner[-1], count)
            shared[rows] = _counted_classes(wider, rows, hot_rows)
    work = None
    for rows, count in settings:
        one = shared[rows].where(F.col("band_no") < count).select(
            "band_rows", "class_no", (F.col("bucket_size") - F.col("copies")).alias("others")
        )
        work = one if work is None else work.unionByName(one)
    work = work.groupBy("band_rows", "class_no").agg(F.sum("others").alias("others"))
    each = F.array(*(
        F.struct(F.lit(rows).alias("band_rows"), F.lit(count).cast("long").alias("bands"))
        for rows, count in configurations
    ))
    per_class = lookup_join(
        stored.where(named).select("class_no", "copies", F.inline(each)), materialize(work, "class-work"),
        ["band_rows", "class_no"], hot_rows=hot_rows, spread_by=["class_no"],
    )
    own = F.col("bands") * (F.col("copies") - 1)
    per_notice = per_class.withColumn("work", F.coalesce("others", F.lit(0)) + own).select(
        "band_rows", "bands", "work", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    )
    return _work_totals(materialize(per_notice.drop("copy"), "bucket-work"))


def _inner(settings: Sequence[tuple[int, int]], rows: int, bands: int) -> list[int]:
    """Band rows of the narrower settings whose whole bands make up these bands."""
    return [r for r, n in sorted(settings) if r < rows and rows % r == 0 and n * r >= rows * bands]


def _wider_bands(shared: DataFrame, times: int, bands: int) -> DataFrame:
    """Rows ``(class_no, copies, band_no, band_hash)`` of bands that hold ``times`` shared ones."""
    wide = F.floor(F.col("band_no") / times).cast("int")
    parts = F.sort_array(F.collect_list(F.struct("band_no", "band_hash")))
    whole = shared.groupBy("class_no", "copies", wide.alias("wide_no")).agg(parts.alias("parts")).where(
        (F.size("parts") == times) & (F.col("wide_no") < bands)
    )
    children = F.concat(*(F.get("parts", F.lit(at))["band_hash"] for at in range(times)))
    return whole.select(
        "class_no", "copies", F.col("wide_no").alias("band_no"), F.unhex(F.md5(children)).alias("band_hash")
    )


def _counted_classes(bands: DataFrame, rows: int, hot_rows: int) -> DataFrame:
    """Band rows of classes, with bucket sizes, in buckets of two classes or more."""
    bands = materialize(bands.withColumn("band_rows", F.lit(rows)), "wider-bands")
    sizes = bands.groupBy(*BUCKET).agg(F.sum("copies").alias("bucket_size"), F.count("*").alias("n"))
    sizes = materialize(sizes.where("n > 1"), "shared-buckets")
    hot = sizes.where(F.col("n") > hot_rows).orderBy(F.desc("n"), *BUCKET).limit(HOT_KEYS)
    sized = lookup_join(
        bands, sizes.drop("n"), BUCKET, "inner", hot_rows=hot_rows, hot=hot, spread_by=["class_no"],
    )
    return sized.select("class_no", "copies", "band_rows", *BUCKET, "bucket_size")


def bucket_work(sweep_bands: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Comparison work per setting, counted from bucket sizes without any pair.

    One pair counts once per bucket it shares. The 95th percentile is the nearest
    rank over all notices with a signature.
    """
    keys = ("band_rows", *BUCKET)
    sized = with_group_size(sweep_bands, keys, "bucket_size", hot_rows)
    per_notice = sized.groupBy("band_rows", "notice_id").agg(
        F.sum(F.col("bucket_size") - 1).alias("work"), F.count("*").alias("bands")
    )
    return _work_totals(materialize(per_notice, "bucket-work"))


def _work_totals(per_notice: DataFrame) -> DataFrame:
    ranks = percentiles(per_notice, "work", ["band_rows"])
    totals = per_notice.groupBy("band_rows").agg(
        F.max("bands").alias("bands"),
        (F.sum("work") / 2).cast("bigint").alias("bucket_pair_hits"),
        F.avg("work").alias("average_work"),
        F.max("work").alias("max_work"),
    )
    return totals.join(
        ranks.select("band_rows", F.col("nearest_rank").alias("p95_work")), "band_rows"
    )
