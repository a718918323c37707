"""Stored index of notices: catalog tables that lookups read without moving them.

Copies collapse to content classes, so the index grows with different notices. The band
table has one row per class and band, bucketed and sorted by one 128-bit key of band number
and band hash: many probes join it bucket by bucket, and few probes read only the buckets
and row groups that may hold their keys.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.operators.lsh import band_rows, hashed_classes, hashed_notices, signature_class
from ledgerlake.operators.skew import HOT_ROWS, lookup_join, split_join
from ledgerlake.session import materialize, shared_folder

# Files of the band table: choose it so that each fits a task.
BUCKETS = 64
# Probe keys that are sent as literals, which prunes buckets; more are joined.
FEW_KEYS = 1_000


@dataclass(frozen=True)
class NoticeIndex:
    """Names of the index's tables and the banding it was built with."""

    name: str
    rows: int
    bands: int
    buckets: int
    database: str = "default"

    def table(self, spark: SparkSession, part: str) -> DataFrame:
        return spark.table(f"{self.database}.{self.name}_{part}")


def band_key() -> Column:
    """One key of band number and band hash."""
    number = F.col("band_no").cast("string").cast("binary")
    return F.unhex(F.md5(F.concat(number, F.lit("-").cast("binary"), F.col("band_hash"))))


def _classes(signatures: DataFrame) -> DataFrame:
    return (
        signatures.where(F.col("signature").isNotNull())
        .groupBy(signature_class().alias("class_id"))
        .agg(F.any_value("signature").alias("signature"))
    )


def _band_keys(classes: DataFrame, rows: int, bands: int) -> DataFrame:
    return band_rows(classes.withColumnRenamed("class_id", "notice_id"), rows, bands).select(
        F.col("notice_id").alias("class_id"), band_key().alias("band_key")
    )


def build_index(
    signatures: DataFrame, name: str, rows: int, bands: int, buckets: int = BUCKETS,
    database: str = "default", hot_rows: int = HOT_ROWS,
) -> NoticeIndex:
    """Create or replace the tables ``<name>_members``, ``_classes``, ``_bands``, ``_hot``.

    Notices without signature are left out. Keys with more than ``hot_rows`` classes would fill one
    bucket file: they go to the unbucketed ``_hot`` table. Files lie in the shared folder.
    """
    spark = signatures.sparkSession
    index = NoticeIndex(name, rows, bands, buckets, database)
    folder = f"{shared_folder(spark)}/ledgerlake/index"

    def save(part: str, table: DataFrame, *bucketed: str) -> DataFrame:
        writer = table.write.mode("overwrite").option("path", f"{folder}/{database}-{name}-{part}")
        if bucketed:
            writer = writer.bucketBy(buckets, *bucketed).sortBy(*bucketed)
        writer.saveAsTable(f"{database}.{name}_{part}")
        return index.table(spark, part)

    hashed = hashed_notices(signatures, rows, bands)
    save("members", hashed.where(F.col("class_id").isNotNull()).select("notice_id", "class_id"))
    classes = materialize(hashed_classes(hashed), "classes")
    save("classes", classes.select("class_id", "notices"))
    keyed = materialize(
        classes.select("class_id", F.posexplode("hashes").alias("band_no", "band_hash"))
        .select("class_id", band_key().alias("band_key")), "class-bands",
    )
    hot = materialize(
        keyed.groupBy("band_key").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
        .select("band_key", F.lit(True).alias("is_hot")), "hot-keys",
    )
    if hot.isEmpty():
        save("hot", keyed.limit(0))
        cold = keyed
    else:
        marked = materialize(lookup_join(keyed, hot, ["band_key"], "left"), "marked-bands")
        save("hot", marked.where("is_hot").drop("is_hot"))
        cold = marked.where("is_hot is null").drop("is_hot")
    # Dealt as the table is bucketed, so that each bucket is one file.
    save("bands", cold.repartition(buckets, "band_key"), "band_key")
    return index


def open_index(name: str, rows: int, bands: int, buckets: int = BUCKETS, database: str = "default") -> NoticeIndex:
    """An index built earlier, by its name."""
    return NoticeIndex(name, rows, bands, buckets, database)


def lookup_keys(
    spark: SparkSession, index: NoticeIndex, wanted: DataFrame, few_keys: int = FEW_KEYS
) -> DataFrame:
    """Index rows of the keys in ``wanted(probe_class, band_key)``: ``(probe_class, class_id)``.

    Up to ``few_keys`` keys are collected and become a filter, which prunes buckets and row
    groups. More are dealt like the table and joined to it bucket by bucket: the band
    table has no exchange. ``wanted`` is read twice: pass a stored table.
    """
    bands = index.table(spark, "bands")
    keys = wanted.select("band_key").distinct().limit(few_keys + 1).collect()
    if len(keys) <= few_keys:
        part = bands.where(F.col("band_key").isin([bytes(row.band_key) for row in keys]))
        found = part.join(F.broadcast(wanted), "band_key")
    else:
        found = bands.hint("merge").join(wanted, "band_key")
    hot = index.table(spark, "hot")
    if not hot.isEmpty():
        found = found.select("probe_class", "class_id").unionByName(
            split_join(hot, wanted, ["band_key"]).select("probe_class", "class_id")
        )
    return found.select("probe_class", "class_id")


def lookup(
    spark: SparkSession, index: NoticeIndex, probes: DataFrame, few_keys: int = FEW_KEYS,
    indexed: bool = True,
) -> DataFrame:
    """All candidates of each probe by class: ``(probe_id, class_id, notices)``.

    ``probes(probe_id, signature)`` without signature have no candidate. Probes with equal
    signatures are looked up once. ``notices`` counts the class's notices; of its own class
    a probe leaves itself out if it is ``indexed``, and the row goes if nothing is left.
    Copies are in the ``_members`` table; no pair of notices is listed.
    """
    named = materialize(
        probes.where(F.col("signature").isNotNull())
        .select("probe_id", "signature", signature_class().alias("probe_class")), "probes",
    )
    wanted = materialize(
        _band_keys(_classes(named), index.rows, index.bands)
        .withColumnRenamed("class_id", "probe_class"), "probe-bands",
    )
    found = materialize(lookup_keys(spark, index, wanted, few_keys).distinct(), "found-classes")
    sized = lookup_join(found, index.table(spark, "classes"), ["class_id"], "inner")
    others = F.col("notices") - F.when(F.col("class_id") == F.col("probe_class"), int(indexed)).otherwise(0)
    return split_join(
        named.select("probe_id", "probe_class"), sized, ["probe_class"]
    ).select("probe_id", "class_id", others.alias("notices")).where("notices > 0")
