"""Reloading only what changed: exports are compared with the last load, and only the
lake partitions that can differ are landed and written again.

Under ``root`` lie the lake, a directory of which export holds which line, and the state of
every export at each load. A line may be in several exports, also of other stores and
months, and the first by name wins; the directory tells which partitions a change touches.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake import schemas
from ledgerlake.operators.landing import first_file_wins, normalized, with_partition_keys
from ledgerlake.operators.quality import checksum_metrics
from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize
from ledgerlake.sources import tills
from ledgerlake.sources.lake import read_lake

_STATE = "load int, file string, size long, modified timestamp, row_count long, checksum decimal(38,0)"
_DIRECTORY = "bill_no string, line_no int, file string, store_id string, year int, month string"
_PARTITION = list(schemas.SALES_PARTITIONS)
_LINE = ["store_id", "business_date", *schemas.LINE_KEY, "product_code", "qty", "unit_price", "line_type", "ts"]


def exports(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, size, modified)`` of the exports in ``folder``; no content is read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(folder).select("path", "length", "modificationTime")
    )
    name = F.regexp_extract("path", r"(SALES_[^/]+)", 1)
    return listed.groupBy(name.alias("file")).agg(
        F.sum("length").alias("size"), F.max("modificationTime").alias("modified")
    ).where("file <> ''")


def _partition_of(file: Column) -> list[Column]:
    day = tills.business_date_of(file)
    return [
        tills.store_of(file).alias("store_id"), F.year(day).alias("year"),
        F.lpad(F.month(day).cast("string"), 2, "0").alias("month"),
    ]


def read_exports(spark: SparkSession, folder: str, files: list[str], prefix: str = "") -> DataFrame:
    """The lines of the named exports, each in its store's dialect."""
    lines = None
    for dialect in tills.DIALECTS:
        chosen = [name for name in files if _in_dialect(name, dialect.stores)]
        if chosen:
            part = tills.read_dialect(spark, [f"{folder}/{prefix}{name}" for name in chosen], dialect)
            lines = part if lines is None else lines.unionByName(part)
    if lines is None:
        empty = "store_id string, business_date date, file string, bill_no string, line_no int, " \
            "product_code string, qty decimal(18,3), unit_price decimal(18,2), line_type string, ts string"
        lines = spark.createDataFrame([], empty)
    return lines


def _in_dialect(name: str, stores: str) -> bool:
    """Whether an export's store is one of a dialect's, like ``S0[1-5]``."""
    store = name.split("_")[1]
    head, last = stores[:-1].split("[")
    return store[:-1] == head and last[0] <= store[-1] <= last[-1]


def _contents(lines: DataFrame) -> DataFrame:
    """Row count and checksum of each export."""
    return lines.groupBy("file").agg(*checksum_metrics(_LINE))


def _keys(lines: DataFrame) -> DataFrame:
    """The directory's rows: which export holds which line, with its partition."""
    return with_partition_keys(lines).select(*schemas.LINE_KEY, "file", *_PARTITION)


def _write(rows: DataFrame, path: str) -> None:
    """Write the partitions that ``rows`` have and leave all others as they are."""
    (
        rows.hint("rebalance", *_PARTITION).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy(*_PARTITION).parquet(path)
    )


def _empty(spark: SparkSession, path: str, gone: list) -> None:
    """Remove the partitions that have no row any more: a dynamic overwrite keeps them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for row in gone:
        place = hadoop(f"{path}/store_id={row.store_id}/year={row.year}/month={row.month}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The exports as the last load saw them."""
    try:
        state = spark.read.schema(_STATE).parquet(f"{root}/state")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STATE)
    last = state.agg(F.max("load")).first()[0]
    return state.where(F.col("load") == last)


def directory(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_DIRECTORY).parquet(f"{root}/directory")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _DIRECTORY)


def reload(spark: SparkSession, folder: str, root: str, prefix: str = "") -> DataFrame:
    """Bring the lake under ``root`` up to date with the exports in ``folder``, whose paths
    begin with ``prefix``.

    Returns the stored partitions that were written. An export counts as changed if it is
    new or gone, or if its size or time differs *and* its rows do. Partitions written are
    those of changed exports, and those that lose or gain a line because another export is
    the first that holds it now. All other files stay unwritten; an unchanged folder writes nothing. The
    first load finds everything changed.

    Lake, directory and state are written in this order, and the state last: after a
    failure the next call finds the same changes and repeats the work. One loader at a
    time is assumed.
    """
    now = materialize(exports(spark, folder), "exports")
    known = materialize(read_state(spark, root), "known-exports")
    old = known.select("file", F.col("size").alias("old_size"), F.col("modified").alias("old_modified"),
                       "row_count", "checksum")
    both = now.join(old, "file", "full")
    differs = ~(F.col("size").eqNullSafe(F.col("old_size")) & F.col("modified").eqNullSafe(F.col("old_modified")))
    suspects = materialize(both.where(differs), "suspects")
    present = [row.file for row in suspects.where("size is not null").select("file").collect()]
    fresh = materialize(read_exports(spark, folder, present, prefix), "fresh-lines")
    contents = materialize(_contents(fresh), "contents")
    compared = suspects.join(
        contents.withColumnsRenamed({"row_count": "new_rows", "checksum": "new_checksum"}), "file", "left"
    )
    # An export without rows has a count of 0 and no checksum.
    same = (
        F.col("size").isNotNull() & F.col("old_size").isNotNull()
        & (F.coalesce("new_rows", F.lit(0)) == F.coalesce("row_count", F.lit(0)))
        & F.col("new_checksum").eqNullSafe(F.col("checksum"))
    )
    changed = materialize(
        compared.where(~same).select("file", *_partition_of(F.col("file"))), "changed-exports"
    )
    written = changed.select(*_PARTITION).distinct()
    if not changed.isEmpty():
        written = _write_changed(spark, folder, root, prefix, now, fresh, changed)
    load = known.agg(F.coalesce(F.max("load"), F.lit(0)) + 1).first()[0]
    if not suspects.isEmpty():
        kept = old.join(suspects.select("file"), "file", "left_anti").select("file", "row_count", "checksum")
        counts = kept.unionByName(contents.select("file", "row_count", F.col("checksum").cast("decimal(38,0)").alias("checksum")))
        state = now.join(counts, "file", "left").select(
            F.lit(load).cast("int").alias("load"), "file", "size", "modified",
            F.coalesce("row_count", F.lit(0)).alias("row_count"), "checksum",
        )
        state.coalesce(1).write.mode("append").parquet(f"{root}/state")
    return written


def _write_changed(
    spark: SparkSession, folder: str, root: str, prefix: str, now: DataFrame, fresh: DataFrame,
    changed: DataFrame,
) -> DataFrame:
    names, key = F.broadcast(changed.select("file")), list(schemas.LINE_KEY)
    known = directory(spark, root)
    first_load = known.isEmpty()
    stay = known.join(names, "file", "left_anti")
    fresh_keys = _keys(fresh.join(names, "file", "left_semi"))
    written = changed.select(*_PARTITION).distinct()
    if not first_load:
        moved = _moved(known.join(names, "file", "left_semi"), stay, fresh_keys)
        written = materialize(written.unionByName(moved).distinct(), "written-partitions")
    # The lines of these partitions; changed exports were read already.
    located = now.select("file", *_partition_of(F.col("file")))
    files = [row.file for row in located.join(F.broadcast(written), _PARTITION, "left_semi").select("file").collect()]
    read = {row.file for row in fresh.select("file").distinct().collect()}
    lines = fresh
    others = [name for name in files if name not in read]
    if not first_load and others:
        lines = fresh.where(F.col("file").isin(*read & set(files))).unionByName(
            read_exports(spark, folder, others, prefix)
        )
    # Store and date are read off the name again once the first file has won.
    won = first_file_wins(lines.drop("store_id", "business_date")).dropna(subset=key)
    if not first_load:
        # The first export of each line outside of these partitions: one row per line.
        outside = (
            stay.join(F.broadcast(written), _PARTITION, "left_anti")
            .groupBy(*key).agg(F.min("file").alias("outside_file"))
        )
        won = won.join(outside, key, "left").where(
            F.col("outside_file").isNull() | (F.col("file") < F.col("outside_file"))
        )
    file = F.col("file")
    landed = normalized(won.withColumns({
        "store_id": tills.store_of(file), "business_date": tills.business_date_of(file),
    }))
    if first_load:
        _write(landed, f"{root}/lake")
        _write(fresh_keys, f"{root}/directory")
        return written
    _replace(spark, materialize(landed, "landed"), f"{root}/lake", written)
    # Only changed exports have other lines than before.
    relisted = changed.select(*_PARTITION).distinct()
    near = stay.join(F.broadcast(relisted), _PARTITION, "left_semi").select(*fresh_keys.columns)
    _replace(spark, materialize(near.unionByName(fresh_keys), "listed"), f"{root}/directory", relisted)
    return written


def _moved(before: DataFrame, stay: DataFrame, fresh_keys: DataFrame) -> DataFrame:
    """Partitions that lose or gain a line because another export is the first now.

    ``before`` and ``fresh_keys`` are the lines of changed exports, as they were and are;
    ``stay`` are those of all others. Only lines of changed exports are looked up in it.
    """
    key = list(schemas.LINE_KEY)
    was, now = (F.lit(at).alias(name) for at, name in ((True, "was"), (True, "is")))
    never = F.lit(False)
    names = [*key, "file"]
    touched = materialize(before.select(*key).unionByName(fresh_keys.select(*key)).distinct(), "touched-lines")
    shared = lookup_join(stay.select(*names), touched, key, "left_semi")
    holders = (
        shared.select(*names, was, now)
        .unionByName(before.select(*names, was, never.alias("is")))
        .unionByName(fresh_keys.select(*names, never.alias("was"), now))
    )
    firsts = holders.dropna(subset=key).groupBy(*key).agg(
        F.min(F.when(F.col("was"), F.col("file"))).alias("old"),
        F.min(F.when(F.col("is"), F.col("file"))).alias("new"),
    ).where(~F.col("old").eqNullSafe(F.col("new")))
    moved = firsts.select(F.explode(F.array("old", "new")).alias("file")).where("file is not null").distinct()
    return moved.select(*_partition_of(F.col("file")))


def _replace(spark: SparkSession, rows: DataFrame, path: str, written: DataFrame) -> None:
    """Write stored ``rows``, and empty the partitions of ``written`` that have none any more."""
    _write(rows, path)
    gone = written.join(rows.select(*_PARTITION).distinct(), _PARTITION, "left_anti").collect()
    _empty(spark, path, gone)


def read_reloaded(spark: SparkSession, root: str) -> DataFrame:
    return read_lake(spark, f"{root}/lake")


def partition_checksums(lines: DataFrame, row_hash) -> DataFrame:
    """Row count and checksum of each lake partition: equal after an equal load."""
    return lines.groupBy(*_PARTITION).agg(*checksum_metrics(row_hash=row_hash))
