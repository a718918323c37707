"""Joins to rows that are valid for a closed date interval."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.operators.skew import BROADCAST_ROWS, HOT_ROWS, lookup_join
from ledgerlake.session import materialize

# Versions of one key that each row of the key may be compared with.
BIN_VERSIONS = 32
_BIN = "validity_month"

def validity_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    on: str,
    start: str,
    end: str,
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    version_rows: int | None = None,
    key_versions: int | None = None,
    bin_versions: int = BIN_VERSIONS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Left join on an equal key and a date inside the version's closed interval.

    Rows without a version stay with nulls; a row inside two versions comes twice. If a
    key has more than ``bin_versions`` versions, both sides meet by (key, month) and the
    exact interval is checked once, so a row is compared only with versions of its month.
    A version is repeated for each month that it shares with the dates of ``rows``.
    ``version_rows`` is the size of ``versions`` where the caller has counted it, and
    ``key_versions`` the largest number of versions of a key. ``hot_from`` is a cheaper
    frame that tells the frequent keys of ``rows``; it is not used where months are.
    """
    inside: Column = F.col(on).between(F.col(start), F.col(end))
    if version_rows is None or key_versions is None:
        version_rows, key_versions = version_counts(versions, key)
    if key_versions <= bin_versions:
        return lookup_join(
            rows, versions, [key], "left", inside, max_broadcast_rows, hot_rows, version_rows,
            hot_from, merge=True,
        )
    first, last = rows.agg(F.min(_month(on)), F.max(_month(on))).first()
    months = F.sequence(
        F.greatest(_month(start), F.lit(first)), F.least(_month(end), F.lit(last))
    )
    # A null or empty interval, or one outside all dates, holds no row.
    shared = (
        (F.col(start) <= F.col(end)) & (_month(start) <= F.lit(last)) & (_month(end) >= F.lit(first))
    )
    binned = versions.where(shared).withColumn(_BIN, F.explode(F.when(shared, months)))
    joined = lookup_join(
        rows.withColumn(_BIN, _month(on)), binned, [key, _BIN], "left", inside,
        max_broadcast_rows, hot_rows, merge=True,
    )
    return joined.drop(_BIN)


def version_counts(versions: DataFrame, key: str) -> tuple[int, int]:
    """Number of versions, and the largest number of one key."""
    each = versions.groupBy(key).agg(F.count("*").alias("n"), F.count(key).alias("named"))
    found = each.agg(F.sum("n"), F.max("named")).first()
    return found[0] or 0, found[1] or 0


def _month(day: str) -> Column:
    return F.year(day) * 12 + F.month(day)


def newest_segments(
    versions: DataFrame, key: str, start: str, end: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Versions cut into intervals that do not overlap: on each day the newest one holds.

    Every first day and every day after a last day begins a segment; the version with
    the latest start that covers it wins, then the smallest ``tie_break``. Works on the
    version table alone, so the rows that are joined later need no ranking. A null end
    never covers a day.
    """
    names = versions.columns
    bounds = versions.select(
        key, F.explode(F.array(F.col(start), F.date_add(end, 1))).alias("segment_start")
    ).distinct()
    following = Window.partitionBy(key).orderBy("segment_start")
    segments = bounds.withColumn("segment_stop", F.lead("segment_start").over(following))
    # Segments already lie by key; without the hint the whole list may be broadcast.
    covered = segments.join(versions.hint("merge"), key).where(
        F.col("segment_start").between(F.col(start), F.col(end))
    )
    newest = Window.partitionBy(key, "segment_start").orderBy(F.col(start).desc_nulls_last(), *tie_break)
    won = covered.withColumn("place", F.row_number().over(newest)).where("place = 1")
    cut = {start: F.col("segment_start"), end: F.date_sub("segment_stop", 1)}
    return won.select(*(cut.get(name, F.col(name)).alias(name) for name in names))


def newest_version_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    on: str,
    start: str,
    end: str,
    tie_break: Sequence[str] = (),
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``validity_join`` that gives each row the newest matching version only."""
    segments = materialize(newest_segments(versions, key, start, end, tie_break), "versions")
    return validity_join(
        rows, segments, key, on, start, end, max_broadcast_rows, hot_rows, hot_from=hot_from
    )
