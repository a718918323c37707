"""Joins that stay balanced when one key holds a large share of the rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.session import materialize

# A key below this many rows is an ordinary task's work.
HOT_ROWS = 1_000_000
# At most this many keys get special treatment, so the hot table has a fixed size.
HOT_KEYS = 10_000
# Joined rows, or values where rows are wide, that one task makes of one key.
TASK_PAIRS = 4_000_000
# Largest lookup side, in rows, that is sent to every executor.
BROADCAST_ROWS = 100_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; stops reading beyond that."""
    return df.select(F.lit(1)).offset(max_rows).isEmpty()


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, limit: int = HOT_KEYS
) -> DataFrame:
    """The heaviest keys, at most ``limit`` of them, with their row counts.

    The count is combined before its shuffle. The order is total over keys, so
    each use of the result sees the same keys.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("key_rows"))
    return (
        counted.where(F.col("key_rows") > hot_rows)
        .orderBy(F.desc("key_rows"), *keys)
        .limit(limit)
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    right_rows: int | None = None,
    hot_from: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    merge: bool = False,
) -> DataFrame:
    """Join a large, possibly skewed side to a lookup side on equal key names.

    A lookup side of checked size is broadcast, so the large side never moves.
    Otherwise both sides shuffle; rows of hot keys on the left are spread over
    all shuffle partitions by a hash of the row, and the lookup rows of those few
    keys are repeated once per spread value. Both ways give the same rows.
    ``right_rows`` is the lookup side's size where the caller has counted it;
    ``hot_from`` is a cheaper frame with the same key counts as ``left``, and
    ``spread_by`` names left columns that tell its rows apart (default: all); ``hot`` holds
    the hot keys where the caller knows them. ``merge`` keeps the planner from broadcasting a
    side that was counted to be too large, but whose bytes it estimates from compressed files.
    """
    keys = list(keys)
    names = [f"lookup_{key}" for key in keys]
    renamed = right.withColumnsRenamed(dict(zip(keys, names)))
    equal = [F.col(key) == F.col(name) for key, name in zip(keys, names)]
    extra = [] if condition is None else [condition]
    if right_rows is None:
        small = fits_broadcast(right, max_broadcast_rows)
    else:
        small = right_rows <= max_broadcast_rows
    if small:
        return left.join(F.broadcast(renamed), equal + extra, how).drop(*names)

    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        counted = (left if hot_from is None else hot_from).dropna(subset=keys)
        hot = hot_keys(counted, keys, hot_rows)
    hot = hot.select(*keys, F.lit(True).alias("is_hot"))
    row_hash = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(spread)).cast("int")
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    salted_left = left.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.when(F.col("is_hot") | has_null, row_hash).otherwise(F.lit(0))
    ).drop("is_hot")
    salted_right = (
        right.join(F.broadcast(hot), keys, "left")
        .withColumn(
            "lookup_salt",
            F.explode(
                F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(spread - 1)))
                .otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("is_hot")
        .withColumnsRenamed(dict(zip(keys, names)))
    )
    joined = salted_left.join(
        salted_right.hint("merge") if merge else salted_right, equal + [F.col("salt") == F.col("lookup_salt")] + extra, how
    )
    # Restore the left side's column order, which the hot lookup changed.
    rest = [] if how in ("left_semi", "left_anti") else [
        name for name in right.columns if name not in keys
    ]
    return joined.select(*left.columns, *rest)


def split_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], weight: Column | None = None,
    task_pairs: int = TASK_PAIRS,
) -> DataFrame:
    """``(keys, left_parts, right_parts)`` of the keys whose join is more than a task's work.

    A key of L rows on the left and right rows of total ``weight`` R makes L x R values. It
    is dealt into ``left_parts`` x ``right_parts`` cells of about ``task_pairs`` each, the
    cells as square as the sides allow, so that the rows repeated for them stay few. Both
    sides are counted with map-side combination; keys on one side only do not show.
    """
    keys = list(keys)
    lefts = left.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("left_rows"))
    values = F.count("*") if weight is None else F.sum(F.greatest(weight, F.lit(1)).cast("long"))
    rights = right.dropna(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("right_rows"), values.alias("right_values")
    )
    lr, rr = F.col("left_rows"), F.col("right_rows")
    cells = F.ceil(lr.cast("double") * F.col("right_values") / task_pairs)
    across = F.least(rr, F.greatest(F.lit(1), F.round(F.sqrt(cells * rr / lr)))).cast("int")
    down = F.least(lr, F.ceil(cells / F.col("right_parts"))).cast("int")
    return (
        lefts.join(rights, keys).where(cells > 1)
        .withColumn("right_parts", across).withColumn("left_parts", down)
        .select(*keys, "left_parts", "right_parts")
    )


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    weight: Column | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
    task_pairs: int = TASK_PAIRS,
    left_from: DataFrame | None = None,
    left_by: Sequence[str] | None = None,
    right_by: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join of two sides that may both be heavy on one key, or wide on the right.

    A right side of at most ``max_broadcast_rows`` rows is broadcast. Otherwise keys whose
    joined rows (times ``weight``, the values of a right row) exceed ``task_pairs`` are
    dealt into cells (:func:`split_keys`): a left row goes to one row of cells and a right
    row to one column, each by a hash of its columns ``left_by`` and ``right_by`` (default:
    all). Every pair meets in exactly one cell, and a cell makes about ``task_pairs`` values
    however heavy its key. ``left_from`` is a cheaper frame with the same key counts as
    ``left``. Rows with a null key join nothing.
    """
    keys = list(keys)
    names = [f"lookup_{key}" for key in keys]
    equal = [F.col(key) == F.col(name) for key, name in zip(keys, names)]
    extra = [] if condition is None else [condition]
    rest = [name for name in right.columns if name not in keys]
    if fits_broadcast(right, max_broadcast_rows):
        renamed = right.withColumnsRenamed(dict(zip(keys, names)))
        return left.join(F.broadcast(renamed), equal + extra, "inner").select(*left.columns, *rest)
    heavy = materialize(
        split_keys(left if left_from is None else left_from, right, keys, weight, task_pairs), "split-keys"
    )
    sizes = [F.coalesce(name, F.lit(1)) for name in ("left_parts", "right_parts")]
    none = heavy.isEmpty()

    def dealt(side: DataFrame, by: Sequence[str], own: int) -> DataFrame:
        if none:
            return side.withColumns({"row_cell": F.lit(0), "column_cell": F.lit(0)})
        cells = ["row_cell", "column_cell"]
        sized = lookup_join(side.dropna(subset=keys), heavy, keys, "left", hot_from=side.select(*keys))
        return sized.withColumn(
            cells[own], F.pmod(F.xxhash64(*by), sizes[own]).cast("int")
        ).withColumn(
            cells[1 - own], F.explode(F.sequence(F.lit(0), sizes[1 - own] - 1))
        ).select(*side.columns, *cells)

    lefts = dealt(left, left_by or left.columns, 0)
    rights = dealt(right, right_by or right.columns, 1).withColumnsRenamed(
        dict(zip([*keys, "row_cell", "column_cell"], [*names, "lookup_row", "lookup_column"]))
    )
    cell = [] if none else [
        F.col("row_cell") == F.col("lookup_row"), F.col("column_cell") == F.col("lookup_column")
    ]
    return lefts.join(rights, equal + cell + extra, "inner").select(*left.columns, *rest)


def shared_rows(
    df: DataFrame, keys: Sequence[str], size: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows of groups of two rows or more, with the row count of their group.

    Counts are combined before their shuffle and only those above one are stored and
    joined back, so a table that has few of them never moves. They also tell the hot keys.
    Reads ``df`` twice.
    """
    keys = list(keys)
    sizes = materialize(
        df.groupBy(*keys).agg(F.count("*").alias(size)).where(F.col(size) > 1), "group-sizes"
    )
    hot = sizes.where(F.col(size) > hot_rows).orderBy(F.desc(size), *keys).limit(HOT_KEYS)
    return lookup_join(df, sizes, keys, "inner", hot_rows=hot_rows, hot=hot)


def with_group_size(
    df: DataFrame, keys: Sequence[str], size: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the row count of each row's group, without gathering any group.

    Counts are combined before their shuffle. The few hot groups get their count
    by broadcast, the rest by a shuffle join of groups at most ``hot_rows`` long
    (or one ``HOT_KEYS``-th of all rows). Reads ``df`` three times: pass a stored
    table.
    """
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count("*").alias(size))
    hot = (
        sizes.where(F.col(size) > hot_rows).orderBy(F.desc(size), *keys).limit(HOT_KEYS)
    )
    hot_part = df.join(F.broadcast(hot), keys)
    rest = df.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(sizes, keys)
    return hot_part.unionByName(rest)
