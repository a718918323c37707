"""Secret scan: spans of credentials, judged by who in the corpus owns each value."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import wide_hash
from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize

# The three base kinds in their order. A run shorter than the lengths
# written here is no match, and cutting it earlier would not free another match.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# The kind that the ownership counts add: bare words that look like a generated key.
BARE = r"[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "live")
ASSIGN_CHARS = 6

# A value in so many owners' documents is an example that people copy.
COPIED_OWNERS = 3
# So is one in this many documents, even if they all have the same owner: an owner uses
# a real key in a few places, a sample is pasted into many.
COPIED_REPOSITORIES = 20
# A value looks generated if it has this many characters, this many of them distinct.
LIVE_CHARS = 12
LIVE_DISTINCT = 8


def _matches(text: Column, kind: int, pattern: str) -> Column:
    """All matches in order: kind, place in order, characters since the last, match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.transform(
        F.arrays_zip(found.alias("value"), gaps.alias("gap")),
        lambda m: F.struct(F.lit(kind).alias("kind"), m["gap"].alias("gap"), m["value"].alias("value")),
    )
    none = F.slice(rows, 1, 0)
    return F.when(text.rlike(pattern), F.slice(rows, 1, F.size(found))).otherwise(none)


def find_matches(docs: DataFrame) -> DataFrame:
    """One stored row per document: its row number, owner and raw matches of each kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, BARE)
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").alias("owner"),
        *(_matches(text, kind, pattern).alias(KINDS[kind]) for kind, pattern in enumerate(patterns)),
    )
    return materialize(found, "matches")


def _located(found: DataFrame) -> DataFrame:
    """Candidate spans with code point positions, end exclusive.

    Positions are running sums over a document's matches of one kind, so a document
    with very many matches costs a sort, not a scan of all earlier matches for each.
    """
    each = found.select("row", "doc_id", "owner", F.posexplode(
        F.concat(*(F.col(kind) for kind in KINDS))
    ).alias("at", "m")).select("row", "doc_id", "owner", "at", "m.kind", "m.gap", "m.value")
    before = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    secret = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 2)).otherwise(F.col("value"))
    placed = each.withColumn("end", end).select(
        "row", "doc_id", "owner", "kind", (F.col("end") - F.length("value")).alias("start"), "end",
        secret.alias("secret"),
    )
    bare = F.col("secret").rlike("[a-z]") & F.col("secret").rlike("[A-Z]") & F.col("secret").rlike("[0-9].*[0-9].*[0-9]")
    return placed.where(
        F.when(F.col("kind") == 0, F.length("secret") >= ASSIGN_CHARS)
        .when(F.col("kind") == 3, bare).otherwise(True)
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``(h1, h2, n_repositories, n_owners)`` for each candidate value of the corpus.

    A document is a repository and its ``source`` the owner; an unknown source is one
    owner. Each level of counting combines inside the tasks before it shuffles, so a
    value that a third of all documents copy arrives as one row per task.
    """
    return (
        candidates.groupBy("h1", "h2", "owner", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2", "owner").agg(F.count("*").alias("docs"))
        .groupBy("h1", "h2").agg(F.sum("docs").alias("n_repositories"), F.count("*").alias("n_owners"))
    )


def scan_secrets(
    docs: DataFrame, copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per document row: ``doc_id`` and ``found``, its spans in order.

    ``found`` holds kind, start, end, ``n_repositories``, ``n_owners`` and ``verdict``:
    ``copied`` (examples: values that ``copied_owners`` owners or more hold, or
    ``copied_repositories`` documents of whatever owner), ``live`` (one owner only, long and varied enough to be a real key), else ``unclear``. The
    kinds assign, access and hex are always kept. Bare key-like words join them as kind
    ``live`` only where the counts call them live and no base span covers them.

    Null or empty text has no spans. Equal rows give equal rows. Documents that share
    an id count as one repository; null ids together as one. Columns other than
    ``doc_id``, ``text`` and ``source`` are not looked at.
    """
    found = find_matches(docs)
    h1, h2 = wide_hash(F.col("secret"))
    placed = materialize(
        _located(found).withColumns({"h1": h1, "h2": h2}), "candidates"
    )
    owners = materialize(ownership(placed), "ownership")
    distinct = F.size(F.array_distinct(F.split("secret", "")))
    looks_live = (F.length("secret") >= LIVE_CHARS) & (distinct >= LIVE_DISTINCT)
    judged = lookup_join(
        placed, owners, ["h1", "h2"], "inner", hot_from=placed.select("h1", "h2"),
        spread_by=["row", "kind", "start"],
    ).withColumn(
        "verdict",
        F.when(
            (F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories),
            "copied",
        )
        .when((F.col("n_owners") == 1) & looks_live, "live").otherwise("unclear"),
    ).where((F.col("kind") < 3) | (F.col("verdict") == "live"))
    base = F.col("kind") < 3
    in_order = Window.partitionBy("row").orderBy("start", "kind")
    until = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    covered = (
        F.coalesce(F.max(F.when(base, F.col("end"))).over(until) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(base, F.col("start"))).over(after) < F.col("end"), F.lit(False))
    )
    spans = (
        judged.withColumn("covered", covered).where(base | ~F.col("covered"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct(
            "start", "kind", "end", "n_repositories", "n_owners", "verdict"
        ))).alias("found"))
    )
    name = F.array(*(F.lit(kind) for kind in KINDS))
    named = F.transform(
        F.coalesce("found", F.slice("found", 1, 0)),
        lambda s: F.struct(
            F.get(name, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["n_repositories"].alias("n_repositories"), s["n_owners"].alias("n_owners"),
            s["verdict"].alias("verdict"),
        ),
    )
    return found.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", F.coalesce(named, F.array().cast(
            "array<struct<kind:string,start:bigint,end:bigint,n_repositories:bigint,n_owners:bigint,verdict:string>>"
        )).alias("found")
    )


def secret_ownership(docs: DataFrame) -> DataFrame:
    """One row per span: place, kind, repositories and owners of its value, verdict."""
    return scan_secrets(docs.select("doc_id", "text", "source")).select(
        "doc_id", F.inline("found")
    ).select("doc_id", "kind", "start", "end", "n_repositories", "n_owners", "verdict")


def secret_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind and verdict, base digest, all spans."""
    found = F.col("found")
    base = F.filter(found, lambda s: s["kind"] != "live")

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(field: str, value: str) -> Column:
        return F.size(F.filter(found, lambda s: s[field] == value)).cast("long")

    return scan_secrets(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        *(count("kind", kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(found).alias("spans"),
        count("kind", "live").alias("n_added"),
        count("verdict", "live").alias("n_owner_specific"),
        count("verdict", "copied").alias("n_copied"),
    )
