"""Benchmark decontamination with spaced seeds that tolerate substituted tokens."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import without
from ledgerlake.session import materialize

# A document leaks an item if 13 aligned tokens agree in at least 11 (0.8 or more).
WINDOW = 13
MIN_EQUAL = 11
# Token positions that a seed looks at; the others may differ. Either mask alone meets
# every window of 13 with up to two substitutions (checked in the tests over all cases).
MASKS = ((0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
SPAN = 8
# Items too short for a window must be found whole.
MIN_ITEM = 1
# Letters of scripts written without blanks (Thai, Lao, Myanmar, Khmer, kana, Han): each
# is a token, since a run of them has no borders that two texts would share.
UNSPACED = (
    r"\x{0E01}-\x{0E30}\x{0E32}-\x{0E33}\x{0E40}-\x{0E46}\x{0E81}-\x{0EB0}\x{0EB2}-\x{0EB3}"
    r"\x{0EC0}-\x{0EC6}\x{1000}-\x{102A}\x{103F}\x{1780}-\x{17B3}\x{3005}-\x{3007}"
    r"\x{3041}-\x{3096}\x{309D}-\x{309F}\x{30A1}-\x{30FA}\x{30FC}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
)
# Seeds that are sent to every executor at a time, each about 250 bytes.
PASS_SEEDS = 100_000

BEFORE = WINDOW - SPAN  # tokens that a window can reach before a seed


def token_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits, in lower case; unspaced letters one by one."""
    low = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(
        low.rlike(f"[{UNSPACED}]"), F.regexp_replace(low, f"([{UNSPACED}])", " $1 ")
    ).otherwise(low)
    words = F.split(apart, r"[^\p{L}\p{N}]+", -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seed(tokens: Column, at: Column, number: int, mask: tuple[int, ...]) -> Column:
    """The seed of one mask at a position, null where the mask does not fit."""
    picked = [F.get(tokens, at + offset) for offset in mask]
    return F.when(at + mask[-1] < F.size(tokens), F.xxhash64(F.lit(number), *picked))


def _masks(items: DataFrame) -> list[tuple[int, ...]]:
    """The spaced masks, and one full mask for each length of short items."""
    short = [size for (size,) in items.select(F.size("tokens").alias("n")).where(
        f"n between {MIN_ITEM} and {WINDOW - 1}").distinct().orderBy("n").collect()]
    return [*MASKS, *(tuple(range(size)) for size in short)]


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(item_id, tokens)``, one row per distinct token sequence that is not empty.

    Items that read alike are one item, named by the smallest id.
    """
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("tokens"))
    return items.where(F.size("tokens") >= MIN_ITEM).groupBy("tokens").agg(
        F.min("item_id").alias("item_id")
    ).select("item_id", "tokens")


def _item_seeds(items: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """``(seed, item_id, size, at, around)``: seeds with the tokens a window can reach."""
    size, at = F.size("tokens"), F.col("at")
    hashes = []
    for number, mask in enumerate(masks):
        fits = size >= WINDOW if mask in MASKS else size == len(mask)
        hashes.append(F.when(fits, _seed(F.col("tokens"), at, number, mask)))
    return (
        items.select("item_id", "tokens", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"))
        .select(
            "item_id", size.alias("size"), "at",
            F.array(*(F.get("tokens", at + shift) for shift in range(-BEFORE, WINDOW))).alias("around"),
            F.explode(F.array(*hashes)).alias("seed"),
        )
        .where("seed is not null")
    )


def _equal_tokens() -> Column:
    """Most equal tokens in a window of 13 around the hit.

    All aligned positions that such a window can reach are compared once into bits. A
    position outside the item or the document is unequal. Written with array functions:
    they are called per hit, and the generated code of the many probes stays short.
    """
    reach = F.sequence(F.lit(0), F.lit(BEFORE + WINDOW - 1))
    equal = lambda place: F.get("tokens", F.col("at") + place - BEFORE) == F.get("around", place)
    bits = F.aggregate(
        reach, F.lit(0),
        lambda found, place: found * 2 + F.when(equal(place), F.lit(1)).otherwise(F.lit(0)),
    )
    full = (1 << WINDOW) - 1
    windows = lambda row: F.greatest(*(
        F.bit_count(row.bitwiseAND(F.lit(full << start))) for start in range(BEFORE + 1)
    ))
    return F.get(F.transform(F.array(bits), windows), F.lit(0))


def leaks(docs: DataFrame, benchmark: DataFrame, pass_seeds: int = PASS_SEEDS) -> DataFrame:
    """``(doc_id, version, item_id, n_hits, n_equal, doc_start)`` of leaked items.

    Token positions of whole texts are hashed under each mask and meet the benchmark's
    seeds in the task that reads them: documents never shuffle, and a passage that a
    third of all documents hold only adds rows to the final, pre-combined count. A
    benchmark above ``pass_seeds`` seeds is joined in several passes over the
    documents, so what is broadcast stays bounded. Each hit is verified in place.

    ``version`` is a hash of the text: rows that share an id are told apart, equal rows
    are one. ``doc_start`` is the token where the item would begin (it may be negative).
    Null and empty texts leak nothing; null ids are kept as they are. An empty
    benchmark, or one of items without tokens, gives no rows. A short item flags every
    document that holds it, be it a common word. Columns other than
    the id and the text are not looked at.
    """
    items = materialize(benchmark_items(benchmark.select("item_id", "text")), "items")
    masks = _masks(items)
    seeds = materialize(_item_seeds(items, masks), "seeds")
    passes = max(1, -(-seeds.count() // pass_seeds))

    tokens = docs.select(
        "doc_id", F.xxhash64("text").alias("version"), token_hashes(F.col("text")).alias("tokens")
    )
    # A filter on the token count would make Spark split each text twice.
    starts = F.when(
        F.size("tokens") >= MIN_ITEM, F.sequence(F.lit(0), F.size("tokens") - MIN_ITEM)
    )
    places = tokens.select("doc_id", "version", "tokens", F.explode(starts).alias("at"))
    probes = places.select(
        "doc_id", "version", "tokens", "at",
        F.explode(F.array(*(
            _seed(F.col("tokens"), F.col("at"), number, mask) for number, mask in enumerate(masks)
        ))).alias("seed"),
    ).where("seed is not null")
    equal = F.when(F.col("size") < WINDOW, F.col("size")).otherwise(_equal_tokens())
    found = []
    # Exploding the one value keeps the check out of the join's condition, where Spark
    # would copy the document's tokens for every probe, hit or not.
    for number in range(passes):
        share = seeds.where(
            F.pmod(F.xxhash64("seed", "item_id", "at"), F.lit(passes)) == number
        ).withColumnRenamed("at", "item_at")
        found.append(
            probes.join(F.broadcast(share), "seed").select(
                "doc_id", "version", "item_id", (F.col("at") - F.col("item_at")).alias("doc_start"),
                "size", F.explode(F.array(equal)).alias("n_equal"),
            ).where(F.col("n_equal") >= F.least(F.col("size"), F.lit(MIN_EQUAL)))
        )
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "version", "item_id")
        .agg(
            F.count("*").alias("n_hits"), F.max("n_equal").alias("n_equal"),
            F.min_by("doc_start", F.struct(-F.col("n_equal"), "doc_start")).alias("doc_start"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text leaks an item; all columns as given."""
    return without(docs, leaks(docs.select("doc_id", "text"), benchmark))


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", "item_id", "n_hits", F.col("n_equal").cast("long").alias("n_equal"),
        F.col("doc_start").cast("long").alias("doc_start"),
    )
