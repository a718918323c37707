"""SimHash near-dedup through an inverted index on the fingerprints' byte positions."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.llm import common
from ledgerlake.llm.common import (
    blocks_of, bucket_sizes, components, dealt, groups_of, local_roots, without, workers_import,
)
from ledgerlake.session import materialize

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
# Fingerprints at most 4 bits apart agree in at least 4 of their 8 bytes.
MIN_SHARED = BYTES - MAX_BITS
# Fingerprints under three shared bytes that are compared at once; beyond, a fourth byte splits them.
CROWDED_ROWS = common.BLOCK_ROWS
# Fingerprints under four shared bytes that are compared in blocks; beyond, they meet halfway.
DENSE_ROWS = 16 * common.BLOCK_ROWS


def postings() -> list[tuple[int, int, int]]:
    """Triples of byte positions such that any 4 of the 8 positions contain one.

    The positions fall into three parts. A triple is inside one part, or has two
    positions in a part and one in the next part. Four positions have either three in
    a part, or two in one part and one in each other, or two and two: each case holds
    such a triple. That makes 20 triples in place of all 56.
    """
    part = {at: at * 3 // BYTES for at in range(BYTES)}

    def chosen(triple: tuple[int, ...]) -> bool:
        parts = sorted(part[at] for at in triple)
        if parts[0] == parts[2]:
            return True
        if len(set(parts)) == 3:
            return False
        twice = parts[1]
        once = parts[0] if parts[0] != twice else parts[2]
        return once == (twice + 1) % 3

    return [triple for triple in combinations(range(BYTES), 3) if chosen(triple)]


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the text's word shingles; 0 without words.

    Bytes are lower-cased and split, which touches A-Z and the six ASCII blanks only.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    stops = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    span = min(words, len(parts))
    hashed = xxhash.xxh64_intdigest
    hashes = np.array(
        [hashed(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops[span - 1:].tolist())],
        np.uint64,
    )
    return int(_majority(hashes).view(np.int64))


def _majority(hashes: np.ndarray) -> np.uint64:
    """The word whose bit is set where more than half of the hashes have it set.

    Eight counters of one byte each are added up in a 64-bit word, 255 rows at a time.
    """
    spare = -len(hashes) % 255
    rows = np.concatenate((hashes, np.zeros(spare, np.uint64))).reshape(-1, 255)
    lanes = np.uint64(0x0101010101010101)
    result = np.uint64(0)
    for bit in range(8):
        sums = ((rows >> np.uint64(bit)) & lanes).sum(axis=1, dtype=np.uint64)
        counts = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > len(hashes)):
            result |= np.uint64(1) << np.uint64(8 * int(byte) + bit)
    return result


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, fp)`` for each row, computed in Arrow batches from whole texts.

    ``version`` is a hash of the text, which tells rows apart that share an id.
    """
    workers_import(docs.sparkSession)

    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(text) for text in texts], dtype="int64")

    return docs.select("doc_id", F.xxhash64("text").alias("version"), compute("text").alias("fp"))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each comparison group, as one edge per row to its local root.

    The byte tally drops pairs below the guaranteed count, the bits decide the rest.
    """
    for group in groups_of(batches, ("posting", "left_block", "right_block")):
        fps = group.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        block = group.column("block").to_numpy()
        differ = fps[:, None] ^ fps[None, :]
        shared = sum(
            ((differ >> np.uint64(8 * at)) & np.uint64(0xFF)) == 0 for at in range(BYTES)
        )
        linked = (shared >= MIN_SHARED) & (np.bitwise_count(differ) <= MAX_BITS)
        left, right = group.column("left_block")[0].as_py(), group.column("right_block")[0].as_py()
        if left != right:  # pairs inside one block belong to that block's own group
            linked &= block[:, None] != block[None, :]
        roots = local_roots(linked)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        if len(moved):
            signed = fps.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[moved]), pa.array(signed[roots[moved]])], ["a", "b"]
            )


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _byte_masks(count: int) -> list[int]:
    """Masks that keep so many of the eight bytes, as signed words."""
    return [
        _signed(sum(0xFF << 8 * at for at in kept)) for kept in combinations(range(BYTES), count)
    ]


def halfway_links(fps: DataFrame) -> DataFrame:
    """Edges that connect the fingerprints ``fps(fp)`` exactly as all links of 4 bits would.

    Two words are at most 4 bits apart if, and only if, some word is at most 2 bits from
    both. Each fingerprint names the 2,081 words that near, and those that name a word form
    a star around the smallest of them. Rows are linear in the fingerprints, however alike
    they are, and no word is named more than 2,081 times.
    """
    flips = [
        _signed(sum(1 << bit for bit in bits))
        for size in range(MAX_BITS // 2 + 1) for bits in combinations(range(8 * BYTES), size)
    ]
    near = F.transform(F.lit(flips), lambda flip: F.col("fp").bitwiseXOR(flip))
    named = fps.select("fp", F.explode(near).alias("word"))
    smallest = F.min("fp").over(Window.partitionBy("word"))
    return named.select(F.col("fp").alias("a"), smallest.alias("b")).where("a <> b").distinct()


def links(classes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``classes(fp)`` as their links do.

    Classes meet under three shared bytes (:func:`postings`), where pairs are tallied and
    verified. Every link shares a fourth byte, so crowded postings are cut by the five ways
    to add one. What is crowded still is dealt into blocks, a member in at most 16 of them,
    and fingerprints too alike even for that meet halfway: rows stay linear in the classes.
    Only one edge per linked class and group leaves a task, never the pairs.
    """
    def byte(at: int):
        return F.shiftrightunsigned("fp", 8 * at).bitwiseAND(F.lit(255))

    triples = postings()
    keys = F.array(*(
        (F.lit(number << 24) + byte(a) * (1 << 16) + byte(b) * (1 << 8) + byte(c)).cast("long")
        for number, (a, b, c) in enumerate(triples)
    ))
    three = materialize(classes.select("fp", F.explode(keys).alias("posting")), "postings")
    three_sizes = bucket_sizes(three, "posting")
    crowded = F.col("bucket_size") > CROWDED_ROWS
    edges = _compared(three, three_sizes.where(~crowded))
    if three_sizes.where(crowded).isEmpty():
        return edges

    kept = F.lit([_signed(sum(0xFF << 8 * at for at in triple)) for triple in triples])
    mask = F.get(kept, F.shiftright("posting", 24).cast("int"))
    wider = F.filter(F.lit(_byte_masks(MIN_SHARED)), lambda four: four.bitwiseAND(mask) == mask)
    # A collision of the hash merges two postings, whose pairs are verified like any other.
    four = (
        three.join(three_sizes.where(crowded), "posting")
        .select("fp", F.explode(wider).alias("four"))
        .select("fp", F.xxhash64("four", F.col("fp").bitwiseAND(F.col("four"))).alias("posting"))
        .distinct()
    )
    four = materialize(four, "wider-postings")
    four_sizes = bucket_sizes(four, "posting")
    dense = F.col("bucket_size") > DENSE_ROWS
    edges = edges.unionByName(_compared(four, four_sizes.where(~dense)))
    if four_sizes.where(dense).isEmpty():
        return edges
    alike = four.join(four_sizes.where(dense), "posting").select("fp").distinct()
    return edges.unionByName(halfway_links(alike))


def _compared(members: DataFrame, sizes: DataFrame) -> DataFrame:
    groups = blocks_of(members, sizes, "posting", "fp", common.BLOCK_ROWS)
    return dealt(groups, "posting").mapInArrow(_verify, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document row: ``doc_id``, ``version``, ``fp`` and ``component_id``.

    Documents link if their fingerprints differ in at most 4 bits; ``component_id`` is
    the smallest doc_id reachable. Equal fingerprints collapse first, so a group of
    copies is one class, however large; :func:`links` connects the classes.

    Null and empty texts have fingerprint zero and link like any other. Null doc_ids
    take part but are never the smallest; a group of only such rows has a null
    component. Repeated rows are copies. Other columns are not looked at.
    """
    signed = materialize(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    classes = materialize(signed.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "classes")
    linked = components(links(classes.select("fp")))
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    # Stored, so that both sides of the join below are shuffled and Spark can split a hub.
    owner = materialize(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "owners")
    named = materialize(rooted.join(owner, "root").select("fp", "component_id"), "components")
    return signed.join(named, "fp").select("doc_id", "version", "fp", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose component has a smaller id; all columns as given.

    Rows that share an id are one document: its rows stay or go each by its own text.
    Rows without id go if any document with an id is in their group.
    """
    found = near_duplicates(docs.select("doc_id", "text"))
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))
