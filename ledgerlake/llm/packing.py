"""Best-fit packing of token ids, planned on the histogram of lengths.

Documents are cut into pieces of at most a sequence. How many pieces of each length there
are decides where they go: best fit, longest first, moves whole counts at a time, so the
plan's size follows the number of lengths and not of documents. A piece then takes the
planned slot of its rank among the pieces of its length.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.llm.common import workers_import
from ledgerlake.llm.token_files import default_tokenizer, piece_encoder
from ledgerlake.operators.skew import lookup_join
from ledgerlake.session import materialize

CAPACITY = 2048
END_ID = 0
# Characters that are encoded together.
GROUP_CHARS = 1 << 22
# Ranks stay below this, so that length and rank make one sortable number.
_RANKS = 48


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts, in groups of about ``GROUP_CHARS`` characters."""
    for batch in batches:
        names, texts, held = [], [], 0
        for name, text in zip(batch.column("doc_id"), batch.column("text")):
            names.append(name.as_py())
            texts.append(text.as_py())
            held += len(texts[-1] or "")
            if held >= GROUP_CHARS:
                yield names, texts
                names, texts, held = [], [], 0
        if names:
            yield names, texts


def cut_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
    end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """Stored pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, if asked
    ``ids``, and where they were made: ``part`` (the task) and ``at`` (rank in that task
    among the pieces of the same length).

    Whole texts are encoded where they are read, and each ends with ``end_id``. A document
    longer than ``capacity`` is cut so that only its first piece is shorter. Null and empty
    texts have the end id only; repeated rows are documents of their own.
    """
    workers_import(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    kinds = {
        "doc_id": "long", "piece": "int", "start": "long", "length": "int", "ids_crc32": "long",
        "part": "int", "at": "long",
    } | ({"ids": "array<int>"} if with_ids else {})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = piece_encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4")
        for names, texts in _groups(batches):
            rows = {name: [] for name in kinds}
            for name, found in zip(names, encode.encode_all(texts)):
                ids = np.concatenate((found, end)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                    rows["doc_id"].append(name)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(stop - start)
                    rows["ids_crc32"].append(zlib.crc32(ids[start:stop].tobytes()))
                    rows["part"].append(part)
                    rows["at"].append(int(seen[stop - start]))
                    seen[stop - start] += 1
                    if with_ids:
                        rows["ids"].append(ids[start:stop].astype(np.int32))
            yield pa.RecordBatch.from_pydict(rows, schema)

    types = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, types[kind]) for name, kind in kinds.items()])
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    )
    return materialize(pieces, "pieces")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slots for ``counts[length]`` pieces of each length, and the number of sequences.

    Best fit, longest first: a piece goes to the fullest sequence that has room for it.
    Sequences of equal room made alike are one range and are filled together, so a step
    places a whole range. A slot row is ``(length, first rank, pieces per sequence, first
    sequence, offset)``: the piece of rank r is number ``r - first rank`` of the range,
    and consecutive pieces fill one sequence before the next.

    A range splits at most twice per length, and a sequence holds fewer than
    ``sqrt(2 * capacity)`` different lengths, which bounds the rows by
    ``2 * capacity * sqrt(2 * capacity)``, however many pieces there are.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    slots: list[tuple[int, int, int, int, int]] = []
    total = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        fit = length
        while left:
            while fit <= capacity and not room[fit]:
                fit += 1
            each = min(fit, capacity) // length
            if fit > capacity:
                first, number, space = total, -(-left // each), capacity
                total += number
            else:
                first, number = room[fit].pop()
                space = fit
            full, rest = min(number, left // each), 0
            if full:
                slots.append((length, rank, each, first, capacity - space))
                rank += full * each
                left -= full * each
                room[space - each * length].append((first, full))
            if full < number and left:
                rest, left = left, 0
                slots.append((length, rank, rest, first + full, capacity - space))
                rank += rest
                room[space - rest * length].append((first + full, 1))
            used = full + (rest > 0)
            if used < number:
                room[space].append((first + used, number - used))
    return np.array(sorted(slots), np.int64).reshape(-1, 5), total


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (stored, from :func:`cut_documents`) with ``sequence_id`` and ``offset``.

    The histogram has at most ``capacity`` rows and the plan made from it is bounded too;
    both are all that passes the driver. A piece's rank among its length is its rank in the
    task that made it plus the counts of the tasks before, so a length that most pieces
    have is neither sorted nor gathered.
    """
    spark = pieces.sparkSession
    workers_import(spark)
    made = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {row.length: row.n for row in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(plan(counts, capacity)[0])

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = slots.value
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        starts = rows[:, 0] << _RANKS | rows[:, 1]
        found = rows[np.searchsorted(starts, length << _RANKS | rank, "right") - 1]
        ahead, each = rank - found[:, 1], found[:, 2]
        return pd.DataFrame({
            "sequence_id": found[:, 3] + ahead // each, "offset": found[:, 4] + ahead % each * length,
        })

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranks = made.select("length", "part", before.alias("before"))
    ranked = lookup_join(pieces, ranks, ["length", "part"], "inner")
    names = [name for name in pieces.columns if name not in ("part", "at")]
    placed = ranked.withColumn("slot", slot("length", F.col("before") + F.col("at")))
    return placed.select(*names, "slot.sequence_id", "slot.offset")


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
    end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: its ids (if asked) and its place in a sequence.

    Every document is packed whole; see :func:`cut_documents` for nulls, empty texts and
    repeated rows and :func:`place` for the order. Sequences are numbered from 0 and filled
    from offset 0 without gaps. No document gives no piece. Columns other than ``doc_id`` and
    ``text`` are not looked at.
    """
    return place(cut_documents(docs, capacity, tokenizer, end_id, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ids, starts)``: the packed ids and where each piece begins.

    A sequence has at most as many pieces as tokens, so what is gathered is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("starts"),
    )
