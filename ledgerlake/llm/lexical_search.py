"""Ranked lexical search: a sharded inverted index searched by Block-Max MaxScore.

A shard is one row of a Parquet table and holds the documents one task read together.
Binary fields are little-endian arrays of 4-byte numbers unless said otherwise:

=============== =========================================================================
``doc_ids``     the documents in order; postings name them by place
``sizes``       terms of each document, repeats included
``words``       UTF-8 bytes of the distinct terms, one after the other; ``word_stops`` their ends
``dfs``         documents of each term: the length of its list
``lasts``       last document of each block of at most 128 postings of a list
``widths``      two bytes a block: bytes of a document step and of a count in it
``stops``       end of each block in ``payload``, 8 bytes each
``best_stops``  end of each block in ``best_tf`` and ``best_size``: its postings that no other
                posting of the block beats in both count and document size
``payload``     blocks: steps from the document before (first: the place), then counts
=============== =========================================================================

A block's greatest score follows from its unbeaten postings for any corpus statistics, so
shards are written in one pass, before the statistics are known.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlake.llm.common import workers_import
from ledgerlake.session import materialize, shared_path

TOP = 10
BLOCK = 128
# Bytes of text after which a shard is closed; it then ends with the document it is in.
SHARD_BYTES = 1 << 23
# Query terms searched in one pass: the bound of what is sent to every executor, but for a
# single query that has more terms by itself.
PASS_TERMS = 100_000

_IS_TERM = np.zeros(256, bool)
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _IS_TERM[ord(_first):ord(_last) + 1] = True
# Every byte of a character beyond ASCII.
_IS_TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def cut_terms(texts: pa.Array, is_term: np.ndarray = _IS_TERM) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased terms of all texts in order, and the number of terms of each text.

    ``is_term`` says of each byte whether it belongs to a term.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or edges[0] == edges[-1]:
        return pa.array([], pa.large_binary()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]]
    edges = edges - edges[0]
    term = is_term[data]
    # A term begins where none was before, and at the first byte of a text.
    before = np.concatenate(([False], term[:-1]))
    before[edges[:-1][edges[:-1] < len(data)]] = False
    starts = np.flatnonzero(term & ~before)
    numbers = np.diff(np.searchsorted(starts, edges))
    held = np.concatenate(([0], np.cumsum(term)))
    stops = np.append(held[starts], held[-1])
    words = _LOWER[data[term]]
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(words)]
    ), numbers


def _split(words: bytes, stops: bytes) -> pa.Array:
    ends = np.concatenate(([0], np.frombuffer(stops, "<u4"))).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(words)]
    )


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``starts[i] .. starts[i] + sizes[i] - 1``, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _width(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def pack_shard(doc_ids: list, texts: pa.Array) -> dict:
    """The fields of one shard."""
    terms, sizes = cut_terms(texts)
    coded = terms.dictionary_encode()
    words = coded.dictionary
    docs = len(doc_ids)
    keys = np.sort(
        coded.indices.to_numpy().astype(np.int64) * docs + np.repeat(np.arange(docs), sizes)
    )
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
    tf = np.diff(np.append(heads, len(keys)))
    word, doc = np.divmod(keys[heads], docs)
    dfs = np.bincount(word, minlength=len(words))
    # Blocks begin every BLOCK postings of a list.
    in_list = ranges(np.zeros(len(dfs), np.int64), dfs)
    opens = np.flatnonzero(in_list % BLOCK == 0)
    block = np.cumsum(in_list % BLOCK == 0) - 1
    filled = np.diff(np.append(opens, len(doc)))
    step = doc - np.concatenate(([0], doc[:-1]))
    step[opens] = doc[opens]
    if len(opens):
        widths = np.stack((
            _width(np.maximum.reduceat(step, opens)), _width(np.maximum.reduceat(tf, opens))
        ), axis=1)
    else:
        widths = np.zeros((0, 2), np.int64)
    stops = np.cumsum(filled * widths.sum(axis=1))
    begins = np.concatenate(([0], stops[:-1])) if len(stops) else stops
    payload = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint8)
    at = np.arange(len(doc)) - opens[block]
    for side, values in enumerate((step, tf)):
        each = widths[block, side]
        place = begins[block] + at * each + (filled * widths[:, 0])[block] * side
        for byte in range(4):
            wide = each > byte
            payload[place[wide] + byte] = values[wide] >> 8 * byte & 0xFF
    # Unbeaten postings: by falling count, those smaller than all documents before.
    order = np.lexsort((sizes[doc], -tf, block))
    size, span = sizes[doc][order], int(sizes.max(initial=0)) + 1
    value = size - block[order] * span
    lowest = np.minimum.accumulate(value) if len(value) else value
    best = np.concatenate(([True], value[1:] < lowest[:-1])) if len(value) else value.astype(bool)
    best_block = block[order][best]
    fields = {
        "sizes": sizes, "word_stops": np.frombuffer(words.buffers()[1], np.int64)[1:len(words) + 1]
        if len(words) else np.zeros(0, np.int64),
        "dfs": dfs, "lasts": doc[np.append(opens[1:], len(doc)) - 1] if len(opens) else doc,
        "best_stops": np.searchsorted(best_block, np.arange(len(opens)), "right"),
        "best_tf": tf[order][best], "best_size": size[best],
    }
    return {
        "doc_ids": doc_ids, "n_docs": int((sizes > 0).sum()), "n_terms": int(sizes.sum()),
        "words": words.buffers()[2].to_pybytes() if len(words) else b"",
        "widths": widths.astype(np.uint8).tobytes(), "stops": stops.astype("<u8").tobytes(),
        "payload": payload.tobytes(),
    } | {name: values.astype("<u4").tobytes() for name, values in fields.items()}


_SCHEMA = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("n_docs", pa.int64()), ("n_terms", pa.int64()),
    *((name, pa.binary()) for name in (
        "sizes", "words", "word_stops", "dfs", "lasts", "widths", "stops",
        "best_stops", "best_tf", "best_size", "payload",
    )),
])
_KINDS = (
    "part int, shard int, doc_ids array<long>, n_docs long, n_terms long, sizes binary, "
    "words binary, word_stops binary, dfs binary, lasts binary, widths binary, stops binary, "
    "best_stops binary, best_tf binary, best_size binary, payload binary"
)


def write_index(docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Index whole texts where they are read: no shuffle, one shard row per ``shard_bytes``.

    Null and empty texts are documents without terms. Rows that share an id stay apart.
    """
    workers_import(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "shard": shard} | pack_shard(names, pa.concat_arrays(texts))
            return pa.RecordBatch.from_pylist([row], _SCHEMA)

        names, texts, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            column = batch.column("text").cast(pa.large_string())
            sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < len(ids):
                spent = sizes[begin - 1] if begin else 0
                end = min(int(np.searchsorted(sizes, spent + shard_bytes - held)) + 1, len(ids))
                names.extend(ids[begin:end])
                texts.append(column.slice(begin, end - begin))
                held += int(sizes[end - 1] - spent)
                begin = end
                if held >= shard_bytes:
                    yield close()
                    names, texts, held, shard = [], [], 0, shard + 1
        if names:
            yield close()

    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pack, _KINDS
    ).write.parquet(path)


def query_terms(items: DataFrame) -> DataFrame:
    """Stored ``(query, item_id, word, times)``: the distinct terms of each item, with repeats.

    An item is a distinct row of (item_id, text), named by a hash; a null text has no terms.
    """
    workers_import(items.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, sizes = cut_terms(batch.column("text"))
            at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            rows = pa.table({
                "query": batch.column("query").take(at), "item_id": batch.column("item_id").take(at),
                "word": terms.cast(pa.binary()),
            })
            yield from rows.group_by(["query", "item_id", "word"]).aggregate([([], "count_all")]) \
                .rename_columns(["query", "item_id", "word", "times"]).to_batches()

    named = items.select(
        F.xxhash64("item_id", F.md5("text")).alias("query"), F.col("item_id").cast("long").alias("item_id"),
        "text",
    ).distinct()
    return materialize(
        named.mapInArrow(cut, "query long, item_id long, word binary, times long"), "query-terms"
    )


def _impact(tf: np.ndarray, size: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m) with m of a document's size, as 64-bit numbers."""
    m = 25 + 75 * size * docs // terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Shard:
    """One shard opened for a set of words; blocks are unpacked when they are asked for."""

    def __init__(self, row: dict, words: pa.Array, docs: int, terms: int):
        self.doc_ids = row["doc_ids"]
        self._stats = docs, terms
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        dfs = np.frombuffer(row["dfs"], "<u4").astype(np.int64)
        blocks = -(-dfs // BLOCK)
        first = np.cumsum(blocks) - blocks
        held = pc.index_in(words, _split(row["words"], row["word_stops"]))
        found = pc.fill_null(held, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = found >= 0
        self.first = np.where(known, first[found] if len(dfs) else 0, 0)
        self.blocks = np.where(known, blocks[found] if len(dfs) else 0, 0)
        self._dfs = np.where(known, dfs[found] if len(dfs) else 0, 0)
        self.lasts = np.frombuffer(row["lasts"], "<u4").astype(np.int64)
        self._widths = np.frombuffer(row["widths"], np.uint8).reshape(-1, 2)
        self._stops = np.frombuffer(row["stops"], "<u8").astype(np.int64)
        self._payload = row["payload"]
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        # Greatest impact of each block of the words' lists, and of each list.
        ends = np.frombuffer(row["best_stops"], "<u4").astype(np.int64)
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        wanted = np.unique(ranges(self.first, self.blocks))
        number = (ends - begins)[wanted]
        at = ranges(begins[wanted], number)
        impacts = _impact(
            np.frombuffer(row["best_tf"], "<u4").astype(np.int64)[at],
            np.frombuffer(row["best_size"], "<u4").astype(np.int64)[at], docs, terms,
        )
        self.block_best = np.zeros(len(ends), np.int64)
        if len(wanted):
            self.block_best[wanted] = np.maximum.reduceat(impacts, np.cumsum(number) - number)
        self.list_best = np.zeros(len(words), np.int64)
        some = np.flatnonzero(self.blocks)
        if len(some):
            span = ranges(self.first[some], self.blocks[some])
            opens = np.cumsum(self.blocks[some]) - self.blocks[some]
            self.list_best[some] = np.maximum.reduceat(self.block_best[span], opens)

    def block(self, word: int, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the block number ``at`` of a word's list."""
        number = int(self.first[word]) + at
        if number not in self._open:
            size = int(min(BLOCK, self._dfs[word] - at * BLOCK))
            wide, count = self._widths[number].tolist()
            begin = int(self._stops[number]) - size * (wide + count)
            docs = np.cumsum(np.frombuffer(self._payload, f"<u{wide}", size, begin), dtype=np.int64)
            tf = np.frombuffer(self._payload, f"<u{count}", size, begin + size * wide).astype(np.int64)
            self._open[number] = docs, _impact(tf, self.sizes[docs], *self._stats)
        return self._open[number]

    def opened(self) -> int:
        return len(self._open)


def search_shard(
    shard: Shard, query: list[tuple[int, int]], least: int, top: int = TOP
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents that may be among the best ``top``.

    ``query`` has (word, weight); scores below ``least`` cannot matter. Lists are taken by
    falling bound. While what the rest can add reaches the threshold, a list is essential
    and read whole, and the ``top``-th best sum so far raises the threshold. After that only
    documents already met can reach it; for each further list a document goes if its sum,
    the greatest impact of its block there and the bounds of the lists behind stay below,
    and only blocks of the others are unpacked.
    """
    bounds = [(weight * int(shard.list_best[word]), weight, word) for word, weight in query]
    lists = sorted(one for one in bounds if one[0] > 0)[::-1]
    rest = np.concatenate((np.cumsum([one[0] for one in lists][::-1])[::-1], [0])).astype(np.int64)
    scores = np.zeros(len(shard.doc_ids), np.int64)
    at = 0
    while at < len(lists) and rest[at] >= max(least, 1):
        _, weight, word = lists[at]
        for number in range(int(shard.blocks[word])):
            docs, impacts = shard.block(word, number)
            scores[docs] += weight * impacts
        at += 1
        if len(scores) >= top:
            least = max(least, int(np.partition(scores, -top)[-top]))
    met = np.flatnonzero((scores > 0) & (scores + rest[at] >= least))
    for place in range(at, len(lists)):
        if not len(met):
            break
        _, weight, word = lists[place]
        first, number = int(shard.first[word]), int(shard.blocks[word])
        where = np.searchsorted(shard.lasts[first:first + number], met)
        best = np.where(where < number, shard.block_best[np.minimum(first + where, first + number - 1)], 0)
        stay = scores[met] + weight * best + rest[place + 1] >= least
        met, where = met[stay], where[stay]
        for one in np.unique(where[where < number]):
            docs, impacts = shard.block(word, int(one))
            asked = met[where == one]
            spot = np.searchsorted(docs, asked)
            hit = docs[spot] == asked
            scores[asked[hit]] += weight * impacts[spot[hit]]
    met = met[scores[met] >= max(least, 1)]
    return met, scores[met]


def _merge(heap: list, found: list, top: int) -> list:
    """The best ``top`` of (score, id is null, id), by falling score and rising id."""
    return sorted(heap + found, key=lambda one: (-one[0], one[1], one[2]))[:top]


def _searcher(plan: Broadcast, docs: int, terms: int, top: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, queries = plan.value
        words = pa.array(words, pa.large_binary())
        heaps: dict[int, list] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                shard = Shard(row, words, docs, terms)
                for query, (_, asked) in enumerate(queries):
                    heap = heaps.get(query, [])
                    least = heap[-1][0] if len(heap) == top else 0
                    places, scores = search_shard(shard, asked, least, top)
                    if len(places):
                        found = [
                            (score, one is None, one or 0) for score, one in
                            zip(scores.tolist(), map(shard.doc_ids.__getitem__, places.tolist()))
                        ]
                        heaps[query] = _merge(heap, found, top)
        flat = [
            (queries[query][0], None if null else one, score)
            for query, heap in heaps.items() for score, null, one in heap
        ]
        for begin in range(0, len(flat), 10_000):
            query, one, score = zip(*flat[begin:begin + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(one, pa.int64()), pa.array(score, pa.int64())],
                ["query", "doc_id", "score"],
            )

    return search


def _counter(words: Broadcast) -> Callable:
    """Document frequencies of the words in a task's shards, one row per word found."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(words.value, pa.large_binary())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                held = _split(batch.column("words")[at].as_py(), batch.column("word_stops")[at].as_py())
                found = pc.index_in(wanted, held)
                known = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
                dfs = np.frombuffer(batch.column("dfs")[at].as_py(), "<u4")
                total[known] += dfs[found.drop_null().to_numpy()]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "df"])

    return count


def search(
    spark: SparkSession, path: str, items: DataFrame, top: int = TOP, pass_terms: int = PASS_TERMS
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of each item.

    A score sums, over the item's terms with repeats, ``w * ((10^9 tf) div (1000 tf + 8 m))``
    in 64-bit numbers, with ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and
    ``m = 25 + (75 n N) div L``: N documents with a term, L their terms, n those of the
    document. Only scores above 0 count; equal scores rank by ascending doc_id, a null id
    last. Items that differ in id or text are searched each; equal rows are one item, and a
    null text finds nothing. An empty index gives no row.

    Every task searches the shards it reads one after the other and keeps one heap per
    query, whose last score is the threshold for its next shard; the tasks' heaps are merged
    at the end. Queries go to the executors in passes of about ``pass_terms`` terms.
    """
    workers_import(spark)
    shards = spark.read.parquet(path)
    asked = query_terms(items.select("item_id", "text"))
    docs, terms = shards.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
    ).first()
    passes = -(-asked.count() // pass_terms) if docs else 0
    found = None
    for number in range(passes):
        part = asked.where(F.pmod("query", F.lit(passes)) == number).collect()
        words = sorted({bytes(row.word) for row in part})
        place = {word: at for at, word in enumerate(words)}
        sent = spark.sparkContext.broadcast(words)
        dfs = {
            row.word: row.df for row in
            shards.select("words", "word_stops", "dfs").mapInArrow(_counter(sent), "word long, df long")
            .groupBy("word").agg(F.sum("df").alias("df")).collect()
        }
        queries: dict[int, list] = {}
        for row in part:
            word = place[bytes(row.word)]
            weight = math.floor(1000 * math.log((2 * docs + 2) / (2 * dfs[word] + 1))) if word in dfs else 0
            if weight > 0:
                queries.setdefault(row.query, []).append((word, weight * row.times))
        plan = spark.sparkContext.broadcast((words, sorted(queries.items())))
        one = shards.drop("part", "shard", "n_docs", "n_terms").mapInArrow(
            _searcher(plan, docs, terms, top), "query long, doc_id long, score long"
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], "query long, doc_id long, score long")
    heaps = materialize(found, "heaps")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return asked.select("query", "item_id").distinct().join(best, "query").select(
        "item_id", "rank", "doc_id", "score"
    )


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Index ``docs`` in the shared folder and search it for every item."""
    path = shared_path(docs.sparkSession, "lexical-index")
    write_index(docs, path)
    return search(docs.sparkSession, path, items, top)
