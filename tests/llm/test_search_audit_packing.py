"""Ranked search, source audit and packing against plain versions and on edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from plain import UPPER
from tokenizers import Tokenizer

from ledgerlake.llm import lexical_search, packing, source_audit

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _words(text, pattern=WORD):
    return [one.translate(UPPER) for one in pattern.findall(text or "")]


def ranked(docs, items, top=10):
    """Every document scored for every item."""
    bags = [(one, Counter(_words(text))) for one, text in docs]
    n_docs = sum(bool(bag) for _, bag in bags)
    n_terms = sum(bag.total() for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    found = []
    for item, text in set(items):
        scored = []
        for one, bag in bags:
            score, size = 0, bag.total()
            for term in _words(text):
                if term in bag:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 25 + 75 * size * n_docs // n_terms
                    score += weight * (1_000_000_000 * bag[term] // (1000 * bag[term] + 8 * m))
            if score > 0:
                scored.append((-score, one is None, one or 0))
        for rank, (score, null, one) in enumerate(sorted(scored)[:top], 1):
            found.append((item, rank, None if null else one, -score))
    return sorted(found, key=str)


def _corpus(seed, size):
    draw = random.Random(seed)
    words = [f"w{number}é" if number % 3 else f"W{number}" for number in range(300)]
    weights = [1 / (1 + number) for number in range(300)]
    rows = [
        (number, "-".join(draw.choices(words, weights, k=draw.choice([3, 20, 60, 200]))))
        for number in range(size)
    ]
    rows += [(number, rows[7][1]) for number in range(size, size + 15)]  # ties
    rows += [(3, rows[3][1]), (None, rows[5][1]), (9000, None), (9001, ""), (9002, " .,"), (9003, "W1 " * 30_000)]
    return rows


@pytest.mark.parametrize("size,shard_bytes,pass_terms", [(60, 1 << 23, 100_000), (700, 1 << 23, 40), (700, 3000, 100_000)])
def test_ranked_search(spark, tmp_path, size, shard_bytes, pass_terms):
    rows = _corpus(size, size)
    draw = random.Random(2)
    items = [(number, rows[draw.randrange(size)][1][:200]) for number in range(12)]
    items += [(20, None), (21, ""), (22, "nowhere"), (4, items[4][1]), (5, "w2é W0 w0 W0"), (23, rows[7][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS `x.y`", "3 AS item_id")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS query", "2 AS doc_id")
    lexical_search.write_index(frame.repartition(3), str(tmp_path / "index"), shard_bytes)
    found = lexical_search.search(spark, str(tmp_path / "index"), asked, pass_terms=pass_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == ranked(rows, items)


def test_ranked_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.rank_documents(docs.limit(0), items).count() == 0
    assert lexical_search.rank_documents(docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert lexical_search.rank_documents(blank, items).count() == 0
    # One document holds the only term: floor(1000 ln(4/3)).
    assert [row.doc_id for row in lexical_search.rank_documents(docs, items).collect()] == [1]


def test_blocks_stay_packed():
    """A common word's list is not essential once rare words have set the threshold."""
    draw = random.Random(4)
    texts = [" ".join(["the"] * draw.randint(1, 3) + draw.choices([f"r{n}" for n in range(4000)], k=30)) for _ in range(5000)]
    for number in range(0, 5000, 250):
        texts[number] = "needle " * 3 + texts[number]
    row = lexical_search.pack_shard(list(range(5000)), pa.array(texts, pa.large_string()))
    words = pa.array([b"needle", b"the", b"absent"], pa.large_binary())
    shard = lexical_search.Shard(row, words, 5000, row["n_terms"])
    places, scores = lexical_search.search_shard(shard, [(0, 5000), (1, 3), (2, 9)], 0)
    assert set(places.tolist()) <= set(range(0, 5000, 250)) and len(places) >= 10
    assert shard.opened() < 1 + 20 and int(shard.blocks[1]) == 40
    for place, score in zip(places.tolist(), scores.tolist()):
        bag = Counter(texts[place].split())
        m = 25 + 75 * bag.total() * 5000 // row["n_terms"]
        assert score == sum(weight * (10**9 * bag[word] // (1000 * bag[word] + 8 * m)) for word, weight in (("needle", 5000), ("the", 3)))
    # Block bounds hold and are reached.
    for word in (0, 1):
        for at in range(int(shard.blocks[word])):
            assert shard.block(word, at)[1].max() == shard.block_best[shard.first[word] + at]


def test_terms_are_cut_at_bytes():
    texts = ["Ab-c d9", "", None, "ÉcoleÀ x", "Ab", "!!", "z"]
    terms, numbers = lexical_search.cut_terms(pa.array(texts, pa.string()))
    want = [_words(text) for text in texts]
    assert [one.decode() for one in terms.to_pylist()] == sum(want, [])
    assert numbers.tolist() == [len(one) for one in want]
    terms, numbers = lexical_search.cut_terms(pa.array(texts, pa.string())[3:])
    assert [one.decode() for one in terms.to_pylist()] == sum(want[3:], [])


def audited(rows, min_docs=3, top=200):
    rows = [tuple(value or "" for value in row) for row in rows]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = _words(text, LETTERS)
        df[lang].update(set(words))
        counts[lang, source].update(words)
    found = []
    for lang in df:
        kept = [term for term, number in df[lang].items() if number >= min_docs]
        total = Counter()
        groups = {source: bag for (one, source), bag in counts.items() if one == lang}
        for bag in groups.values():
            total.update({term: bag[term] for term in kept})

        def share(bag, term):
            return 1 + 10**9 * (bag[term] + 1) // (sum(bag[one] for one in kept) + len(kept))

        p = {source: [share(bag, term) for term in kept] for source, bag in groups.items()}
        q = [share(total, term) for term in kept]
        for source, bag in groups.items():
            pairs = [(-sum((a - b) ** 2 // b for a, b in zip(p[source], p[other])), other) for other in groups if other != source]
            terms = [(-((a - b) ** 2 // b), term) for term, a, b in zip(kept, p[source], q) if bag[term] and a > b]
            for part, values, last in (("pair", pairs, None), ("term", terms, top)):
                values.sort(key=lambda one: (one[0], one[1].encode()))
                found += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(values[:last], 1)]
    return sorted(found)


def test_source_audit(spark):
    draw = random.Random(6)
    words = ["The", "the", "cat", "été", "ÉTÉ", "x1y", "b", "c", "d", "rare", "süß"]
    rows = []
    for number in range(120):
        lang = draw.choice(["en", "de", None])
        source = draw.choice(["s1", "s2", "s3", "ß", None])
        rows.append((lang, source, " ".join(draw.choices(words, k=draw.randint(0, 12)))))
    rows += [("en", "s1", "The copy of all"), ("en", "s2", "The copy of all")] * 30
    rows += [("en", "silent", None), ("en", "silent", ""), ("fr", "s1", "one"), ("fr", "s2", "one two"), ("xx", "only", None)]
    rows += [("de", "s1", "lang " * 40_000)]
    frame = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS n", "2 AS docs", "'t' AS term", "3 AS `x.y`")
    found = source_audit.audit_sources(frame)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(found.dtypes)["value"] == "bigint" and dict(found.dtypes)["rank"] == "int"
    assert sorted(map(tuple, found.collect())) == audited(rows)
    assert sorted(map(tuple, source_audit.audit_sources(frame, top_terms=2).collect())) == audited(rows, top=2)
    assert source_audit.audit_sources(frame.limit(0)).count() == 0


def test_source_audit_counts_do_not_overflow(spark):
    rows = [("en", "s1", "a " * 200_000 + "b"), ("en", "s1", "a b"), ("en", "s2", "b a"), ("en", "s3", "")]
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, source_audit.audit_sources(frame).collect())) == audited(rows)


def best_fit(lengths, capacity):
    """Piece by piece into the fullest sequence with room."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [at for at, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda at: rooms[at])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_plan_is_best_fit(capacity):
    draw = random.Random(capacity)
    for _ in range(20):
        counts = {draw.randint(1, capacity): draw.choice([1, 2, 9, 30]) for _ in range(draw.randint(0, 40))}
        slots, total = packing.plan(counts, capacity)
        assert total == best_fit([one for one, number in counts.items() for _ in range(number)], capacity)
    slots, total = packing.plan({1: 10**12, 3: 10**11}, 7)
    assert len(slots) < 10 and total == -(-(10**12 + 3 * 10**11) // 7)


@pytest.mark.parametrize("capacity", [2048, 100])
def test_packing(spark, capacity):
    given = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(30).collect()
    rows = [tuple(row) for row in given]
    rows += [(9000, None), (9001, ""), (None, "no id"), (rows[0][0], rows[0][1]), (9002, "a <|endoftext|> b")]
    rows += [(9003, "long text " * 5_000)] + [(10_000 + number, "") for number in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS part", "3 AS `x.y`")
    packed = packing.pack_documents(frame.repartition(3), capacity)
    pieces = packed.collect()
    library = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for one, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert one is None or ids
        want[one, tuple(ids)] += 1
    # Documents come back whole from the sequences.
    placed = {row.sequence_id: row for row in packing.sequences(packed).collect()}
    assert sorted(placed) == list(range(len(placed))) and all(len(row.ids) <= capacity for row in placed.values())
    documents, lengths = defaultdict(list), []
    for row in pieces:
        held = placed[row.sequence_id].ids[row.offset:row.offset + row.length]
        assert held == row.ids and zlib.crc32(np.array(held, "<u4").tobytes()) == row.ids_crc32
        documents[row.doc_id].append((row.piece, row.start, tuple(held)))
        lengths.append(row.length)
    spots = defaultdict(list)
    for row in pieces:
        spots[row.sequence_id].append((row.offset, row.length))
    for at in map(sorted, spots.values()):
        assert [offset for offset, _ in at] == [0, *np.cumsum([size for _, size in at]).tolist()][:-1]
    for (one, ids), number in want.items():
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        found = Counter(documents[one])
        assert all(found[at, a, ids[a:b]] >= number for at, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert len(pieces) == sum(number * -(-len(ids) // capacity) for (_, ids), number in want.items())
    assert len(placed) == best_fit(lengths, capacity)
    assert packing.pack_documents(frame.limit(0)).count() == 0


def test_copies_land_on_their_own_slots(spark):
    """Many rows of one length over many tasks: every slot is taken once."""
    frame = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', repeat('x ', id % 40)) AS text")
    rows = packing.pack_documents(frame.repartition(13), with_ids=False).select("sequence_id", "offset", "length").collect()
    fill = defaultdict(list)
    for row in rows:
        fill[row.sequence_id].append((row.offset, row.length))
    for spots in fill.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(row.length for row in rows)
    assert len(rows) == 5000 and len(fill) == -(-total // 2048)
