"""SimHash, embeddings and components against plain versions and on edge cases."""

import itertools
import random

import numpy as np
import pytest
from plain import simhash as plain_simhash, smallest_reachable

from ledgerlake.llm import common, embedding_dedup, simhash


def test_postings_hold_every_four_positions():
    chosen = simhash.postings()
    assert len(chosen) == 20
    for four in itertools.combinations(range(8), 4):
        assert any(set(triple) <= set(four) for triple in chosen)


def test_components_of_chains_hubs_and_ties(spark):
    edges = [(n, n + 1) for n in range(40)] + [(1000, n) for n in range(1001, 1060)]
    edges += [(1030, 500), (7, 7), (3, 2), (3, 2), (2000, 2001)]
    found = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[n] for n in range(41)} == {0}
    assert {found[n] for n in (*range(1000, 1060), 500)} == {500}
    assert found[2001] == 2000 and len(found) == 41 + 61 + 2
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _texts():
    draw = random.Random(9)
    words = [f"Word{number}" for number in range(60)]
    base = [draw.choices(words, k=80) for _ in range(6)]
    rows = []
    for number in range(70):
        text = list(base[number % 6])
        for _ in range(number % 4):
            text[draw.randrange(80)] = draw.choice(words)
        rows.append((number, " ".join(text)))
    rows += [(100, ""), (101, None), (102, " \t\n"), (103, "one"), (104, "ONE"), (105, "é É"), (None, "one")]
    return rows + [(106, "Long " * 50_000), (107, "long " * 50_000), (5, rows[5][1])]


@pytest.mark.parametrize("block", [1024, 3])
def test_simhash(spark, monkeypatch, block):
    monkeypatch.setattr(common.in_blocks, "__defaults__", (block,))
    rows = _texts()
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS posting")
    fps = np.array([plain_simhash(text) for _, text in rows], np.uint64)
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    want = zip((i for i, _ in rows), (f"{fp:016x}" for fp in fps.tolist()), smallest_reachable([i for i, _ in rows], linked))
    found = simhash.simhash_digest(frame).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def _alike(center: int, count: int, bits: int, seed: int) -> set[int]:
    """Different words at most so many bits from a center."""
    draw, found = random.Random(seed), set()
    while len(found) < count:
        found.add(center ^ sum(1 << bit for bit in draw.sample(range(64), draw.randint(0, bits))))
    return found


@pytest.mark.parametrize("crowded, dense, block", [(1024, 16384, 1024), (40, 10**6, 16), (40, 60, 16), (1, 1, 16)])
def test_links_of_crowded_postings(spark, monkeypatch, crowded, dense, block):
    """Three bytes, four bytes in blocks, and halfway words connect what all pairs connect."""
    monkeypatch.setattr(simhash, "CROWDED_ROWS", crowded)
    monkeypatch.setattr(simhash, "DENSE_ROWS", dense)
    monkeypatch.setattr(common, "BLOCK_ROWS", block)
    draw = random.Random(3)
    fps = _alike(0x8123456789ABCDEF, 300, 4, 1) | _alike(7, 200, 6, 2) | {draw.getrandbits(64) for _ in range(100)}
    fps = np.array(sorted(fps), np.uint64)
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    names = fps.view(np.int64).tolist()
    roots = smallest_reachable(names, linked)
    frame = spark.createDataFrame([(fp,) for fp in names], "fp long")
    found = dict(map(tuple, common.components(simhash.links(frame)).collect()))
    assert {fp: found.get(fp, fp) for fp in names} == dict(zip(names, roots))
    assert len(set(roots)) > 2


def test_rows_of_a_crowded_posting_are_linear(spark):
    """A member meets at most 16 blocks of its bucket; fuller buckets are not dealt in blocks."""
    assert simhash.DENSE_ROWS <= 16 * common.BLOCK_ROWS
    for count in (2_000, 8_000):
        fps = spark.createDataFrame([(fp & (2**63 - 1),) for fp in _alike(11, count, 3, 5)], "fp long").distinct()
        members = fps.selectExpr("fp", "1L AS posting")
        groups = common.blocks_of(members, common.bucket_sizes(members, "posting"), "posting", "fp")
        assert groups.count() <= 16 * count


def test_representatives(spark):
    rows = [(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (None, "A B C D E"), (9, "other text"), (3, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS version", "1 AS `x.y`")
    kept = simhash.keep_representatives(frame)
    assert kept.columns == frame.columns
    assert sorted(row.doc_id for row in kept.collect()) == [2, 2, 3, 9]
    assert simhash.keep_representatives(frame.limit(0)).count() == 0


def _vectors():
    draw = np.random.default_rng(4)
    rows = []
    for number in range(160):
        center = np.random.default_rng(number % 8).standard_normal(16)
        vector = (center + draw.standard_normal(16) * 0.06 * (number % 4)).astype(np.float32)
        rows.append((number, [float(x) for x in vector], number % 2))
    rows += [(200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, rows[0][1], None)]
    rows += [(203, None, 0), (204, [0.0] * 16, 0), (205, [float("nan")] * 16, 0), (206, [], 0)]
    rows += [(207, [1.0, None] * 8, 0), (208, [float("inf")] * 16, 1), (209, [1.0, 2.0], 0), (210, [1.0, 2.0], 0)]
    return rows + [(211, [-0.0, 1.0], 1), (212, [0.0, 1.0], 1), (200, rows[0][1], 0)]


@pytest.mark.parametrize("block", [1024, 7])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(common.in_blocks, "__defaults__", (block,))
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS class", "2 AS bucket", "3 AS weight"
    )
    size = len(rows)
    linked = np.zeros((size, size), bool)
    usable = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for _, v, _ in rows]
    for a, b in itertools.combinations(range(size), 2):
        (_, u, i), (_, v, j) = rows[a], rows[b]
        if usable[a] and usable[b] and i == j and i is not None and len(u) == len(v):
            u, v = np.array(u), np.array(v)
            linked[a, b] = linked[b, a] = u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.98
    roots = smallest_reachable([row[0] for row in rows], linked)
    want = [(row[0], int(linked[at].sum()), roots[at], row[0] == roots[at]) for at, row in enumerate(rows)]
    found = embedding_dedup.near_duplicates(frame).collect()
    assert sorted(map(tuple, found)) == sorted(want)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).count() == 0
    unusable = spark.createDataFrame([(None, [1.0], 1), (1, None, None)], frame.schema)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(unusable).collect()), key=str) == [
        (1, 0, 1, True), (None, 0, None, True)
    ]
