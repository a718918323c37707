"""Every pair of ids that repeats becomes a rule, in symbols as narrow as the rules allow."""

import numpy as np
import pytest

from ledgerlake.llm import token_files


def _texts():
    draw = np.random.default_rng(4)
    phrases = [draw.integers(0, 50_000, 6) for _ in range(40)]
    return [np.concatenate([phrases[at] for at in draw.integers(0, 40, 30)]).astype(np.uint32) for _ in range(20)]


def test_no_pair_is_left_twice():
    ids = _texts()
    _, symbols, stops = token_files.re_pair(np.concatenate(ids), np.cumsum([len(one) for one in ids]), 50_000)
    pairs = [pair for text in np.split(symbols, stops[:-1]) for pair in zip(text[:-1].tolist(), text[1:].tolist())]
    assert len(pairs) - len(set(pairs)) == 0 and len(symbols) < 3_600 / 5


@pytest.mark.parametrize("base", [50_000, 65_530, 1 << 17, (1 << 20) - 5])
def test_shard_gives_every_document_back(base):
    ids = [np.zeros(0, np.uint32), *_texts(), np.zeros(0, np.uint32)]
    row = token_files._pack(0, 0, base, list(range(len(ids))), ids)
    assert row["width"] == 2 if base == 50_000 else row["width"] >= 17
    shard = token_files.Shard(row)
    assert all(np.array_equal(shard.document(place), one) for place, one in enumerate(ids))
    stored = sum(len(row[name]) for name in ("rules", "symbols"))
    assert stored < 2 * row["n_ids"] / 2


def test_ascending_ids_need_few_rounds():
    """Ties fall apart by hash: a grammar of balanced depth, opened level by level."""
    ids = [np.arange(20_000, dtype=np.uint32)] * 2
    rules, symbols, _ = token_files.re_pair(np.concatenate(ids), np.array([20_000, 40_000]), 50_000)
    assert len(rules) == 19_999 and len(symbols) == 2 and symbols[0] == symbols[1]
    depth = np.zeros(50_000 + len(rules), np.int64)
    for at, (left, right) in enumerate(rules.tolist()):
        depth[50_000 + at] = 1 + max(depth[left], depth[right])
    assert depth.max() < 60
    row = token_files._pack(0, 0, 50_000, [0, 1], ids)
    shard = token_files.Shard(row)
    assert all(np.array_equal(shard.document(place), one) for place, one in enumerate(ids))


@pytest.mark.parametrize("values", [1, 2, 5])
def test_runs_and_small_alphabets(values):
    draw = np.random.default_rng(values)
    for size in (1, 2, 3, 40, 3000):
        ids = draw.integers(0, values, size).astype(np.uint32)
        texts = np.split(ids, np.unique(draw.integers(0, size + 1, 3)))
        shard = token_files.Shard(token_files._pack(0, 0, 60, list(range(len(texts))), texts))
        assert np.array_equal(shard.ids(), ids)
        assert all(np.array_equal(shard.document(place), one) for place, one in enumerate(texts))
