"""What makes writing token files quick: words merged once, pairs sorted with their places."""

import numpy as np

from ledgerlake.llm.token_files import PieceEncoder, _by_pair, default_tokenizer, re_pair


def test_a_word_before_marks_is_merged_once():
    encoder = PieceEncoder(default_tokenizer())
    merged, merge = [], encoder._merge
    encoder._merge = lambda word: merged.append(word) or merge(word)
    texts = ["so zorbelheit, zorbelheit. (zorbelheit) zorbelheit zorbelheit!? it's zorbelheit' größe größe:"]
    found = encoder.encode_all(texts)
    assert sum(word.endswith("Ġzorbelheit") for word in merged) == 1
    assert found[0].tolist() == encoder._library.encode(texts[0], add_special_tokens=False).ids


def test_chunks_with_marks_are_cut_as_the_library_cuts_them():
    encoder = PieceEncoder(default_tokenizer())
    parts = ["Haus", "don't", "x'", "'s", "we'll.", "a_", "_a", "__", "no.\n", "\tb", "1.", "a1,", "é!", "..", "", "(q)"]
    texts = [" ".join(parts[at:] + parts[:at]) for at in range(len(parts))]
    for text, found in zip(texts, encoder.encode_all(texts)):
        assert found.tolist() == encoder._library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == found.tolist()


def test_pairs_sort_alike_with_and_without_their_places_in_one_number():
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 9, (2, 500)).astype(np.int32)
    places = np.sort(rng.choice(2_000, 500, replace=False))
    packed, at = _by_pair(left, right, places, 5, 11)
    apart, apart_at = _by_pair(left, right, places, 27, 11)
    assert packed.tolist() == apart.tolist() == sorted((left.astype(np.int64) << 32 | right).tolist())
    of = dict(zip(places.tolist(), (left.astype(np.int64) << 32 | right).tolist()))
    assert [of[place] for place in at.tolist()] == packed.tolist()
    assert [of[place] for place in apart_at.tolist()] == apart.tolist()


def test_rules_of_small_and_very_large_ids_give_the_ids_back():
    rng = np.random.default_rng(6)
    sizes = (0, 1, 700, 40, 0, 33)
    for base in (12, 1 << 27):
        ids = (base - 1 - rng.integers(0, 9, sum(sizes))).astype(np.uint32)
        ids[-33:] = base - 1
        rules, symbols, stops = re_pair(ids, np.cumsum(sizes), base)
        opened = {}
        for number, pair in enumerate(rules.tolist(), base):
            opened[number] = [one for half in pair for one in opened.get(half, [half])]
        begin, back = 0, []
        for stop, size in zip(stops.tolist(), sizes):
            back.append([one for symbol in symbols[begin:stop].tolist() for one in opened.get(symbol, [symbol])])
            assert len(back[-1]) == size
            begin = stop
        assert len(rules) > 20 and sum(back, []) == ids.tolist()
