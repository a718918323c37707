"""BPE, token files, language, toxicity, quality and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from plain import leaks, line_dedup, sha, simhash as plain_simhash, smallest_reachable
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import bpe, language, quality, token_files, toxicity
from ledgerlake.session import shared_path

DATA = "/root/testdata/sf0.001"

ODD = [
    "", "  ", "Hello, wörld it's  <|endoftext|> A1b2 \n x", "ΑΣ σας ΟΔΟΣ", "İstanbul ǅ ½ ² x² é",
    "a\x1cb\x85c\xa0d", "é 日本語 テスト", "</w> a</w>b '' 's're", "a" * 40, "___ _a_ 1_2 ¹²³ªº",
    "👩‍👩‍👧 ok", "don't DON'T I'LL x'ss", "<|startoftext|><|endoftext|>x <|endoftext|", "foo  <|endoftext|>",
    "a  b   c\n\n d\t\te \n", " 's 't", "word " * 40_000,
]


def _random_texts():
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = ["th", "er", "in", "an", "the", "tion", "ing", "es", "a", "e", "s", "ss", "aa", " "]
    texts = ["".join(draw.choice(letters + "   '.,!ÉéßüAB12_\n<>|/w") for _ in range(draw.randint(1, 60))) for _ in range(800)]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(800)]
    wide = lambda: chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0x300, 0x6FF), draw.randint(0x1E00, 0x2FFF), draw.randint(0x10000, 0x1FFFF)]))
    return texts + ["".join(wide() for _ in range(30)) for _ in range(400)]


def _encode(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_bpe_equals_the_library():
    library = Tokenizer.from_file(bpe.default_tokenizer())
    codec = bpe.Codec(bpe.default_tokenizer())
    for text in ODD + _random_texts():
        ids = _encode(library, text)
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_forgets_and_finds_again():
    memory = bpe.Memory(lambda key: key * 2, 3)
    assert [memory[key] for key in (1, 2, 3, 4, 5, 1, 6, 7, 8, 2)] == [2, 4, 6, 8, 10, 2, 12, 14, 16, 4]
    assert len(memory) <= 3


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS d", "2 AS ids", "3 AS `x.y`")


ROWS = list(enumerate(ODD)) + [(100, None), (None, "no id"), (3, ODD[3]), (3, "other text of 3")]


def test_encode_documents(spark):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    found = bpe.encode_documents(_frame(spark, ROWS)).collect()
    want = []
    for doc_id, text in ROWS:
        ids = _encode(library, text)
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)), ids))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert bpe.encode_documents(_frame(spark, [])).count() == 0
    encoded = _frame(spark, ROWS[:5]).select(bpe.encoder(bpe.default_tokenizer())("text").alias("e"))
    assert [row.t for row in encoded.select(bpe.decoder(bpe.default_tokenizer())("e").alias("t")).collect()] == [
        library.decode(_encode(library, text), skip_special_tokens=False) for _, text in ROWS[:5]
    ]


def test_pieces_equal_the_library():
    library = Tokenizer.from_file(token_files.default_tokenizer())
    pieces = token_files.PieceEncoder(token_files.default_tokenizer())
    for text in ODD + _random_texts():
        assert pieces.encode(text).tolist() == _encode(library, text)


@pytest.mark.parametrize("min_pairs", [2, 5, 50])
def test_re_pair_round_trip(min_pairs):
    draw = np.random.default_rng(min_pairs)
    sizes = [0, 5, 0, 400, 1, 900, 0, 300, 0]
    ids = [draw.integers(0, 12, size).astype(np.uint32) for size in sizes]
    ids.append(np.full(301, 3, np.uint32))
    stops = np.cumsum([len(one) for one in ids])
    rules, symbols, new_stops = token_files.re_pair(np.concatenate(ids), stops, 12, min_pairs)
    assert len(rules) and len(symbols) < stops[-1]
    lengths = [1] * 12
    for left, right in rules.tolist():
        lengths.append(lengths[left] + lengths[right])
    shard = token_files.Shard({
        "width": 4, "base": 12, "rules": rules.astype("<u4").tobytes(),
        "lengths": np.array(lengths[12:], "<u4").tobytes(),
        "symbols": symbols.astype("<u4").tobytes(), "stops": new_stops.astype("<u4").tobytes(),
    })
    for place in reversed(range(len(ids))):  # any order: each document is found on its own
        assert np.array_equal(shard.document(place), ids[place])


@pytest.mark.parametrize("shard_ids", [1 << 20, 50])
def test_token_files(spark, shard_ids):
    library = Tokenizer.from_file(token_files.default_tokenizer())
    path = shared_path(spark, "tokens")
    rows = ROWS[:-1]  # one text per id, so the order is known
    token_files.write_tokens(_frame(spark, rows), path, shard_ids=shard_ids)
    found = token_files.read_tokens(spark, path).collect()
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda row: -1 if row[0] is None else row[0]):
        ids = [*_encode(library, text), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert token_files.round_trip(_frame(spark, [])).count() == 0


def test_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [row for row in found if row.held_out]
    assert {row.doc_id for row in held} == {row.doc_id for row in found if zlib.crc32(str(row.doc_id).encode()) % 3 == 1}
    assert sum(row.lang == row.lang_pred for row in held) >= 0.97 * len(held)
    assert all(0 <= row.score <= 1 for row in found)


def test_language_edges(spark):
    rows = [(0, "", "en"), (1, None, "en"), (2, "123 !?", "en"), (3, "the thing and the other", None)]
    rows += [(number, "the thing and the other " * 5, "en") for number in range(10, 30)]
    rows += [(number, "der die das und nicht " * 5, "de") for number in range(30, 50)]
    rows += [(None, "und das", "de"), (60, "das und " * 100_000, "de"), (60, "das und " * 100_000, "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS p", "2 AS score", "3 AS `x.y`")
    found = {row.doc_id: (row.lang_pred, row.score) for row in language.identify(frame).collect()}
    assert [found[one][0] for one in (0, 1, 2, 3, None, 60)] == ["und", "und", "und", "en", "de", "de"]
    kept = language.keep_identified(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 3
    assert language.identify(frame.limit(0)).count() == 0
    unlabelled = frame.withColumn("lang", frame["lang"].substr(9, 1)).where("doc_id = 3 or doc_id is null")
    assert language.identify(unlabelled.selectExpr("doc_id", "text", "nullif(lang, '') AS lang")).count() == 2


def _accuracy(found, labels, name, wanted):
    truth = {row.doc_id: row[name] for row in labels.collect()}
    held = [row for row in found if row.held_out and row.doc_id in truth]
    return sum(wanted(row) == truth[row.doc_id] for row in held) / len(held)


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= row.score <= 1 for row in found)
    assert _accuracy(found, labels, "toxic", lambda row: row.predicted) >= 0.95
    texts = dict(docs.select("doc_id", "text").collect())
    for row in found:
        assert bool(row.offending) == (row.predicted == 1)
        for sentence in row.offending:
            assert 0 <= sentence.start < sentence.end <= len(texts[row.doc_id])


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    found = quality.score_quality(docs, quality.ratings(labels)).collect()
    assert len(found) == docs.count()
    assert _accuracy(found, labels, "quality", lambda row: int(row.kept)) >= 0.9
    for row in found:
        assert 1 >= row.tails[0] >= row.tails[1] >= 0 and abs(row.expected_grade - sum(row.tails)) < 1e-9


def test_models_on_edges(spark):
    rows = [(number, "you idiot." if number % 2 else "all is well", "x") for number in range(60)]
    rows += [(100, "", "x"), (101, None, "x"), (None, "idiot", "x"), (102, "İ ẞ idiot. " * 20_000, "x"), (3, "you idiot.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, target string").selectExpr("*", "1 AS part", "2 AS r")
    labels = [(number, number % 2, number % 2) for number in range(60)]
    labels += [(None, 1, 1), (5, None, None), (900, 1, 1), (7, 1, 1), (7, 0, 0), (101, 0, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    toxic = toxicity.score_toxicity(docs, marks).collect()
    assert len(toxic) == len(rows)
    assert {row.predicted for row in toxic if row.doc_id is not None and row.doc_id < 60 and row.doc_id % 2} == {1}
    assert [row.score for row in toxic if row.doc_id in (100, 101)] == [0.0, 0.0]
    good = quality.score_quality(docs, quality.ratings(marks)).collect()
    assert len(good) == len(rows)
    for part in (docs.limit(0), docs):
        assert toxicity.score_toxicity(part, marks.limit(0)).count() == part.count()
        assert quality.score_quality(part, quality.ratings(marks.limit(0))).count() == part.count()


def test_ordinal_thresholds_ascend():
    texts = [f"{'bad ' * (2 - at % 3)}{'fine ' * (at % 3 + 1)} {at}" for at in range(90)]
    start = np.zeros((1 << quality.BITS) + 2)
    learned = quality.learn(texts, np.arange(90) % 3, start)
    cuts = quality.thresholds(learned)
    assert cuts[0] < cuts[1]
    grades = [quality.grade(text, learned[:-2], cuts)[0] for text in texts[:3]]
    assert grades == sorted(grades)


def test_pipeline_equals_plain_stages(spark):
    """Every stage on what the one before kept, against plain versions."""
    result = {row.doc_id: row for row in corpus_pipeline.run(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    judged = {row.doc_id: row for row in language.identify(docs).collect()}
    rows = [(row.doc_id, row.text) for row in docs.collect() if judged[row.doc_id].lang_pred != "und" and judged[row.doc_id].score >= 0.5]
    digests = {one[0]: one[3] for one in line_dedup(rows)}
    cut = []
    from ledgerlake.llm.line_dedup import dedup_lines
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for row in dedup_lines(frame).collect():
        assert sha(row.text) == digests[row.doc_id]
        cut.append((row.doc_id, row.text))
    fps = np.array([plain_simhash(text) for _, text in cut], np.uint64)
    roots = smallest_reachable([one for one, _ in cut], np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    cut = [row for row, root in zip(cut, roots) if row[0] == root]
    items = [tuple(row) for row in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {doc for doc, _ in leaks(cut, items)}
    library = Tokenizer.from_file(bpe.default_tokenizer())
    want = {doc: _encode(library, text) for doc, text in cut if doc not in leaked}
    assert {doc: row.ids for doc, row in result.items()} == want
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[2] == "SimHash near-dedup"
