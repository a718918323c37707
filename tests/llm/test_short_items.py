"""Benchmark items of few tokens, and of scripts that write no blanks."""

import duckdb

from ledgerlake.llm import decontaminate
from ledgerlake.llm.oracle import ORACLES

HAN = "床前明月光疑是地上霜举头望明月低头思故乡"
ITEMS = [
    (0, "blue whale song"), (1, "Quasar"), (2, "one two three four five six"), (3, HAN),
    (4, "東京は晴れ"), (5, ""), (6, "ฉันรักเธอ"),
]
DOCS = [
    (0, "a Blue, whale song; blue whale song"), (1, "blue whale"), (2, "the quasar!"),
    (3, "one two three four five six seven"), (4, "他说" + HAN[:8] + "甲" + HAN[9:] + "真好"),
    (5, "今日の東京は晴れです"), (6, "東京晴れ"), (7, "บอกว่าฉันรักเธอมาก"), (8, None), (9, HAN[:9]),
]
WANT = {(0, 0, 2, 3, 1), (2, 1, 1, 1, 1), (3, 2, 1, 6, 0), (5, 4, 1, 5, 3)}


def test_short_and_unspaced_items_are_found(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {tuple(row) for row in decontaminate.leak_report(docs, bench).collect()}
    assert {(row[0], row[1]) for row in found} == {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4), (7, 6)}
    assert WANT <= found
    engine = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", DOCS), ("benchmark", "item_id", ITEMS)):
        engine.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        engine.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert {tuple(row) for row in engine.execute(ORACLES["op8_benchmark_decontamination"]).fetchall()} == found
