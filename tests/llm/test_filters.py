"""Secret scan, line dedup and decontamination against plain versions and on edge cases."""

import itertools
import random

import pytest
from plain import base_secrets, leaks, line_dedup, sha

from ledgerlake.llm import decontaminate, line_dedup as lines, secret_scan
from ledgerlake.operators import skew

SCHEMA = "doc_id long, text string, source string"
# Names that the operators use inside, as columns of the input.
CLASHES = ("row", "h1", "key", "version", "position", "at", "seed", "tokens", "owner", "gone", "a.b")


def documents(spark, rows, clash=True):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES if clash else ():
        frame = frame.withColumn(name, frame["doc_id"])
    return frame


SHARED = "This line stands in several documents."
EDGES = [
    (0, "", "s0"), (1, None, "s1"), (None, "no id\n" + SHARED, None), (2, "twice\n" + SHARED, "s0"),
    (2, "twice\n" + SHARED, "s0"), (3, f"  {SHARED.upper()}\t\n{SHARED}\nend\n", "s1"),
    (4, "short\nshort", "s2"), (5, "short\n" + SHARED, "s2"), (6, "\n\n", "s3"),
    (7, "ÄÖ " + SHARED + "\n" + SHARED, "s3"), (8, "word " * 60_000 + "\n" + SHARED, "s4"),
]


def test_line_dedup_edges(spark):
    found = lines.line_digest(documents(spark, EDGES)).collect()
    want = line_dedup([row[:2] for row in EDGES])
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_line_dedup_keeps_other_columns(spark):
    frame = documents(spark, EDGES)
    cut = lines.dedup_lines(frame)
    assert cut.columns == [*frame.columns, "n_lines", "n_dropped"]
    assert {row.doc_id for row in cut.where("n_dropped > 0").collect()} == {None, 2, 3, 5, 7}


def test_line_dedup_ways_agree(spark, monkeypatch):
    """The shuffle join with spread hot keys gives what the broadcast gives."""
    frame = documents(spark, EDGES, clash=False)
    plain = sorted(map(tuple, lines.line_digest(frame).collect()), key=str)
    real = skew.lookup_join
    monkeypatch.setattr(
        lines, "lookup_join",
        lambda *a, **b: real(*a, **b, max_broadcast_rows=0, hot_rows=1),
    )
    assert sorted(map(tuple, lines.line_digest(frame).collect()), key=str) == plain


@pytest.mark.parametrize("digest", [secret_scan.secret_digest, lines.line_digest])
def test_empty_documents(spark, digest):
    assert digest(documents(spark, [])).count() == 0


KEY = "Zq7vK2mXw9Lp4RtY8sB3"
SECRETS = [
    (0, "", "s0"), (1, None, "s0"), (None, "token=abcdef1", None),
    (2, 'Password : "hunter2x" and secret=token:abcdefgh', "s0"),
    (3, "AKIA" + "Z" * 16 + " x AKIAABC " + "0123456789abcdef" * 2, "s1"),
    (4, "𝒳𝒴 api_key='ab.cd/ef=' 𝒵 " + "a" * 24, "s1"), (5, "token=abc token=abcdef", "s2"),
    (6, f"here {KEY} alone", "s2"), (6, f"here {KEY} alone", "s2"), (7, "token=samplekey123 x", "s3"),
    (8, "token=samplekey123 y", "s4"), (9, "TOKEN=samplekey123 z", "s5"),
    (10, "Copied9Word8Stands7Everywhere6", "s1"), (11, "Copied9Word8Stands7Everywhere6", "s2"),
    (12, f"secret={KEY[:-1]}Q9", "s3"), (13, "api key=abcdef apiKEY==abcdef1 passwd=\n", "s3"),
    (14, "token=abcdef0 " * 3000, "s3"),
]


def test_secrets(spark):
    found = secret_scan.secret_digest(documents(spark, SECRETS)).collect()
    have = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found), key=str)
    assert have == sorted(((row[0], *base_secrets(row[1])) for row in SECRETS), key=str)
    by_id = {row.doc_id: row for row in found}
    # The bare key of one owner is added; the word of two owners and covered keys are not.
    assert by_id[6].spans == f"live:5:{5 + len(KEY)}" and by_id[6].n_added == 1
    assert by_id[10].spans == "" and by_id[12].n_added == 0 and by_id[12].n_owner_specific == 1
    assert by_id[7].n_copied == by_id[9].n_copied == 1 and by_id[7].n_assign == 1
    assert by_id[0].base_sha256 == sha("")


def test_masks_meet_every_window_with_two_substitutions():
    places = range(decontaminate.WINDOW)
    for mask in decontaminate.MASKS:
        for gone in itertools.combinations(places, decontaminate.WINDOW - decontaminate.MIN_EQUAL):
            assert any(
                not {start + offset for offset in mask} & set(gone)
                for start in range(decontaminate.WINDOW - mask[-1])
            )


def _bench_rows():
    draw = random.Random(3)
    words = [f"w{number}" for number in range(400)]
    text = lambda size: " ".join(draw.choices(words, k=size))
    items = [(0, text(30)), (1, text(14)), (2, text(7)), (3, text(3)), (4, ""), (5, None)]
    items += [(6, items[0][1].upper()), (None, text(20)), (7, "the same " * 10)]
    docs = []
    for number in range(40):
        body = text(60).split()
        item = items[number % 3][1].split()
        for place in draw.sample(range(len(item)), k=number % 5):
            item[place] = "changed"
        docs.append((number, " ".join(body[:30] + item + body[30:]), "s"))
    docs += [(100, None, "s"), (101, "", "s"), (102, items[2][1] + "!", "s"), (103, items[1][1][:40], "s")]
    docs += [(104, "the same " * 3000, "s"), (105, items[0][1], "s"), (105, items[0][1], "s"), (None, items[1][1], "s")]
    return docs, items


def test_leaks_equal_sliding_every_item(spark):
    docs, items = _bench_rows()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS tokens", "2 AS seed")
    found = decontaminate.leak_report(documents(spark, docs), bench).collect()
    have = {(row.doc_id, row.item_id): row.n_equal for row in found}
    want = leaks([row[:2] for row in docs], [row for row in items if row[0] != 6])
    assert have == want and (102, 2) in have and (100, 0) not in have
    # Several passes over small shares of the seeds find the same.
    again = decontaminate.leaks(documents(spark, docs), bench, pass_seeds=20).collect()
    assert {(row.doc_id, row.item_id): row.n_equal for row in again} == want


def test_decontaminate_drops_leaking_rows_only(spark):
    docs, items = _bench_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, docs)
    kept = decontaminate.decontaminate(frame, bench)
    gone = {doc for doc, _ in leaks([row[:2] for row in docs], items)}
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (row[0] for row in docs if row[0] not in gone), key=str
    )
    empty = bench.limit(0)
    assert decontaminate.decontaminate(frame, empty).count() == len(docs)
    assert decontaminate.leak_report(documents(spark, []), bench).count() == 0
