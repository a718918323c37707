import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import text


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, t string")
    return [r.v for r in rows.select("n", expression(F.col("t")).alias("v")).orderBy("n").collect()]


CASES = {
    "Rs. 4,50,00,000/- only": ["money", "only"],
    "INR 4.500 Cr total": ["money", "total"],
    "RUPEES 4,50,00,000 ONLY": ["money", "only"],
    "inr 4.5 crore": ["money", "ore"],  # `cr` is tried before `crore`
    "24 hours 45 minutes": ["24", "hou", "money", "minutes"],  # no word border before `rs`
    "cost 45000000": ["cost", "reference"],
    "on 12 Mar 2024 or 12-Mar-24 or 2024-03-14": ["on", "date", "or", "date", "or", "date"],
    "14-03-2024": ["14", "03", "2024"],
    "14/03/2024 and 14.03.2024": ["14", "03", "2024", "and", "14", "03", "2024"],
    "Mar 12, 2024": ["mar", "12", "2024"],
    "NPAS-2024-0001234 SPC/2024-25/004512": ["reference", "reference"],
    "MC/2025/W/00311 TN-000412/2024": ["reference", "reference"],
    "ref 12345": ["ref", "12345"],
    "a National Procurement Aggregation Service text\nmore Name of Work: road": [
        "a", "name", "of", "work", "road"],
    "x STATE PROCUREMENT CELL rules apply": ["x"],
    "state procurement cell a tender b state procurement cell c scope d": [
        "tender", "b", "scope", "d"],
    "Iechä Straße": ["iech", "stra", "e"],
    "": [],
}


def test_normalization_table(spark):
    got = column(spark, list(CASES), text.normalize)
    assert dict(zip(CASES, got)) == CASES


def restated(value):
    """The normalization over plain strings, as the rules are written."""
    value = value.lower()
    for pattern, name in ((text.MONEY, "money"), (text.DATE, "date"), (text.REFERENCE, "reference")):
        value = re.sub(pattern, f" {name} ", value, flags=re.I)
    for phrase in text.BOILERPLATE:
        value = re.sub(f"{phrase}.*?{text.BOILERPLATE_END}", " ", value, flags=re.I | re.S)
    return re.findall(text.WORD, value)


PIECES = st.sampled_from(
    ["rs.", "INR", " 4,50", "2024", "-03-", "14", "mar", " ", "\n", "é", "ß", "_", "/", "ref",
     "npas-", "00048213", "tender", "scope", "State Procurement Cell", "word", "名", " "]
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=20, max_size=60))
def test_normalization_follows_the_rules_on_any_text(spark, values):
    assert column(spark, values, text.normalize) == [restated(value) for value in values]


def test_content_starts_at_the_first_marker_and_ends_at_the_disclaimer(spark):
    bodies = [
        "preamble SCOPE OF WORK x Name of Work: y",
        "no marker at all",
        "pre Tender Reference Number: 5\n----------\nDISCLAIMER: legal\n==========\nDisclaimer: z",
        "Name of work: a\n---------\nDisclaimer: only nine dashes",
    ]
    assert column(spark, bodies, text.content) == [
        "SCOPE OF WORK x Name of Work: y",
        "no marker at all",
        "Tender Reference Number: 5",
        "Name of work: a\n---------\nDisclaimer: only nine dashes",
    ]
    assert column(spark, bodies, text.content_start) == [10, 1, 5, 1]


def test_title_counts_three_times_and_case_does_not_matter(spark):
    rows = spark.createDataFrame(
        [("Road Work", "name of work: paving"), ("ROAD WORK", "NAME OF WORK: PAVING")],
        "title string, body string",
    )
    tokens = [r[0] for r in rows.select(text.notice_tokens(F.col("title"), F.col("body"))).collect()]
    assert tokens[0] == tokens[1] == ["road", "work"] * 3 + ["name", "of", "work", "paving"]


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_shingles_are_distinct_runs(spark, width):
    texts = ["a b a b a b c", "a b", "a", "", "a b c d e f"]
    got = column(spark, texts, lambda t: text.shingles(text.tokens(t), width))
    for value, found in zip(texts, got):
        words = value.split()
        runs = {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}
        assert set(found) == runs and len(found) == len(runs)


def test_jaccard_from_sizes(spark):
    row = spark.range(1).select(
        text.jaccard(F.lit(0), F.lit(0), F.lit(0)), text.jaccard(F.lit(1), F.lit(2), F.lit(2))
    ).first()
    assert tuple(row) == (1.0, 1 / 3)
