"""Exact scores and estimates of labelled pairs come from one pass over the texts."""

from pyspark.sql import functions as F

from ledgerlake import datasets, workloads
from ledgerlake.functions.text import shingles
from ledgerlake.operators import evaluate
from ledgerlake.operators.minhash import estimated_jaccard, portable_family, signature
from ledgerlake.session import materialize

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"


def write_documents(spark, folder):
    words = "supply of school desks for the district of north and south by open bid".split()
    texts = [f"title {n % 3}\n" + " ".join(words[n % 5:] + [str(n % 4)] * 3) for n in range(24)]
    rows = [(n, text, "en", "web", len(text or "")) for n, text in enumerate([*texts, "short", None])]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")


def test_texts_are_normalized_once_for_scores_and_estimates(spark, tmp_path, monkeypatch):
    write_documents(spark, tmp_path)
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, name)

    for module in (datasets, evaluate, workloads):
        monkeypatch.setattr(module, "materialize", noted)
    found = workloads.estimator_error(spark, str(tmp_path)).collect()
    assert sum("regexp_extract_all" in plan for plan in plans) == 1
    assert {row["group"]: row["pairs"] for row in found}["all"] > 20


def test_scores_and_estimates_are_those_of_separate_steps(spark):
    family = portable_family(40)
    tokens = spark.createDataFrame(
        [(1, "a b c d e f".split()), (2, "a b c d e g".split()), (3, ["a", "b"]), (4, []),
         (5, "a b c d e f".split()), (5, "a b c x y z".split())],
        "notice_id long, tokens array<string>",
    )
    pairs = spark.createDataFrame(
        [(1, 2, "same"), (1, 3, "different"), (3, 4, "same"), (1, 5, "same"), (1, 5, "same"), (None, 2, "same")],
        "notice_id_a long, notice_id_b long, label string",
    )
    signed = tokens.select("notice_id", signature(shingles(F.col("tokens"), 3), family).alias("signature"))
    estimates = evaluate.attach_both(pairs, signed, "signature").select(
        *evaluate.PAIR,
        estimated_jaccard(F.col("left_signature"), F.col("right_signature"), 40).alias("minhash_estimate"),
    )
    shingled = datasets.shingled_notices(tokens, family)
    for rows in (1_000, 0):
        both = evaluate.score_and_estimate(pairs, shingled, 40, rows)
        for want in (evaluate.score_pairs(pairs, tokens), estimates):
            got = both.select(*want.columns).collect()
            assert sorted(map(str, got)) == sorted(map(str, want.collect()))
