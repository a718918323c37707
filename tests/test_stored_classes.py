"""Content classes are stored without the signatures they are named by."""

from conftest import as_set
from pyspark.sql import functions as F

from ledgerlake import workloads
from ledgerlake.operators import lsh


def _documents(spark, folder):
    words = [f"w{n}" for n in range(30)]
    texts = [" ".join(words), " ".join(words), " ".join(words[5:]), "short", None, "one two three four"]
    rows = [(n, text, "en", f"s{n % 2}", len(text or "")) for n, text in enumerate(texts)]
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_members_store_ids_and_classes_only(spark, tmp_path):
    folder = _documents(spark, tmp_path)
    for query, signed in (
        (workloads.candidate_members, workloads._signatures),
        (workloads.near_duplicate_members, workloads._wide_signatures),
    ):
        found = query(spark, folder)
        assert spark.read.parquet(*found.inputFiles()).columns == ["notice_id", "class_id"]
        assert as_set(found) == as_set(lsh.content_classes(signed(spark, folder)))
        assert found.where(F.col("class_id").isNull()).isEmpty()
