"""Wide intermediates are not stored where one pass reads them."""

from conftest import as_set
from pyspark.sql import functions as F
from test_stored_classes import _documents

from ledgerlake import datasets, workloads
from ledgerlake.operators import lsh
from ledgerlake.session import materialize


def test_wide_signatures_are_not_stored_beside_their_text(spark, tmp_path, monkeypatch):
    folder = _documents(spark, tmp_path)
    signed = workloads._wide_signatures(spark, folder)
    want = as_set(signed.select("notice_id", F.concat_ws("-", F.col("signature").cast("array<string>")))
                  .where("signature is not null"))
    for module in (datasets, lsh, workloads):
        monkeypatch.setattr(module, "materialize", None)
    found = workloads.minhash_signature(spark, folder)
    assert as_set(found.where("signature is not null")) == want
    assert found.where("signature is null").count() > 0
    # The lanes are made once.
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_a_sweep_stores_shared_bands_only(spark, monkeypatch):
    """Equal halves of a signature and copies, beside texts that share nothing."""
    rows = [(n, [100 * n + at for at in range(12)]) for n in range(40)]
    rows += [(100 + n, [1, 2, 3, 4, 5, 6, *range(at, at + 6)]) for n, at in enumerate((50_000, 90_000, 90_000))]
    signed = spark.createDataFrame(rows, "notice_id long, signature array<long>")
    stored = {}

    def noted(df, name):
        stored[name] = materialize(df, name)
        return stored[name]

    monkeypatch.setattr(lsh, "materialize", noted)
    settings = ((2, 6), (4, 3), (6, 2))
    found = lsh.sweep_work(signed, settings)
    assert all("signature" not in one.columns and not any("hashes" in c for c in one.columns) for one in stored.values())
    # Two classes share three bands of two; each class has one row besides, by its first band.
    assert stored["shared-bands"].count() == 40 + 2 * 3
    monkeypatch.undo()
    want = lsh.bucket_work(materialize(lsh.bands_of_configurations(signed, settings), "test"))
    columns = ["band_rows", "bands", "bucket_pair_hits", "average_work", "max_work", "p95_work"]
    assert as_set(found, *columns) == as_set(want, *columns)


def test_errors_store_three_shingles_and_short_lanes(spark, tmp_path, monkeypatch):
    folder = _documents(spark, tmp_path)
    stored = {}

    def noted(df, name):
        stored[name] = materialize(df, name)
        return stored[name]

    monkeypatch.setattr(datasets, "materialize", noted)
    found = workloads.pair_errors(spark, folder)
    kinds = dict(stored["shingled-notices"].dtypes)
    assert kinds["sets"] == "struct<w3:array<bigint>>" and kinds["signature"] == "array<int>"
    want = workloads._scored(spark, folder).select("notice_id_a", "notice_id_b", F.round("jaccard_3", 6))
    assert as_set(found, "notice_id_a", "notice_id_b", "exact_jaccard") == as_set(want)
    estimates = workloads.minhash_estimate(spark, folder)
    assert as_set(found, "notice_id_a", "notice_id_b", "minhash_estimate") == as_set(
        estimates, "notice_id_a", "notice_id_b", "minhash_estimate")
