"""A value that one owner holds in many documents is a copied sample."""

import pytest

from ledgerlake.llm import secret_scan

KEY, OWN = "Zq7vK2mXw9Lp4RtY8sB3", "Hb4nT8cJw1Qe6UyF5gD2"


@pytest.mark.parametrize("source", ["hot", None])
def test_many_repositories_of_one_owner_are_no_live_key(spark, source):
    many = secret_scan.COPIED_REPOSITORIES
    rows = [(n, f"bare {KEY} and token={KEY}x", source) for n in range(many)]
    rows += [(many + n, f"bare {OWN}", source) for n in range(many - 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    digest = {row.doc_id: row for row in secret_scan.secret_digest(docs).collect()}
    for n in range(many):
        assert (digest[n].n_added, digest[n].n_owner_specific, digest[n].n_copied) == (0, 0, 1)
    for n in range(many, 2 * many - 1):
        assert (digest[n].n_added, digest[n].n_owner_specific, digest[n].n_copied) == (1, 1, 0)
    spans = secret_scan.secret_ownership(docs).collect()
    assert {(row.kind, row.n_repositories, row.n_owners, row.verdict) for row in spans} == {
        ("assign", many, 1, "copied"), ("live", many - 1, 1, "live"),
    }
