"""The complete candidates on the signatures of the suppressed ones."""

from itertools import combinations

from conftest import as_set

from ledgerlake import workloads


def test_notices_above_the_cap_keep_their_candidates(spark, monkeypatch):
    """101 equal notices and a near copy that meets them only in their buckets."""
    words = [f"word{n}" for n in range(60)]
    texts = {n: words for n in range(101)}
    texts[200] = [*words[:59], "other"]
    texts[300] = texts[301] = [f"else{n}" for n in range(30)]
    tokens = spark.createDataFrame(list(texts.items()), "notice_id long, tokens array<string>")
    monkeypatch.setattr(workloads.data, "notice_tokens", lambda spark, sf_dir: tokens)

    assert as_set(workloads.near_duplicate_candidates(spark, "")) == {(300, 301)}
    members = dict(as_set(workloads.QUERIES["near_duplicate_members"](spark, "")))
    buckets = {}
    for row in workloads.QUERIES["near_duplicate_buckets"](spark, "").collect():
        buckets.setdefault((row.band_no, row.band_hash), set()).add(row.class_id)
    found = {
        (a, b) for a, b in combinations(sorted(members), 2)
        if members[a] == members[b]
        or any({members[a], members[b]} <= classes for classes in buckets.values())
    }
    assert found == {*combinations([*range(101), 200], 2), (300, 301)}
