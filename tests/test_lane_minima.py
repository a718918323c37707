"""Lane minima without division: the values of plain integer arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.minhash import LaneFamily, lane_minima, portable_family


def test_modular_lanes_are_exact_and_wide_hashes_raise(spark):
    prime = 2**31 - 1
    draw = [int(value) for value in np.random.default_rng(5).integers(0, prime, 8)]
    family = LaneFamily(lambda s: s, (0, 1, prime - 1, *draw[:4]), (0, prime - 1, 1, *draw[4:]), prime)
    hashes = [0, 1, prime - 1, prime, prime + 1, 2**32 - 1, *range(7, 400, 3)]
    documents = [(1, hashes), (2, hashes[5:6]), (3, []), (4, None), (5, hashes[2:5])]
    rows = spark.createDataFrame(documents, "id int, hashes array<bigint>")
    found = dict(rows.select("id", lane_minima(family)(F.col("hashes"))).collect())
    for name, some in documents:
        want = [min((a * h + b) % prime for h in some) for a, b in zip(family.multipliers, family.offsets)] if some else None
        assert found[name] == want
    # A product above 64 bits once wrapped without a word.
    wide = spark.createDataFrame([(1, [2**40])], rows.schema)
    with pytest.raises(Exception, match="at most 32 bits"):
        wide.select(lane_minima(portable_family(8))(F.col("hashes"))).collect()
