"""MinHash signatures: fixed-size stand-ins for shingle sets."""

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# Hashes of a block: with 738 lanes, 0.4 MB of 64-bit products.
_HASHES_AT_ONCE = 64


def signature_size(error: float = 0.05, confidence: float = 0.95) -> int:
    """Lanes needed to estimate Jaccard within ``error`` (Hoeffding's bound)."""
    return math.ceil(math.log(2 / (1 - confidence)) / (2 * error**2))


@dataclass(frozen=True)
class LaneFamily:
    """``size`` affine hash functions over one base hash per shingle.

    Without a modulus the lanes wrap at 64 bits and compare unsigned.
    """

    base: Callable[[Column], Column]
    multipliers: tuple[int, ...]
    offsets: tuple[int, ...]
    modulus: int | None = None

    @property
    def size(self) -> int:
        return len(self.multipliers)


def wide_family(size: int | None = None, seed: int = 20240917) -> LaneFamily:
    """Independent 64-bit lanes: the family for production use.

    Every lane draws its own odd multiplier and offset. Deriving them all from
    one constant would tie the lanes together and widen the estimator's error.
    """
    size = signature_size() if size is None else size
    draw = np.random.default_rng(seed).integers(0, 2**64, size=(2, size), dtype=np.uint64)
    return LaneFamily(
        lambda shingle: F.xxhash64(shingle),
        tuple(int(value) | 1 for value in draw[0]),
        tuple(int(value) for value in draw[1]),
    )


def portable_wide_family(size: int | None = None) -> LaneFamily:
    """The lanes of :func:`wide_family` over 64 bits of md5, which any engine can compute."""
    wide = wide_family(size)
    base = lambda shingle: F.conv(F.substring(F.md5(shingle), 1, 16), 16, -10).cast("bigint")
    return LaneFamily(base, wide.multipliers, wide.offsets)


def _digest28(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:7], 16)


def portable_family(size: int) -> LaneFamily:
    """Lanes that any SQL engine can compute: 28 bits of md5, modulo 2^31 - 1."""
    return LaneFamily(
        lambda shingle: F.conv(F.substring(F.md5(shingle), 1, 7), 16, 10).cast("bigint"),
        tuple(_digest28(f"a{lane}") for lane in range(size)),
        tuple(_digest28(f"b{lane}") for lane in range(size)),
        2**31 - 1,
    )


def lane_minima(family: LaneFamily) -> Callable[[Column], Column]:
    """Arrow function: base hashes of a document to its signature.

    A document without shingles has no signature (null). All it needs is local, so
    executors run it without this package installed.
    """
    # Unsigned 64-bit arithmetic wraps. A lane modulo m is kept as the fraction
    # value / m in units of 2^-64: wrapping then drops the whole part, so no division is
    # needed. Multiplier and offset are rounded up, an error of less than hash + 1 units
    # where neighbouring values are 2^64 / m apart: with hashes below 2^32 and m at most
    # 2^31 the order is exact and the upper bits of fraction x m are the value.
    modulus, size, hashes_at_once = family.modulus, family.size, _HASHES_AT_ONCE
    if modulus is not None and modulus > 2**31:
        raise ValueError("a modulus above 2^31 has no exact fractions")
    units = [*family.multipliers, *family.offsets]
    if modulus is not None:
        units = [-(-(value % modulus << 64) // modulus) for value in units]
    multipliers, offsets = np.array(units, dtype=np.uint64).reshape(2, size)

    def values(fractions: np.ndarray) -> np.ndarray:
        """Upper 64 bits of fraction x modulus."""
        half, low = np.uint64(32), np.uint64(2**32 - 1)
        factor = np.uint64(modulus)
        return (fractions >> half) * factor + ((fractions & low) * factor >> half) >> half

    def lowest(hashes: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Minimum of each lane over one document's base hashes."""
        best = None
        for start in range(0, len(hashes), hashes_at_once):
            some = hashes[start:start + hashes_at_once, None]
            products = np.multiply(some, multipliers, out=block[:len(some)])
            products += offsets
            found = products.min(axis=0)
            best = found if best is None else np.minimum(best, found, out=best)
        return best

    @F.arrow_udf("array<bigint>")
    def minima(bases: pa.Array) -> pa.Array:
        ends = np.cumsum(bases.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        hashes = bases.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        if modulus is not None and len(hashes) and hashes.max() >= 2**32:
            raise ValueError("hashes of a modular family have at most 32 bits")
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        filled = ends > starts
        block = np.empty((hashes_at_once, size), dtype=np.uint64)
        flat = np.empty((int(filled.sum()), size), dtype=np.uint64)
        for row, document in enumerate(np.flatnonzero(filled)):
            best = lowest(hashes[starts[document]:ends[document]], block)
            flat[row] = best if modulus is None else values(best)
        bounds = np.concatenate([[0], np.cumsum(filled) * size]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(bounds), pa.array(flat.ravel().view(np.int64)), mask=pa.array(~filled)
        )

    return minima


def signature(shingle_set: Column, family: LaneFamily) -> Column:
    """MinHash signature of an array of distinct shingles."""
    return lane_minima(family)(F.transform(shingle_set, family.base))


def estimated_jaccard(left: Column, right: Column, size: int) -> Column:
    """Share of lanes on which two signatures agree; null if either is missing."""
    agree = F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda same: same)
    return F.when(agree.isNotNull(), F.size(agree) / F.lit(size))
