"""Normal form of text and SimHash fingerprints with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64


def normalised(text: Column) -> Column:
    """Lower case, every run of characters other than letters and digits as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def blocks(n: int) -> list[int]:
    """Masks that cut the fingerprint into ``n`` blocks of about equal size."""
    cuts = [BITS * i // n for i in range(n + 1)]
    return [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]


def block_keys(fp: Column, masks: list[int]) -> Column:
    """Array of one key per mask: which mask it is and the bits below it."""
    return F.array(*(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


#: Bits of a counter, and the most values it can count without reaching the sign of the number it is part of.
_COUNTERS = ((8, 127), (16, 32767))


def _packed_counts(hashes: str, width: int) -> dict[str, Column]:
    """Counters of all bits, ``64 / width`` to a number: number j counts bits j, j + width, j + 2 * width, ..."""
    ones = sum(1 << at for at in range(0, BITS, width))
    return {
        f"_c{width}_{j}": F.expr(f"aggregate({hashes}, 0L, (s, h) -> s + (shiftrightunsigned(h, {j}) & {ones}L))")
        for j in range(width)
    }


def with_fingerprint(rows: DataFrame, hashes: str) -> DataFrame:
    """Adds ``fp``: a bit is set if it is set in more than half of the 64-bit values in the array ``hashes``.

    Several bits are counted at once, in parts of one number; arrays of more values than such a part can count are
    counted bit by bit.
    """
    counted = rows.withColumn("_n", F.size(hashes))
    single = (
        f"aggregate(sequence(0, {BITS - 1}), 0L, (fp, j) -> fp | if(aggregate({hashes}, 0L, (s, h) -> "
        "s + (shiftrightunsigned(h, j) & 1L)) * 2 > _n, shiftleft(1L, j), 0L))"
    )
    result, least = f"else {single} end", -1
    cases = []
    for width, most in _COUNTERS:
        held = (F.col("_n") > least) & (F.col("_n") <= most)
        counted = counted.withColumns(
            {name: F.when(held, count).otherwise(F.lit(0).cast("long")) for name, count in _packed_counts(hashes, width).items()}
        )
        bits = " | ".join(
            f"if((shiftrightunsigned(_c{width}_{bit % width}, {bit - bit % width}) & {(1 << width) - 1}L) * 2 > _n, "
            f"shiftleft(1L, {bit}), 0L)"
            for bit in range(BITS)
        )
        cases.append(f"when _n <= {most} then {bits}")
        least = most
    counted = counted.withColumn("fp", F.expr(f"case {' '.join(cases)} {result}"))
    return counted.drop("_n", *(f"_c{width}_{j}" for width, _ in _COUNTERS for j in range(width)))


def fingerprints(tokens: DataFrame, keys: list[str], token: str) -> DataFrame:
    """SimHash per group of ``keys`` over the rows of ``tokens``: a bit is set if most tokens' hashes have it.

    Two 32-bit counters share a number, so 32 sums count all bits of up to 2**31 tokens in compiled code.
    """
    half = BITS // 2
    pair = (1 << half) | 1
    sums = [F.sum(F.expr(f"shiftrightunsigned({token}, {j}) & {pair}L")).alias(f"_c{j}") for j in range(half)]
    counted = tokens.groupBy(*keys).agg(F.count(token).alias("_n"), *sums)
    bits = " | ".join(
        f"if((shiftrightunsigned(_c{bit % half}, {bit - bit % half}) & {(1 << half) - 1}L) * 2 > _n, shiftleft(1L, {bit}), 0L)"
        for bit in range(BITS)
    )
    return counted.select(*keys, F.expr(bits).alias("fp"))
