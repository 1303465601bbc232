"""Bit and hash arithmetic on BIGINT columns (unsigned values kept masked)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK32 = 0xFFFFFFFF


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_address(anchor_freq: Column | str, target_freq: Column | str, delta_ms: Column | str) -> Column:
    """``(af << 23) | (tf << 14) | delta_ms`` kept to its low 32 bits.

    Fields are not masked before the OR (the reference does not either), so
    a wide frequency or delta spills into the neighbouring field.
    """
    af = F.shiftleft(_c(anchor_freq).cast("long"), 23)
    tf = F.shiftleft(_c(target_freq).cast("long"), 14)
    d = _c(delta_ms).cast("long").bitwiseAND(F.lit(MASK32))
    return af.bitwiseOR(tf).bitwiseOR(d).bitwiseAND(F.lit(MASK32)).cast("long")


def hamming64(a: Column | str, b: Column | str) -> Column:
    """number of differing bits of two 64-bit hashes."""
    return F.bit_count(_c(a).bitwiseXOR(_c(b))).cast("int")


def hex64(h: Column | str) -> Column:
    """64-bit hash as 16 lower-case hex digits (two's complement for negatives)."""
    return F.lower(F.lpad(F.hex(_c(h)), 16, "0"))


def unhex64(s: Column | str) -> Column:
    """16 hex digits back to a signed 64-bit value (``conv`` to signed base)."""
    return F.conv(_c(s), 16, -10).cast("long")


def hamming_hex(a: Column | str, b: Column | str) -> Column:
    """F3 hex variant (Q21): count of unequal hex digits of equal-length strings."""
    ca = F.split(_c(a), "")
    cb = F.split(_c(b), "")
    diffs = F.zip_with(ca, cb, lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.aggregate(diffs, F.lit(0), lambda acc, x: acc + x).cast("int")


def bits_to_long(bits: Column) -> Column:
    """Pack an array<boolean> (first element = most significant bit) into BIGINT; more than 64 bits are an error."""
    packed = F.aggregate(
        bits, F.lit(0).cast("long"),
        lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(F.when(b, F.lit(1)).otherwise(F.lit(0)).cast("long")),
    )
    return F.when(F.size(bits) > 64, F.raise_error(F.lit("a hash of more than 64 bits does not fit a BIGINT")).cast("long")).otherwise(packed)


def hash_bucket(h: Column | str, width: int = 64) -> Column:
    """sum of 2^(i mod 8) over the set bits i (bit 0 = most significant)."""
    hc = _c(h)
    idx = F.sequence(F.lit(0), F.lit(width - 1))
    return F.aggregate(
        idx, F.lit(0).cast("long"),
        lambda acc, i: acc + F.when(
            F.call_function("shiftright", hc, (F.lit(width - 1) - i).cast("int")).bitwiseAND(F.lit(1)) == 1,
            F.call_function("shiftleft", F.lit(1).cast("long"), (i % 8).cast("int")),
        ).otherwise(F.lit(0).cast("long")),
    )
