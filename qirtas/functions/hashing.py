"""The term hash of hashed TF vectors by native expressions.

Spark's ``hash`` treats the bytes behind the last full word of four differently from
the hash that MLlib's vectors use, so it is applied to the full words only.  Its last
step is a bijection; taken back, it gives the state into which the remaining
one to three bytes and the whole length go.  All values are 32 bits in a bigint.

The steps are columns of their own: each uses the one before more than once, and a
single expression would repeat it every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multipliers of the public 32-bit MurmurHash3, and inverses of the last two.
C1, C2 = 0xCC9E2D51, 0x1B873593
M1, M2 = 0x85EBCA6B, 0xC2B2AE35
INVERSE_M1, INVERSE_M2 = pow(M1, -1, 1 << 32), pow(M2, -1, 1 << 32)
WORD = 0xFFFFFFFF


def _times(x: Column, factor: int) -> Column:
    """The low 32 bits of a product; in two halves, so that nothing overflows."""
    high = F.shiftleft((x * (factor >> 16)).bitwiseAND(0xFFFF), 16)
    return (x * (factor & 0xFFFF) + high).bitwiseAND(WORD)


def _xor_down(x: Column, *bits: int) -> Column:
    out = x
    for n in bits:
        out = out.bitwiseXOR(F.shiftrightunsigned(x, n))
    return out


def with_term_hash(df: DataFrame, term: str, name: str) -> DataFrame:
    """Add ``name``: the unsigned 32-bit hash (seed 42) of a term's UTF-8 bytes, as MLlib's vectors have it."""
    data = F.col(term).cast("binary")
    x, size, rest = F.col("_x"), F.col("_size"), F.col("_rest")
    rows = df.withColumns({"_data": data, "_size": F.octet_length(data).cast("bigint")})
    # The remaining bytes, the first one lowest: as hex digits in turn.
    whole = size - size % 4
    digits = F.hex(F.substring("_data", (whole + 1).cast("int"), F.lit(3)))
    turned = F.concat(F.substring("_rest", 5, 2), F.substring("_rest", 3, 2), F.substring("_rest", 1, 2))
    hashed = F.hash(F.substring("_data", F.lit(1), whole.cast("int"))).cast("bigint").bitwiseAND(WORD)
    rows = rows.withColumns({"_x": hashed, "_rest": digits})
    rows = rows.withColumns({"_x": _xor_down(x, 16), "_rest": F.conv(turned, 16, 10).cast("bigint")})
    # Back to the state before the hash was finished.
    rows = rows.withColumns({"_x": _times(x, INVERSE_M2), "_rest": F.coalesce(rest, F.lit(0).cast("bigint"))})
    rows = rows.withColumns({"_x": _xor_down(x, 13, 26), "_rest": _times(rest, C1)})
    rows = rows.withColumns({"_x": _times(x, INVERSE_M1), "_rest": F.shiftleft(rest, 15).bitwiseOR(F.shiftrightunsigned(rest, 17)).bitwiseAND(WORD)})
    rows = rows.withColumns({"_x": _xor_down(x, 16), "_rest": _times(rest, C2)})
    rows = rows.withColumn("_x", x.bitwiseXOR(whole).bitwiseXOR(rest).bitwiseXOR(size))
    for factor, bits in ((M1, 16), (M2, 13)):
        rows = rows.withColumn("_x", _xor_down(x, bits)).withColumn("_x", _times(x, factor))
    return rows.withColumn(name, _xor_down(x, 16)).drop("_data", "_size", "_rest", "_x")


def with_term_slot(df: DataFrame, term: str, size: int, name: str = "slot") -> DataFrame:
    """Add the slot of a term in a hashed vector: the hash as a signed number, its rest never negative."""
    rows = with_term_hash(df, term, "_hash")
    value = F.col("_hash") - F.when(F.col("_hash") > 0x7FFFFFFF, F.lit(1 << 32)).otherwise(F.lit(0))
    return rows.withColumn(name, F.pmod(value, F.lit(size)).cast("int")).drop("_hash")
