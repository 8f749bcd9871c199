"""Bit sets of bounded size over hashed keys, in DataFrame functions: a broadcast filter that never misses a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import cut_lineage

LEAST_BITS, MOST_BITS, BITS_PER_KEY = 20, 27, 32
BITMAP = 8 * 4096  # bits of one row of a bit set, as bitmap_construct_agg makes them


def _bit(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(2**bits))


def bits_of(keyed: DataFrame, keys: list[str], most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """((block, bitmap), the number of bits as a power of two): the bits of the keys of `keyed`, at most 2**most_bits.

    There are 2**LEAST_BITS bits or BITS_PER_KEY a row of `keyed`, so at most 16 MB. `keyed` is read twice.
    """
    bits = min(most_bits, max(min(LEAST_BITS, most_bits), (BITS_PER_KEY * keyed.count()).bit_length()))
    at = keyed.select(_bit(keys, bits).alias("bit"))
    made = at.groupBy(F.expr(f"bit div {BITMAP}").alias("block")).agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bitmap"))
    return cut_lineage(made), bits


def marked(rows: DataFrame, keys: list[str], set_: tuple[DataFrame, int], name: str) -> DataFrame:
    """`rows` with a boolean column `name`: whether the bit of `keys` is set. Narrow: the set is broadcast."""
    bit_set, bits = set_
    named = bit_set.select(F.col("block").alias("_block"), F.col("bitmap").alias("_bitmap"))
    at = rows.withColumn("_at", _bit(keys, bits)).withColumn("_block", F.expr(f"_at div {BITMAP}"))
    byte = F.conv(F.hex(F.substring("_bitmap", F.expr(f"cast(_at % {BITMAP} div 8 + 1 AS int)"), F.lit(1))), 16, 10).cast("int")
    joined = at.join(F.broadcast(named), "_block", "left")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 AS int))")) != 0
    return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_at", "_block", "_bitmap")
