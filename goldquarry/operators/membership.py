"""A test that keeps rows from moving when no row of a smaller table can match them.

The keys of the smaller table set bits of a bitmap of fixed size, by one aggregate that merges the
bitmaps of all tasks; rows of the larger table whose bit is not set match nothing. Other rows may match, so the join that
follows decides.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Bits of one bitmap of Spark's, and the number of bitmaps: 4 MB in all, whatever the tables' sizes.
BITS = 32768
BITMAPS = 1024


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS * BITMAPS))


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(_bitmap, _bits) of the non-null keys: at most BITMAPS rows of 4 KB."""
    at = df.where(F.col(key).isNotNull()).select(_place(F.col(key)).alias("at"))
    number, position = F.floor(F.col("at") / BITS).cast("int"), F.col("at") % BITS
    return at.groupBy(number.alias("_bitmap")).agg(F.bitmap_construct_agg(position).alias("_bits"))


def possible_matches(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The rows of `df` whose key may be one of `other`'s, tested where they lie; null keys match nothing."""
    place = _place(F.col(key))
    tested = df.where(F.col(key).isNotNull()).withColumns(
        {"_bitmap": F.floor(place / BITS).cast("int"), "_at": (place % BITS).cast("int")}
    )
    byte = F.substring(F.col("_bits"), F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))
    bit = F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), F.col("_at") % 8)
    # At most BITMAPS rows.
    joined = tested.join(F.broadcast(key_bitmaps(other, key)), "_bitmap")
    return joined.where(bit == 1).select(*df.columns)
