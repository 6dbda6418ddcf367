"""A bitmap of key hashes, tested where rows are read, so that most rows without a match are not shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^26 bits are 8 MB to broadcast, whatever the size of either table. More keys only let more rows through.
BITS = 1 << 26


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1


def may_match(df: DataFrame, key: str, members: DataFrame, member: str | None = None) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``members``, and, by chance, a few others; rows with a null key are left out.

    It narrows what a join has to move and never loses a match; the join itself must follow, or what follows must bear
    the others.
    """
    place = _place(F.col(member or key))
    bitmaps = (members.where(F.col(member or key).isNotNull())
               .groupBy(F.bitmap_bucket_number(place).alias("_bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")))
    own = _place(F.col(key))
    position = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.expr("substring(_bitmap, CAST(_position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    return (df.where(F.col(key).isNotNull())
            .withColumns({"_bucket": F.bitmap_bucket_number(own), "_position": position})
            .join(F.broadcast(bitmaps), "_bucket")
            .where(F.getbit(byte, (F.col("_position") % 8).cast("int")) == 1)
            .select(*[f"`{c}`" for c in df.columns]))
