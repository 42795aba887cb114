"""Cut a long history to a small set of keys before anything shuffles it.

A Bloom filter (one hash) of the keys is built by an aggregate as bitmaps of
32,768 bits, one row a bucket. ``bits`` bounds it, whatever the number of keys:
2**26 bits are 2,048 buckets of 4 KB, 8 MB in all, so it may be broadcast at every
size of the input. Each row of the history looks its bucket up and tests its bit;
rows of other keys pass with a chance of keys / bits (1.5 % for a million keys).
The cut is a filter, not a semi-join: an exact join on what is left follows where
rows of other keys would matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BITS = 32_768          # fixed value: the width of Spark's bitmap aggregates


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(bits))


def _place_as(df: DataFrame, key: str, other: T.DataType, bits: int) -> Column:
    """The key's place; an integer key meets one of another width as a long."""
    mine = df.schema[key].dataType
    if mine != other and isinstance(mine, T.IntegralType) and isinstance(other, T.IntegralType):
        return F.pmod(F.xxhash64(F.col(f"`{key}`").cast("long")), F.lit(bits))
    return _place(key, bits)


def key_bitmaps(keys: DataFrame, key: str, bits: int = 1 << 26, place: Column | None = None) -> DataFrame:
    """_bucket, _bitmap of the keys (null keys: none)."""
    h = _place(key, bits) if place is None else place
    return (keys.filter(F.col(f"`{key}`").isNotNull())
                .groupBy(F.floor(h / BUCKET_BITS).cast("int").alias("_bucket"))
                .agg(F.bitmap_construct_agg(F.pmod(h, F.lit(BUCKET_BITS))).alias("_bitmap")))


def cut_to_keys(history: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """The rows of ``history`` whose key is, or by chance looks like, one of ``keys``.

    Rows with a null key go: they equal no key. Keys of types that hash differently
    (other than integers of two widths) leave the history as it is.
    """
    theirs, mine = keys.schema[key].dataType, history.schema[key].dataType
    if theirs != mine and not (isinstance(theirs, T.IntegralType) and isinstance(mine, T.IntegralType)):
        return history
    bitmaps = F.broadcast(key_bitmaps(keys, key, bits, _place_as(keys, key, mine, bits)))
    h = _place_as(history, key, theirs, bits)
    at = F.pmod(h, F.lit(BUCKET_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.pmod(at, F.lit(8))) == 1
    return history.filter(F.col(f"`{key}`").isNotNull()).join(
        bitmaps, (F.floor(h / BUCKET_BITS).cast("int") == F.col("_bucket")) & hit, "left_semi")
