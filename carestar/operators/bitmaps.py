"""Exact distinct counts of whole-number ids as mergeable bitmaps.

An id is a bit of the bitmap of its bucket (32,768 ids).  Bitmaps are built on
the mappers, so a distinct count shuffles one bitmap per bucket instead of a row
per id, several distinct counts need no expanded rows, and stored bitmaps of
parts (months, hospitals) merge into those of the whole, which counts do not.
A bitmap takes 4 KB: group by few, well-filled groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def fits(df: DataFrame, col: str) -> bool:
    """True when the column holds whole numbers, so that its values can be bits."""
    return isinstance(df.schema[col].dataType, WHOLE)


def bitmaps(df: DataFrame, by: Sequence[str], col: str, when: Column | None = None) -> DataFrame:
    """``by…, bucket, bitmap`` of the non-NULL ids of ``col`` (of the rows where ``when`` holds)."""
    kept = df.filter(F.col(col).isNotNull() if when is None else F.col(col).isNotNull() & when)
    v = F.col(col).cast("bigint")
    return (kept.groupBy(*by, F.bitmap_bucket_number(v).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap")))


def merge(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of finer groups -> bitmaps of ``by``."""
    return maps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per group of ``by``; the bitmaps have one row per (by, bucket)."""
    return maps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))


def distinct_total(df: DataFrame, col: str) -> DataFrame:
    """One row, one column: the number of distinct non-NULL values of ``col``."""
    if not fits(df, col):
        return df.agg(F.count_distinct(col))
    return count(bitmaps(df, [], col), [], "n")
