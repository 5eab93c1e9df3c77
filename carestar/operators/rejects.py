"""Rows whose date has no calendar day: split from the accepted rows, counted while both are written.

A dated table with a reason column is written once, stored by reason: readers of
the accepted rows list only their folder, and rejected rows keep every column for
repair.  Row counts by reason come from ``DataFrame.observe`` on that write, so no
second pass reads the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "rejet"
ACCEPTED = "non"
MISSING, BEFORE, AFTER = "date_absente", "avant_calendrier", "apres_calendrier"
REASONS = (MISSING, BEFORE, AFTER)

COUNTS = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("motif", T.StringType()),
                       T.StructField("n_lignes", T.LongType()), T.StructField("conserve", T.IntegerType())])


def reason(date_key: Column, bounds: tuple[dt.date, dt.date]) -> Column:
    """Why a date has no day in the dense calendar ``[bounds]``, or ``ACCEPTED``."""
    start, end = (F.lit(d) for d in bounds)
    return (F.when(date_key.isNull(), MISSING).when(date_key < start, BEFORE).when(date_key > end, AFTER)
            .otherwise(ACCEPTED))


def write_split(df: DataFrame, path: str, table: str, keep: bool = False, then_by: Sequence[str] = (),
                sort: Sequence[str] = ()) -> list[tuple]:
    """Write ``df`` (with its reason column) once below ``path`` and return its counts as ``COUNTS`` rows.

    Accepted rows go to ``path/rejet=non`` (stored by ``then_by`` below it),
    rejected ones to the folder of their reason.  With ``keep`` the rows of every
    reason stay in the accepted rows (they carry a NULL key) and are only counted.
    """
    seen = Observation(f"rejects-{table}")
    counts = [F.sum(F.when(F.col(REASON) == r, 1).otherwise(0)).cast("bigint").alias(r) for r in (ACCEPTED, *REASONS)]
    out = df.observe(seen, *counts)
    if keep:
        out = out.withColumn(REASON, F.lit(ACCEPTED))
    if sort:
        out = out.sortWithinPartitions(REASON, *then_by, *sort)
    out.write.mode("overwrite").partitionBy(REASON, *then_by).parquet(path)
    found = seen.get
    return [(table, r, found[r] or 0, int(keep or r == ACCEPTED)) for r in (ACCEPTED, *REASONS)]


def accepted_path(path: str) -> str:
    return f"{path.rstrip('/')}/{REASON}={ACCEPTED}"


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejected rows below ``path``, with their reason."""
    return spark.read.parquet(path).filter(F.col(REASON) != ACCEPTED)
