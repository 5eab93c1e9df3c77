"""Data-quality audits as mergeable states.

A load is audited with one keyed aggregate.  Its state has a row per key bucket
(whole-number keys: a bitmap of 32,768 ids) or per key (other types), with row
and error counts; states of several loads merge, so the audit of everything
landed needs only the new load's rows.  Several tables cut from one frame
(admissions, and the prescriptions among them) share its one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bitmaps


@dataclass(frozen=True)
class Audited:
    """One audited table: the rows of the frame where ``where`` holds, and what counts as an error there."""
    table: str
    metrics: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None


def audit_state(df: DataFrame, key: str, tables: Sequence[Audited]) -> DataFrame:
    """``table_name, part, n, seen, errors``: one aggregate over ``df`` for all of ``tables``.

    ``part`` is the bucket of the key (``seen``: bitmap of its ids) or the key
    itself (``seen`` NULL); rows without a key form the NULL part.
    """
    whole = bitmaps.fits(df, key)
    k = F.col(key).cast("bigint") if whole else F.col(key).cast("string")
    part = F.bitmap_bucket_number(k) if whole else k
    aggs = []
    for i, t in enumerate(tables):
        on = F.lit(True) if t.where is None else F.coalesce(t.where, F.lit(False))
        aggs.append(F.sum(F.when(on, 1).otherwise(0)).cast("bigint").alias(f"n{i}"))
        if whole:
            aggs.append(F.bitmap_construct_agg(F.when(on, F.bitmap_bit_position(k))).alias(f"seen{i}"))
        aggs += [F.sum(F.when(on & cond, 1).otherwise(0)).cast("bigint").alias(f"e{i}_{j}")
                 for j, cond in enumerate(t.metrics.values())]
    wide = df.groupBy(part.cast("string").alias("part")).agg(*aggs)

    def row(i: int, t: Audited) -> Column:
        errors = [x for j, m in enumerate(t.metrics) for x in (F.lit(m), F.col(f"e{i}_{j}"))]
        return F.struct(F.lit(t.table).alias("table_name"), F.col(f"n{i}").alias("n"),
                        (F.col(f"seen{i}") if whole else F.lit(None).cast("binary")).alias("seen"),
                        (F.create_map(*errors) if errors else F.lit(None)).cast("map<string,bigint>").alias("errors"))
    return (wide.select("part", F.explode(F.array(*[row(i, t) for i, t in enumerate(tables)])).alias("r"))
            .select("r.table_name", "part", "r.n", "r.seen", "r.errors"))


def table_totals(states: DataFrame) -> DataFrame:
    """``table_name, total, distincts``: rows and distinct keys (no key: one key) over all states."""
    maps = states.filter(F.col("seen").isNotNull()).groupBy("table_name", "part").agg(
        F.sum("n").alias("n"), F.bitmap_or_agg("seen").alias("seen"))
    ids = F.when(F.col("part").isNotNull(), F.bitmap_count("seen")).otherwise((F.col("n") > 0).cast("bigint"))
    keys = states.filter(F.col("seen").isNull()).groupBy("table_name", "part").agg(F.sum("n").alias("n"))
    both = (maps.select("table_name", "n", ids.alias("k"))
            .unionByName(keys.select("table_name", "n", (F.col("n") > 0).cast("bigint").alias("k"))))
    return both.groupBy("table_name").agg(F.sum("n").alias("total"), F.sum("k").alias("distincts"))


def audit_report(states: DataFrame) -> DataFrame:
    """Long ``table_name, metric, value`` rows: ``total``, ``doublons`` (rows beyond the first per key), errors."""
    totals = table_totals(states).select("table_name", "total", (F.col("total") - F.col("distincts")).alias("doublons"))
    errors = (states.select("table_name", F.explode("errors").alias("metric", "value"))
              .groupBy("table_name", "metric").agg(F.sum("value").alias("value")))
    return totals.unpivot("table_name", ["total", "doublons"], "metric", "value").unionByName(errors)


def duplicate_report(states: DataFrame) -> DataFrame:
    """``table_name, avant, apres, supprimes``: rows, distinct keys, and the difference."""
    return table_totals(states).select("table_name", F.col("total").alias("avant"), F.col("distincts").alias("apres"),
                                       (F.col("total") - F.col("distincts")).alias("supprimes"))


def store_load(state: DataFrame, path: str, load: str) -> None:
    """Store the state of one load below ``path``; storing it again replaces it."""
    (state.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load").parquet(path))
