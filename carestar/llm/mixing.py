"""Mixing sources to target weights with hash-threshold histograms.

Each document has a fixed 60-bit hash of its id.  A source's budget becomes a
threshold on that hash: documents below it are taken (once more).  The threshold
is found without sorting documents: sum the sizes by source and hash bucket,
find the bucket in which the budget ends, and refine only that bucket, level by
level.  A larger budget takes a superset of what a smaller one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, quoted, text_of, written

HASH_BITS, LEVEL_BITS = 60, 15


def mix_hash(doc_id: Column) -> Column:
    """Uniform 60-bit number of an id; the same in every run. A null id hashes as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, take the weights in turn.  They share
    ``share`` of all sizes by weight; no target exceeds ``most`` times its
    source's size, and what is over goes to the others by weight.  That is
    ``min(most * size, level * weight)`` for one level, found over the sources
    sorted by where they fill up (one row per source).
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("_w", F.get(w, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("_full_at", F.col("_cap") / F.col("_w"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.orderBy("_full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    levels = (ranked.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("_all_w", F.sum("_w").over(everything))
              .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                          / (F.col("_all_w") - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))))
    # the first source that does not fill up sets the level; with none, all stop at their cap
    return (levels.withColumn("_set", F.min(F.when(F.col("_level") <= F.col("_full_at"),
                                                   F.struct("_full_at", "_level"))).over(everything))
            .select("source", "source_size",
                    F.least("_cap", F.coalesce(F.col("_set._level") * F.col("_w"), F.col("_cap"))).alias("target")))


def mix_plan(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """``source, source_size, target, base, below``: every document is taken ``base`` times, those with a hash under ``below`` once more.

    ``rows`` has ``source, size`` and the document's hash ``u``.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, share, most)
    plan = plan.withColumn("base", F.when(F.col("source_size") > 0,
                                          F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = written(plan.withColumn("_need", F.col("target") - F.col("base") * F.col("source_size")), "mix-plan")

    edge = plan.filter("_need > 0").select(F.col("source").alias("_s"), F.lit(0).cast("long").alias("_prefix"), "_need")
    for left in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = F.shiftright("u", left + LEVEL_BITS) == F.col("_prefix")
        histogram = (rows.join(edge, F.col("source").eqNullSafe(F.col("_s")) & inside)
                     .groupBy("_s", F.shiftright("u", left).alias("_bucket"))
                     .agg(F.sum("size").alias("_size"), F.first("_need").alias("_need")))
        upto = Window.partitionBy("_s").orderBy("_bucket")
        edge = (histogram.withColumn("_upto", F.sum("_size").over(upto))
                .filter("_upto > _need AND _upto - _size <= _need")
                .select("_s", F.col("_bucket").alias("_prefix"),
                        (F.col("_need") - (F.col("_upto") - F.col("_size"))).alias("_need"), "_size"))
        edge = written(edge, "mix-edge")
    # one hash value is left for each source: take it if that comes nearer to the target
    cut = edge.select("_s", (F.col("_prefix") + F.when(F.col("_size") < 2 * F.col("_need"), 1).otherwise(0))
                      .alias("below"))
    return (plan.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", "source_size", "target", "base", F.coalesce("below", F.lit(0)).alias("below")))


def _narrow(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               count_words(text_of(text_col)).alias("size"),
                               mix_hash(F.col(id_col)).alias("u")), "mix-rows")


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies, taken``.

    A document is taken ``copies`` times; ``taken = copies * size`` words.  Each
    source's taken words differ from its target by at most half of what one hash
    value holds (one document).  ``most`` bounds the copies.

    Defined cases: a null text has size 0; a null source is a source of its own,
    last in order; null ids share one hash value and rows that repeat an id are
    taken alike; if all sizes are 0 nothing is taken; an empty table gives an
    empty result; other input columns are ignored.
    """
    rows = _narrow(docs, id_col, source_col, text_col)
    plan = mix_plan(rows, weights, share, most).withColumnRenamed("source", "_src")
    copies = F.col("base") + F.when(F.col("u") < F.col("below"), 1).otherwise(0)
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("_src")))
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))


def take_mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sources`` takes it, with their columns unchanged.

    The plan has one row per source and is joined to the documents as they lie.

    Defined cases: as in ``mix_sources``; a row is taken with its own null text,
    null source or null id, and a very long text whole; an empty table gives an
    empty result; columns may have any names, with dots or those of the plan too.
    """
    plan = mix_plan(_narrow(docs, id_col, source_col, text_col), weights, share, most)
    copies = F.col("base") + F.when(mix_hash(F.col("id")) < F.col("below"), 1).otherwise(0)
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("from"))
    return (rows.join(plan, F.col("from").eqNullSafe(F.col("source")))
            .select("row", F.explode(F.array_repeat(F.lit(True), copies.cast("int"))))
            .select("row.*"))
