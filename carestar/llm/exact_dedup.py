"""Exact dedup by content sort.

Sampled splitters range-partition the normalised text, the external sort of
each partition places equal texts next to each other, and neighbouring rows are
compared on the whole text.  One row of each run stays.  A splitter holds the
first characters of a text and a hash of all of it, so the sample that the
driver sees does not grow with the texts; texts that share both stay in one
partition, where the sort tells them apart.

Texts shared by more than ``1 / hot_share`` of all rows (at most ``hot_share``
such texts) are found beforehand with a partially aggregated count and dealt
into pieces, so that no task receives a large group whole; the few
representatives of the pieces are then compared on the whole text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, quoted, text_of, written

# A piece of a group never holds fewer rows than this, however small the input
MIN_PIECE_ROWS = 500
# Characters of a text in a splitter
LEAD_CHARS = 32


def _runs(docs: DataFrame, id_col: str, text_col: str, keep: str, hot_share: int, carry: list[str]) -> DataFrame:
    """One row per input row: its place in the run of equal texts of its piece.

    With columns to ``carry`` only the first row of each run, with these columns; the
    text is moved once, among them, and normalised again behind the shuffle.
    The result of ``drop_exact_copies`` reads this table as long as anything reads
    that result, so no other row's text is in it.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be 'min' or 'max', not {keep!r}")
    best = F.min if keep == "min" else F.max

    own = F.struct(*[F.col(quoted(c)) for c in carry]) if carry else F.lit(True)
    rows = docs.select(F.col(id_col).alias("_id"), lower_ascii(text_of(text_col)).alias("_norm"), own.alias("_own"))
    rows = rows.withColumn("_hash", F.xxhash64("_norm"))
    limit = max(MIN_PIECE_ROWS, docs.select(F.lit(1)).count() // hot_share)
    # at most hot_share hashes can each own more than 1 / hot_share of the rows
    hot = (rows.groupBy("_hash").count().filter(F.col("count") > limit)
           .select("_hash", F.ceil(F.col("count") / limit).cast("int").alias("_pieces")))
    rows = (rows.join(F.broadcast(hot), "_hash", "left")
            .withColumn("_piece", F.when(F.col("_pieces").isNotNull(),
                                         F.pmod(F.xxhash64("_id", F.lit(7)), F.col("_pieces")).cast("int"))
                        .otherwise(F.lit(0)))
            .select(F.substring("_norm", 1, LEAD_CHARS).alias("_lead"), "_hash", "_piece", "_norm", "_id", "_own",
                    F.col("_pieces").isNotNull().alias("_hot")))

    run = Window.partitionBy("_lead", "_hash", "_piece", "_norm")
    rows = (rows.drop("_norm") if carry else rows).repartitionByRange("_lead", "_hash", "_piece")
    if carry:
        own_text = F.coalesce(F.col("_own").getField(text_col).cast("string"), F.lit(""))
        rows = rows.withColumn("_norm", lower_ascii(own_text))
    runs = (rows.withColumn("_rank", F.row_number().over(run.orderBy(_first(keep)("_id"))))
            .withColumn("_best", best("_id").over(run))
            .withColumn("_n", F.count(F.lit(1)).over(run))
            .select("_id", "_piece", "_hot", "_rank", "_best", "_n", F.sha2("_norm", 256).alias("_sha"),
                    F.when(F.col("_hot") & (F.col("_rank") == 1), F.col("_norm")).alias("_norm"),
                    F.when(F.col("_rank") == 1, F.col("_own")).alias("_own")))
    if carry:
        runs = runs.filter("_rank = 1").withColumn("_sha", F.when(F.col("_hot"), F.col("_sha")))
    return written(runs, "exact-dedup")


def _first(keep: str):
    return F.asc_nulls_last if keep == "min" else F.desc_nulls_last


def _pieces(runs: DataFrame, keep: str) -> DataFrame:
    """The pieces of hot texts, compared on the whole text: one representative each, at most 2 * hot_share rows."""
    best = F.min if keep == "min" else F.max
    whole = Window.partitionBy("_norm")
    return (runs.filter(F.col("_hot") & (F.col("_rank") == 1))
            .select("_norm", "_sha", "_piece", best("_best").over(whole).alias("keep_id"),
                    F.sum("_n").over(whole).alias("group_size"),
                    F.row_number().over(whole.orderBy(_first(keep)("_best"), "_piece")).alias("_winner"))
            .drop("_norm"))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                hot_share: int = 20_000) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z.  Of equal texts the
    row with the smallest (``keep="max"``: largest) id stays.

    Defined cases: a null text counts as empty; a null id ranks behind every
    other id, so it stays only if its whole group has none (``keep_id`` is then
    null); of rows that repeat with the same id and text exactly one stays; an
    empty table gives an empty result; other columns of the input are ignored,
    whatever their names.
    """
    runs = _runs(docs, id_col, text_col, keep, hot_share, []).drop("_own")
    out = [F.col("_id").alias("doc_id"), F.col("keep_id"), F.col("group_size"), F.col("kept"),
           F.col("_sha").alias("text_sha256")]
    plain = runs.filter(~F.col("_hot")).select(
        "*", F.col("_best").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_rank") == 1).alias("kept")).select(*out)
    split = (runs.filter("_hot").drop("_norm").join(F.broadcast(_pieces(runs, keep)), ["_sha", "_piece"])
             .withColumn("kept", (F.col("_rank") == 1) & (F.col("_winner") == 1)).select(*out))
    return plain.unionByName(split)


def drop_exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
                      hot_share: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their columns unchanged.

    Defined cases: as in ``exact_dedup``; a very long text is compared whole; a
    kept row keeps its nulls; columns may have any names, with dots too.
    """
    runs = _runs(docs, id_col, text_col, keep, hot_share, docs.columns)
    hot = (runs.filter("_hot").drop("_norm")
           .join(F.broadcast(_pieces(runs, keep).filter("_winner = 1")), ["_sha", "_piece"]).select("_own"))
    return runs.filter(~F.col("_hot")).select("_own").unionByName(hot).select("_own.*")
