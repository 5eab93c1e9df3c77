"""Removal of repeated byte strings by distributed prefix doubling.

Every position starts with the rank of its first 8 bytes.  Each round sorts the
pairs (rank here, rank one offset on) with Spark and gives equal pairs a common
rank, so ranks stand for strings of 8, 16, 32 ... bytes up to the length asked for.
A position whose pair is unique leaves, as no longer string that starts there can
repeat; with it leave the positions whose second half it was.

Ranks name strings exactly (no hash).  The first round moves a row for every byte
of text, so the query over whole corpora counts minimiser windows instead
(``suffix_dedup``), and this module is the exact measure it is tested against.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from carestar.session import ship_package

from .common import discard, text_of, written

# Bytes of the first ranks: as many as a 64-bit number holds
FIRST = 8
# Positions in a batch of the first round
_BATCH = 1 << 18


def _first_ranks(length: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, raw in zip(batch.column("base").to_pylist(), batch.column("raw")):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                if len(raw) < length:
                    continue
                eights = np.lib.stride_tricks.sliding_window_view(raw, FIRST)
                for i in range(0, len(eights), _BATCH):
                    part = np.ascontiguousarray(eights[i:i + _BATCH]).view("<i8").ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(base + i + np.arange(len(part))), pa.array(part)],
                                                     names=["pos", "rank"])
    return rank


def _reranked(pairs: DataFrame) -> DataFrame:
    """Positions of pairs that occur twice or more, ranked by the least position of the pair.

    Pairs are counted before they are shuffled, and the merge join sorts both
    sides by the pair, so that a hot pair is split by the adaptive skew join.
    """
    pair = [c for c in pairs.columns if c != "pos"]
    ranks = (pairs.groupBy(*pair).agg(F.count(F.lit(1)).alias("_n"), F.min("pos").alias("_rank"))
             .filter("_n > 1").drop("_n"))
    return pairs.join(ranks.hint("merge"), pair).select("pos", F.col("_rank").alias("rank"))


def repeated_starts(rows: DataFrame, length: int) -> DataFrame:
    """``pos``: starts of strings of ``length`` bytes that start twice or more, for texts ``base, raw``.

    ``base`` is the place of a text's first byte; texts must lie at least one
    byte apart.  Every round is written, so a lost executor costs one round.
    """
    if length < FIRST:
        raise ValueError(f"length must be at least {FIRST}, not {length}")
    ship_package(rows.sparkSession)
    now = written(_reranked(rows.mapInArrow(_first_ranks(length), "pos bigint, rank bigint")), "doubling")
    size = FIRST
    while size < length:
        # halves may overlap, so the last round need not double
        step = min(size, length - size)
        onward = now.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("_next"))
        after = written(_reranked(now.join(onward.hint("merge"), "pos")), "doubling")
        discard(now)
        now, size = after, size + step
    return now.select("pos")


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, base, raw``: the texts' bytes at places that never touch, numbered in one write."""
    number = F.monotonically_increasing_id()
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.encode(text_of(text_col), "UTF-8").alias("raw"),
                               number.alias("_row")), "doubling-texts")
    part, at = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    most = rows.agg(F.max(at).alias("rows"), F.max(F.octet_length("raw")).alias("bytes")).first()
    return rows.select("doc_id", "raw", ((part * ((most.rows or 0) + 1) + at) * ((most.bytes or 0) + 1)).alias("base"),
                       F.lit((most.bytes or 0) + 1).cast("long").alias("room"))


def remove_repeats_by_doubling(docs: DataFrame, *, length: int = 400, id_col: str = "doc_id",
                               text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, as ``suffix_dedup.remove_repeats`` gives them.

    Defined cases: a null text is empty; a text shorter than ``length`` stays
    whole; rows that repeat count as repeats of each other; null ids are ids like
    others, and ids may be of any atomic type; an empty table gives an empty
    result; other input columns are ignored.  A task holds the starts of one
    document at a time.
    """
    rows = _placed(docs, id_col, text_col)
    kind, id_type = rows.schema["doc_id"].dataType.simpleString(), to_arrow_type(rows.schema["doc_id"].dataType)
    room = rows.select("room").first()
    starts = repeated_starts(rows.select("base", "raw"), length)
    starts = (starts.withColumn("base", F.col("pos") - F.pmod("pos", F.lit(room.room if room else 1)))
              .groupBy("base").agg(F.collect_list(F.col("pos") - F.col("base")).alias("starts")))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, raw, own in zip(batch.column("doc_id").to_pylist(), batch.column("raw"), batch.column("starts")):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                own = own.values.to_numpy() if own.is_valid else np.zeros(0, np.int64)
                cover = np.zeros(len(raw) + 1, np.int64)
                np.add.at(cover, own, 1)
                np.add.at(cover, own + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.select("doc_id", "base", "raw").join(starts, "base", "left").drop("base").mapInArrow(
        remove, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
