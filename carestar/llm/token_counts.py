"""Token counts of documents in flat token files, by a separator scan.

A token file is a bare run of little-endian 16-bit ids in which each document
ends with the end-of-document id; nothing says where documents start.  Files are
cut into blocks of equal size; each block is searched for separators with one
vectorised comparison, and a prefix scan over a file's blocks stitches the
documents that cross block boundaries.  The scan sees three numbers of a block;
its separators stay where they were found until they are joined back by block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestar.session import scratch_path, ship_package

from .bpe import _slices, _texts, byte_bpe, default_pattern, default_tokenizer
from .common import written

# Free in the vocabulary; ids up to it fit in two bytes
END_OF_DOCUMENT = 50256
BLOCK_BYTES = 4 << 20
# The largest id that two bytes hold
MOST_ID = 65535


def _open(path: str, mode: str):
    """A file of a shared folder, by any address Arrow's file systems know."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        path = "file://" + path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    store, inner = fs.FileSystem.from_uri(path)
    if mode == "r":
        return store.open_input_file(inner)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inner)


def write_token_files(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_OF_DOCUMENT, tokenizer_file: str | None = None,
                      pattern: str | None = None) -> DataFrame:
    """Encode texts into flat token files below the shared folder.

    Each task writes one file in the order of its rows.  Returns the order of
    documents (``path, ordinal, doc_id``), read back from the shared folder; a
    file that a lost or repeated task attempt left behind is in no row of it.
    Lengths are not recorded.  A null text counts as empty: only its end id is written.
    A token id that two bytes cannot hold, or that is the end id, fails the job.
    """
    if not 0 <= end_id <= MOST_ID:
        raise ValueError(f"end_id must be from 0 to {MOST_ID}, not {end_id}")
    ship_package(docs.sparkSession)
    file, pat = tokenizer_file or default_tokenizer(), pattern or default_pattern()
    base = scratch_path(docs.sparkSession, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, out, at = byte_bpe(file, pat), None, 0
        path = f"{base}/{uuid.uuid4().hex}.bin"
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for part in _slices(batch):
                out = out or _open(path, "w")
                for text in part.column("text").to_pylist():
                    ids = np.frombuffer(bpe.ids(text), "<u4")
                    if len(ids) and (ids.max() > MOST_ID or (ids == end_id).any()):
                        raise ValueError(f"token ids must be at most {MOST_ID} and not the end id {end_id}")
                    out.write(ids.astype("<u2").tobytes() + end)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array(np.arange(at, at + n)), part.column("doc_id")],
                    names=["path", "ordinal", "doc_id"])
                at += n
        if out is not None:
            out.close()

    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(write, f"path string, ordinal bigint, doc_id {kind}"), "token-order")


def count_tokens(paths: DataFrame, *, end_id: int = END_OF_DOCUMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, ordinal, n_tokens``: tokens of each document, without its end id.

    ``paths`` has one column ``path``; repeated and null paths count once and not
    at all.  ``block_bytes`` must be even.  Tokens after a file's last end id
    form one more document only if there are any; an empty file has none.
    """
    ship_package(paths.sparkSession)
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            n = []
            for p in names:
                with _open(p, "r") as f:
                    n.append(f.size())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n, pa.int64())],
                                             names=["path", "bytes"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist()):
                with _open(path, "r") as f:
                    size = f.size()
                    f.seek(block * block_bytes)
                    tokens = np.frombuffer(f.read(min(block_bytes, size - block * block_bytes)), "<u2")
                first = block * (block_bytes // 2)
                ends = np.flatnonzero(tokens == end_id) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block]), pa.array([first + len(tokens)]),
                     pa.array([ends], pa.list_(pa.int64()))], names=["path", "block", "upto", "ends"])

    files = (paths.select(F.col("path").cast("string")).filter("path IS NOT NULL").distinct()
             .mapInArrow(sizes, "path string, bytes bigint").filter("bytes > 0"))
    blocks = files.select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / block_bytes).cast("long"))).alias("block"))
    found = written(blocks.repartition("path", "block").mapInArrow(
        scan, "path string, block bigint, upto bigint, ends array<bigint>"), "token-ends")
    # prefix scan over the blocks of a file: documents ended so far, and where the last one ended
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("path")
    scanned = (found.select("path", "block", F.size("ends").alias("_n"), F.get("ends", F.size("ends") - 1).alias("_at"))
               .select("path", "block",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ordinal"),
                       F.coalesce(F.max("_at").over(before), F.lit(-1).cast("long")).alias("_last"),
                       F.max("block").over(every).alias("_final")))
    stitched = found.join(scanned.hint("merge"), ["path", "block"])
    # the end of the file closes a document without end id
    stitched = stitched.withColumn("_end", F.when(F.size("ends") > 0, F.element_at("ends", -1))
                                   .otherwise(F.col("_last")))
    closed = F.when((F.col("block") == F.col("_final")) & (F.col("_end") < F.col("upto") - 1),
                    F.concat("ends", F.array("upto"))).otherwise(F.col("ends"))
    return (stitched.withColumn("_all", F.concat(F.array("_last"), closed))
            .select("path", "_ordinal", "_all", F.posexplode(F.slice("_all", 2, F.lit(2147483647))))
            .select("path", (F.col("_ordinal") + F.col("pos")).cast("long").alias("ordinal"),
                    (F.col("col") - F.get("_all", F.col("pos")) - 1).alias("n_tokens")))


def document_token_counts(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_tokens`` for every row of ``docs``: write token files, scan them, give counts back.

    Defined cases: a null text has 0 tokens; repeated rows are counted each; a very
    long text is one run over as many blocks as it takes; an empty table gives an
    empty result; other input columns are ignored, whatever their names.
    """
    order = write_token_files(docs, **options)
    counts = count_tokens(order.select("path"), end_id=options.get("end_id", END_OF_DOCUMENT))
    # both sides grow with the documents, and their compressed sizes mislead the planner
    return order.join(counts.hint("merge"), ["path", "ordinal"]).select("doc_id", "n_tokens")
