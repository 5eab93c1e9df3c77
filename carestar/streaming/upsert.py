"""T1 with K1: a stream merged into a snapshot table by key.

Rows are stored by bucket of their key, so every version of a key, whatever its
dates, lies in one partition: an update that moves a row to another month still
replaces the old one.  A micro-batch reads and rewrites only the buckets it
touches, keeps the latest version of each key there, and becomes visible in one
commit that also records the batch: a replay finds its number and does nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import dedup
from ..sinks.snapshots import SnapshotTable

BUCKET = "key_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))


def merge_batch(table: SnapshotTable, batch: DataFrame, batch_id: int, keys: Sequence[str], order_by: Sequence[str],
                buckets: int, stream: str = "upsert") -> bool:
    """Merge one micro-batch; False when it had been applied before.

    The latest version of a key has the greatest ``order_by`` values; among
    equal ones the remaining columns decide, so arrival order never does.
    """
    base = table.manifest()
    if base.batches.get(stream, -1) >= batch_id:
        return False
    new = with_bucket(batch, keys, buckets)
    # at most ``buckets`` values
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
    if not touched:
        return True
    rows = new
    if base.schema is not None:
        rows = table.read(base.number, touched).unionByName(new)
    merged = dedup(rows, [*keys, BUCKET], order_by, keep="last").select(*new.columns)
    # a bucket is one folder of the table, written by as many tasks as its rows need
    folders = table.write_parts(merged.hint("rebalance", BUCKET))
    table.commit(base, merged.schema, folders, batch=(stream, batch_id))
    return True


def stream_upsert(spark: SparkSession, in_dir: str, path: str, checkpoint: str, schema: T.StructType,
                  keys: Sequence[str], order_by: Sequence[str], buckets: int = 16, fmt: str = "parquet",
                  max_files_per_trigger: int = 1000) -> SnapshotTable:
    """Merge every file landed in ``in_dir`` that the checkpoint has not seen yet, then stop."""
    table = SnapshotTable(spark, path, BUCKET)
    src = (spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(in_dir))

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge_batch(table, batch, batch_id, keys, order_by, buckets)

    q = (src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return table
