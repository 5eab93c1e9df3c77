"""Sinks: idempotent per-source reload, replace, append, exports, run log.

Writes go to shared storage (paths under ``spark.checkpoint.dir`` in the
query library).  Reloads are idempotent through dynamic partition overwrite:
re-landing one source replaces exactly that source's partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K


def reload_by_source(df: DataFrame, path: str, source_col: str = "source_file",
                     sources: Sequence[str] = ()) -> None:
    """Replace the partitions of the sources present in ``df``, keep the others.

    ``sources`` names the reloaded sources; one that has no row now loses its
    partition, as its old rows are gone from it.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(source_col).parquet(path))
    if sources:
        _drop_sources(df, path, source_col, sources)


def _drop_sources(df: DataFrame, path: str, source_col: str, sources: Sequence[str]) -> None:
    """Delete the partitions of those ``sources`` that ``df`` has no row of."""
    spark = df.sparkSession
    there = df.filter(F.col(source_col).isin(list(sources))).select(source_col).distinct()
    empty = set(sources) - {r[0] for r in there.collect()}   # at most one row per named source
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not empty or not fs.exists(root):
        return
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for name in sorted(empty):
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, escape(source_col, name)), True)


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def for_export(df: DataFrame) -> DataFrame:
    """Booleans as 0/1; texts whole, whatever their length."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)


MANIFEST = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("project", T.StringType()), T.StructField("exported_at", T.StringType()),
    T.StructField("nb_tables", T.LongType()), T.StructField("total_lignes", T.LongType()),
])


def export_tables(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, project: str = "carestar",
                  exported_at: str = K.COMPUTED_AT) -> DataFrame:
    """Write one Parquet folder per non-empty table and return the manifest, a
    row per table with both totals (tables exported, rows in all of them).

    Rows are counted by ``observe`` while they are written; no file is read
    again.  A table without rows leaves no folder and no manifest row; without
    any row the manifest is empty.  The manifest is stored as ``_manifest``.
    """
    base, counts = path.rstrip("/"), []
    fs = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, df in tables.items():
        seen = Observation(f"export-{name}")
        target = f"{base}/{name}"
        for_export(df).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
        if n := seen.get["n"]:
            counts.append((name, n))
        else:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(target), True)
    total = sum(n for _, n in counts)
    rows = [(name, n, project, exported_at, len(counts), total) for name, n in counts]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{base}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{base}/_manifest")


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("dag_name", T.StringType()),
    T.StructField("task_name", T.StringType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()), T.StructField("records", T.LongType()),
    T.StructField("error", T.StringType()), T.StructField("source", T.StringType()),
])


def log_events(events: DataFrame, path: str) -> None:
    """Append run-log events (a start event and later an end event per run)."""
    events.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG_SCHEMA.fields]).write.mode("append").parquet(path)


def latest_runs(log: DataFrame) -> DataFrame:
    """Latest event per ``run_id`` — the "update by run id" of a row store,
    expressed on an append-only log (one aggregate, no window)."""
    from ..operators.quality import dedup
    return dedup(log, ["run_id"], ["event_time", "status"], keep="last")
