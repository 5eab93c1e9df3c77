"""T2 — bed-sensor occupancy in 4-hour event-time windows per hospital.

``withWatermark`` bounds the state: a window is emitted once the watermark
(latest event time seen − allowed lateness) passes its end, and rows older
than the watermark are dropped as late.  Duplicate sensor readings inside the
watermark are dropped by ``dropDuplicatesWithinWatermark``.  Append output
to a file sink, exactly once through the checkpoint.

Event time must be a TIMESTAMP (not NTZ) for a watermark; windows align on
the epoch, so wall-clock 4-hour buckets are exact when the session time zone
is UTC (or any offset that is a multiple of the window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def occupancy_windows(readings: DataFrame, window: str = "4 hours", lateness: str = "1 hour",
                      ts_col: str = "ts") -> DataFrame:
    w = F.window(ts_col, window)
    return (readings.withWatermark(ts_col, lateness)
            .dropDuplicatesWithinWatermark(["capteur_id"])
            .groupBy(w.alias("w"), "hopital_id")
            .agg(F.round(F.avg("taux_occupation"), 2).alias("taux_moy"),
                 F.max("taux_occupation").alias("taux_max"),
                 F.sum("alertes").cast("bigint").alias("nb_alertes"),
                 F.count(F.lit(1)).alias("nb_mesures"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "hopital_id",
                    "taux_moy", "taux_max", "nb_alertes", "nb_mesures"))


def stream_bed_occupancy(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType,
                         fmt: str = "parquet", max_files_per_trigger: int | None = 1,
                         window: str = "4 hours", lateness: str = "1 hour"):
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = occupancy_windows(reader.load(in_dir), window, lateness)
    q = (out.writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
