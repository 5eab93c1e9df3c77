"""T2 in full: event-time windows with late rows kept and open windows flushed.

Spark's own windowed aggregate drops late rows and never emits a window that is
open when the input ends.  Here a micro-batch is split by the watermark that held
before it (latest event time seen, minus the allowed lateness): rows of a window
that had closed go to a side table, the others join the readings of the open
windows, one per reading id.  Windows that the new watermark closes are
aggregated and emitted; ``flush`` emits the rest when the input has ended.

Every output and state folder is stored by batch and overwritten by a replay of
that batch, and a batch reads only the state of the one before it, so results are
the same whatever is lost in between.  State holds the readings of open windows:
it is bounded by the window and the lateness, not by the input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import dedup

BY_WATERMARK, BY_END = "filigrane", "fin"


class OccupancyStream:
    """Windows of occupancy per hospital below ``base``: ``windows``, ``late``, ``state`` and ``marks``."""

    def __init__(self, spark: SparkSession, base: str, hours: int = 4, lateness: dt.timedelta = dt.timedelta(hours=1)):
        self.spark, self.base = spark, base.rstrip("/")
        self.hours, self.lateness = hours, lateness

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.base}/{name}/batch_id={batch_id}")

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.base}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _mark(self, before: int | None = None):
        """``batch_id, mark, open`` of the last batch (before one): a row per batch is stored."""
        marks = self._read("marks")
        if marks is None:
            return None
        rows = marks if before is None else marks.filter(F.col("batch_id") < before)
        return rows.orderBy(F.desc("batch_id")).first()

    def _start(self) -> Column:
        """Start of the window, aligned on the epoch; NULL without an event time (``F.window`` would drop the row)."""
        at, step = F.unix_micros("ts"), F.lit(self.hours * 3_600_000_000)
        return F.timestamp_micros(at - F.pmod(at, step))

    def _aggregate(self, readings: DataFrame, by: str) -> DataFrame:
        end = F.col("window_start") + F.expr(f"INTERVAL {self.hours} HOURS")
        return (readings.groupBy("window_start", "hopital_id")
                .agg(F.round(F.avg("taux_occupation"), 2).alias("taux_moy"), F.max("taux_occupation").alias("taux_max"),
                     F.sum("alertes").cast("bigint").alias("nb_alertes"), F.count(F.lit(1)).alias("nb_mesures"))
                .select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        end.cast("timestamp_ntz").alias("window_end"), "hopital_id", "taux_moy", "taux_max",
                        "nb_alertes", "nb_mesures", F.lit(by).alias("cloture")))

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch; safe to repeat."""
        last = self._mark(before=batch_id)
        rows = rows.withColumn("window_start", self._start())
        end = F.col("window_start") + F.expr(f"INTERVAL {self.hours} HOURS")
        closed_before = F.lit(False) if last is None or last["mark"] is None else end <= F.lit(last["mark"])
        # without an event time a row belongs to no window: it is kept aside as well
        late = closed_before | F.col("ts").isNull()
        self._write(rows.filter(late).drop("window_start"), "late", batch_id)

        kept = rows.filter(~late)
        if last is not None:
            state = self.spark.read.schema(kept.schema).parquet(f"{self.base}/state/batch_id={last['batch_id']}")
            kept = state.unionByName(kept)
        # repeated readings count once: of several versions the earliest
        kept = dedup(kept, ["capteur_id"], ["ts"], keep="first")
        newest = rows.agg(F.max("ts")).first()[0]
        marks = [m for m in (last and last["mark"], newest and newest - self.lateness) if m is not None]
        mark = max(marks) if marks else None
        closes = F.lit(False) if mark is None else end <= F.lit(mark)
        self._write(kept.filter(~closes), "state", batch_id)
        self._write(self._aggregate(kept.filter(closes), BY_WATERMARK), "windows", batch_id)
        one = self.spark.createDataFrame([(mark,)], T.StructType([T.StructField("mark", T.TimestampType())]))
        self._write(one.coalesce(1), "marks", batch_id)      # last: the batch is done

    def run(self, in_dir: str, checkpoint: str, schema: T.StructType, fmt: str = "parquet",
            max_files_per_trigger: int = 1000) -> None:
        """Process every file landed in ``in_dir`` that the checkpoint has not seen yet, then stop."""
        src = (self.spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger)
               .load(in_dir))
        q = (src.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def windows(self) -> DataFrame | None:
        """Windows that a watermark has closed."""
        done = self._read("windows")
        return None if done is None else done.drop("batch_id")

    def flush(self) -> DataFrame | None:
        """The input has ended: the windows still open."""
        last = self._mark()
        if last is None:
            return None
        return self._aggregate(self.spark.read.parquet(f"{self.base}/state/batch_id={last['batch_id']}"), BY_END)

    def late(self) -> DataFrame | None:
        """Rows that came after their window had closed, with the batch that brought them."""
        return self._read("late")
