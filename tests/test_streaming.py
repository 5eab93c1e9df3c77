"""Streaming: late rows, duplicates, restart from the checkpoint."""

import datetime as dt

from pyspark.sql import types as T

from carestar.streaming.ingest import stream_ingest
from carestar.streaming.sensors import stream_bed_occupancy

SCHEMA = T.StructType([T.StructField("capteur_id", T.LongType()), T.StructField("hopital_id", T.LongType()),
                       T.StructField("ts", T.TimestampType()), T.StructField("taux_occupation", T.DoubleType()),
                       T.StructField("alertes", T.IntegerType())])


def _ts(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_sensor_windows_watermark_late_and_duplicates(spark, tmp_dir):
    land, out, ckpt = tmp_dir("land"), tmp_dir("out"), tmp_dir("ckpt")
    first = [(1, 1, _ts(0, 10), 50.0, 0), (2, 1, _ts(1), 70.0, 0), (2, 1, _ts(1), 70.0, 0),  # duplicate id
             (3, 1, _ts(9), 90.0, 1)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(land)
    stream_bed_occupancy(spark, land, out, ckpt, SCHEMA)
    # a late reading for the closed 00:00-04:00 window, plus newer data
    late = [(4, 1, _ts(2), 10.0, 0), (5, 1, _ts(14), 80.0, 0)]
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(land)
    stream_bed_occupancy(spark, land, out, ckpt, SCHEMA)
    got = {(r["window_start"].hour, r["nb_mesures"], r["taux_moy"]) for r in spark.read.parquet(out).collect()}
    # window 00-04: two distinct readings, the late one dropped; 08-12 closed by the 14:00 reading
    assert got == {(0, 2, 60.0), (8, 1, 90.0)}


def test_ingest_restart_processes_only_new_files(spark, tmp_dir):
    land, out, ckpt = tmp_dir("l"), tmp_dir("o"), tmp_dir("c")
    schema = T.StructType([T.StructField("id", T.LongType())])
    spark.range(3).write.mode("append").parquet(land)
    stream_ingest(spark, land, out, ckpt, schema)
    stream_ingest(spark, land, out, ckpt, schema)            # restart, nothing new
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).write.mode("append").parquet(land)
    stream_ingest(spark, land, out, ckpt, schema)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
