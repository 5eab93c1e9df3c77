"""Reloads and stream merges that are one commit: interrupted, replayed, concurrent."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.sinks.snapshots import ConflictError, SnapshotTable
from carestar.sources.incremental import extract_since
from carestar.streaming.late import OccupancyStream
from carestar.streaming.upsert import BUCKET, merge_batch
from conftest import rows


def _table(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir("snap"), "src")
    t.replace(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b/ c=1"), (4, None)], "id int, src string"))
    return t


def test_reload_stopped_before_its_commit_is_not_seen(spark, tmp_dir, monkeypatch):
    t = _table(spark, tmp_dir)
    new = spark.createDataFrame([(9, "a")], "id int, src string")

    def stop(*a, **k):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(t, "commit", stop)
        with pytest.raises(RuntimeError):
            t.replace(new)
    assert rows(t.read(), "id") == [(1,), (2,), (3,), (4,)]
    t.replace(new)
    assert rows(t.read(), "id") == [(3,), (4,), (9,)] and rows(t.read(1), "id") == [(1,), (2,), (3,), (4,)]
    assert t.expire(keep=1) == 1                          # the folder of the stopped reload
    assert rows(t.read(), "id") == [(3,), (4,), (9,)]     # folders of the first load that are still named stay


def test_two_writers_from_one_manifest(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    base, new = t.manifest(), spark.createDataFrame([(9, "a")], "id int, src string")
    t.replace(new)
    with pytest.raises(ConflictError):
        t.commit(base, new.schema, t.write_parts(new))
    assert rows(t.read(), "id") == [(3,), (4,), (9,)]


def test_empty_reload_drops_its_partition(spark, tmp_dir):
    t = _table(spark, tmp_dir)
    t.replace(t.read().filter("false"), ["a"])
    assert rows(t.read(), "id") == [(3,), (4,)] and rows(t.read(parts=["b/ c=1"]), "id") == [(3,)]
    t.replace(t.read().filter("false"), ["b/ c=1", "__null"])
    assert t.read().columns == ["id", "src"] and t.read().isEmpty()


def test_replayed_batch_and_crossing_update_leave_one_row(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir("up"), BUCKET)
    schema = "id int, jour date, v int"
    first = spark.createDataFrame([(i, dt.date(2024, 1, 1), 1) for i in range(50)] + [(7, dt.date(2024, 1, 1), 1)], schema)
    assert merge_batch(t, first, 0, ["id"], ["v"], 8)
    update = spark.createDataFrame([(7, dt.date(2024, 3, 1), 2), (99, dt.date(2024, 3, 1), 2), (8, dt.date(2023, 1, 1), 0)], schema)
    assert merge_batch(t, update, 1, ["id"], ["v"], 8)
    before = t.manifest()
    assert not merge_batch(t, update, 1, ["id"], ["v"], 8)      # a replay does nothing
    assert t.manifest() == before
    got = {r.id: (r.jour, r.v) for r in t.read().collect()}
    assert t.read().count() == len(got) == 51
    assert got[7] == (dt.date(2024, 3, 1), 2) and got[8] == (dt.date(2024, 1, 1), 1)
    # only the touched buckets were rewritten
    changed = {p for p in before.folders if before.folders[p] != t.manifest(1).folders.get(p)}
    assert len(changed) <= 3 and merge_batch(t, first.filter("false"), 2, ["id"], ["v"], 8)


READING = T.StructType([T.StructField("capteur_id", T.LongType()), T.StructField("hopital_id", T.LongType()),
                        T.StructField("ts", T.TimestampType()), T.StructField("taux_occupation", T.DoubleType()),
                        T.StructField("alertes", T.IntegerType())])


def test_late_rows_repeats_replay_and_flush(spark, tmp_dir):
    def frame(*data):
        return spark.createDataFrame([(i, 1, None if h is None else dt.datetime(2024, 1, 1, h), v, 0) for i, h, v in data], READING)
    s = OccupancyStream(spark, tmp_dir("late"))
    assert s.windows() is None and s.flush() is None and s.late() is None
    s.batch(frame((1, 0, 50.0), (2, 1, 70.0), (2, 1, 70.0), (3, 9, 90.0)), 0)
    second = frame((4, 2, 10.0), (5, 14, 80.0), (3, 9, 90.0), (6, None, 1.0))
    s.batch(second, 1)
    s.batch(second, 1)                                          # replayed
    closed = {(r.window_start.hour, r.nb_mesures, r.taux_moy, r.cloture) for r in s.windows().collect()}
    assert closed == {(0, 2, 60.0, "filigrane"), (8, 1, 90.0, "filigrane")} and s.windows().count() == 2
    assert {(r.capteur_id, r.batch_id) for r in s.late().collect()} == {(4, 1), (6, 1)}
    assert [(r.window_start.hour, r.nb_mesures, r.cloture) for r in s.flush().collect()] == [(12, 1, "fin")]
    s.batch(frame(), 2)                                         # an empty batch changes nothing
    assert s.flush().count() == 1 and s.windows().count() == 2


def test_rows_with_the_marks_own_time_are_taken_once(spark):
    t0 = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(1, t0), (2, t0), (3, t0 - dt.timedelta(hours=5)), (4, t0 + dt.timedelta(hours=1)),
                                 (5, None), (6, None)], "id int, updated_at timestamp")
    loaded = src.filter("id in (1, 5)")
    got = extract_since(src, loaded, ["id"], overlap=dt.timedelta(hours=6))
    assert rows(got, "id") == [(2,), (3,), (4,), (6,)]
    assert extract_since(src, loaded.unionByName(got), ["id"]).isEmpty()
    assert extract_since(src, loaded, ["id"], overlap=dt.timedelta(hours=1)).filter("id = 3").isEmpty()
    assert extract_since(src, loaded.filter("false"), ["id"]).count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and F is not None


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_dir):
    path = tmp_dir("large")
    t = SnapshotTable(spark, path, BUCKET)
    batch = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(4)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        assert merge_batch(t, batch, 0, ["id"], ["v"], 2)
    finally:
        for k in small:
            spark.conf.unset(k)
    folders = t.manifest().folders
    files = [len([f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]) for folder in folders.values()]
    assert len(folders) == 2 and min(files) > 1
    assert t.read().count() == 40_000 == t.read().select("id").distinct().count()
