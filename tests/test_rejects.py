"""Rows beyond the calendar, pivots and bitmaps: split, counted, merged."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carestar.operators import bitmaps, dims, facts, rejects
from carestar.operators.pivot import pivot_counts
from carestar.plans.build import BuiltWarehouse, build_warehouse
from carestar.plans.warehouse import Warehouse, data_calendar
from conftest import SF_SMALL, rows

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)


def _admissions(spark):
    days = [dt.date(2023, 12, 31), START, dt.date(2024, 1, 5), END, dt.date(2024, 2, 1), None, None]
    return spark.createDataFrame([(i, "P", d, 1, "H", "S", "M") for i, d in enumerate(days)],
                                 "admission_id int, patient_id string, date_admission date, urgence int, "
                                 "hopital_id string, service_id string, maladie_id string")


def test_split_keeps_every_row_and_counts_while_writing(spark, tmp_dir):
    cal = dims.dim_date(spark, START, END)
    fact = facts.fact_admissions(_admissions(spark), cal, calendar_rows=31, bounds=(START, END))
    path = tmp_dir("split")
    counts = rejects.write_split(facts.with_readmission(fact), path, "fact_admissions", sort=["date_admission"])
    assert counts == [("fact_admissions", "non", 3, 1), ("fact_admissions", "date_absente", 2, 0),
                      ("fact_admissions", "avant_calendrier", 1, 0), ("fact_admissions", "apres_calendrier", 1, 0)]
    kept = spark.read.parquet(rejects.accepted_path(path))
    assert {r.admission_id for r in kept.collect()} == {1, 2, 3} and "rejet" not in kept.columns
    # the accepted rows are those of the fact that drops the others, readmission flags too
    assert rows(kept.select(sorted(kept.columns))) == rows(facts.with_readmission(
        facts.fact_admissions(_admissions(spark), cal, calendar_rows=31)).select(sorted(kept.columns)))
    away = {(r.admission_id, r.rejet) for r in rejects.read_rejects(spark, path).collect()}
    assert away == {(0, "avant_calendrier"), (4, "apres_calendrier"), (5, "date_absente"), (6, "date_absente")}
    assert rejects.read_rejects(spark, path).select("hopital_id").distinct().count() == 1


def test_kept_rows_are_only_counted(spark, tmp_dir):
    df = spark.createDataFrame([(1, "non"), (2, "date_absente")], "id int, rejet string")
    counts = rejects.write_split(df, tmp_dir("kept"), "t", keep=True)
    assert [c[2:] for c in counts] == [(1, 1), (1, 1), (0, 1), (0, 1)]


def test_empty_fact_counts_zero(spark, tmp_dir):
    df = spark.createDataFrame([], "id int, rejet string")
    assert [c[2] for c in rejects.write_split(df, tmp_dir("none"), "t")] == [0, 0, 0, 0]


def test_calendar_from_the_data_rejects_nothing(spark, tmp_dir):
    bounds = data_calendar(spark, SF_SMALL)
    assert bounds[0].timetuple()[1:3] == (1, 1) and bounds[1].timetuple()[1:3] == (12, 31)
    wh = Warehouse(spark, SF_SMALL, *bounds)
    for name in ("fact_admissions", "fact_lab", "fact_pharmacy_stock"):
        assert wh.dated(name, bounds).filter(F.col("rejet") != "non").isEmpty()


def test_build_whose_calendar_misses_the_data(spark, tmp_dir):
    wh = Warehouse(spark, SF_SMALL, START, END)
    built = BuiltWarehouse(spark, SF_SMALL, build_warehouse(wh, tmp_dir("build")), calendar_start=START, calendar_end=END)
    seen = {(r.table_name, r.motif): r.n_lignes for r in built.reject_counts.collect()}
    assert seen["fact_admissions", "non"] == 0 and seen["fact_admissions", "avant_calendrier"] > 0
    assert built.fact_admissions.count() == 0 and "annee_admission" in built.fact_admissions.columns
    assert built.rejects("fact_admissions").count() == seen["fact_admissions", "avant_calendrier"]
    # stock rows stay in their fact, without a key
    assert built.fact_pharmacy_stock.filter("temps_id IS NULL").count() == seen["fact_pharmacy_stock", "avant_calendrier"] > 0


def test_pivot_counts_others_and_nulls(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "q", 3), ("a", None, 5), ("b", "y", 1), (None, "x", 7)],
                               "r string, c string, n int")
    got = pivot_counts(df, ["r"], "c", ["x", "y", "z"], "n")
    assert got.columns == ["r", "x", "y", "z", "autres", "total"]
    assert rows(got) == [(None, 7, 0, 0, 0, 7), ("a", 2, 0, 0, 8, 10), ("b", 0, 1, 0, 0, 1)]
    for bad in (["x", "x"], ["autres"], ["r"]):
        with pytest.raises(ValueError):
            pivot_counts(df, ["r"], "c", bad, "n")


def test_bitmaps_merge_exactly(spark):
    data = [(m, i) for m in range(6) for i in range(-40_000 + m * 9_000, 40_000, 7 + m)] + [(1, None), (2, 2**40), (3, 2**40)]
    df = spark.createDataFrame(data, "m int, id long").repartition(4)
    parts = bitmaps.bitmaps(df, ["m"], "id")
    got = {r.m: r.n for r in bitmaps.count(parts, ["m"], "n").collect()}
    assert got == {m: len({i for k, i in data if k == m and i is not None}) for m in range(6)}
    whole = bitmaps.count(bitmaps.merge(parts, []), [], "n").first().n
    assert whole == len({i for _, i in data if i is not None}) == bitmaps.distinct_total(df, "id").first()[0]
    assert bitmaps.distinct_total(df.filter("false"), "id").first()[0] == 0
    assert bitmaps.distinct_total(df.select(F.col("id").cast("string").alias("id")), "id").first()[0] == whole
