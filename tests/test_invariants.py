"""Invariants across KPIs, reports, mart and measures."""

import pytest
from pyspark.sql import functions as F

from carestar.operators.mart import MART_COLUMNS, analytics_mart
from carestar.plans import kpis, reports
from carestar.plans.build import warehouse_for
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF_SMALL)


def test_shares_sum_to_100(wh):
    for df, col in ((kpis.kpi_age_split(wh), "pct_total"), (kpis.kpi_sex_split(wh), "pct")):
        total = df.agg(F.sum(col)).collect()[0][0]
        assert abs(total - 100.0) <= 0.01 * df.count()


def test_urgent_plus_planned_is_total(wh):
    for r in kpis.kpi_urgent_vs_planned(wh).collect():
        assert r["nb_urgences"] + r["nb_programmees"] == r["total"]
    for r in kpis.kpi_daily_admissions(wh).collect():
        assert r["nb_urgences"] + r["nb_programmees"] == r["nb_admissions"]


def test_mart_never_fans_out(wh):
    mart = analytics_mart(wh.fact_admissions, wh.dim_patient, wh.dim_hospital, wh.dim_region, wh.dim_disease,
                          wh.dim_date)
    assert mart.columns == MART_COLUMNS and len(MART_COLUMNS) == 33
    assert mart.count() == wh.fact_admissions.count()
    assert mart.select("admission_id").distinct().count() == mart.count()


def test_monthly_totals_agree(wh):
    a = kpis.kpi_monthly_trend(wh).agg(F.sum("nb_admissions")).collect()[0][0]
    b = reports.cases_by_category(wh).agg(F.sum("nb_cas")).collect()[0][0]
    assert a == b == wh.fact_admissions.count()


def test_top_k_is_bounded_and_ordered(wh):
    top = kpis.kpi_top_diseases(wh).collect()
    assert len(top) <= 10
    counts = [r["nb_cas"] for r in top]
    assert counts == sorted(counts, reverse=True)


def test_kpis_on_an_empty_fact(spark, wh):
    empty = wh.replace(fact_admissions=wh.fact_admissions.limit(0), fact_admissions_readmit=wh.fact_admissions.limit(0))
    assert kpis.kpi_sex_split(empty).count() == 0
    assert kpis.kpi_top_diseases(empty).count() == 0
    cache = {r["kpi"]: r["valeur"] for r in kpis.kpi_cache(empty).collect()}
    assert cache["nb_admissions_total"] == "0" and cache["dms_moyen"] == "N/A"


def test_daily_chain_logs_every_step(spark, tmp_dir):
    from carestar.plans.build import run_daily
    out = tmp_dir("daily")
    log = {r["task_name"]: (r["status"], r["records"]) for r in run_daily(spark, SF_SMALL, out).collect()}
    assert set(log) == {"audit_qualite", "publier_entrepot", "creer_mart", "calculer_kpis", "export_csv"}
    assert all(s == "SUCCESS" for s, _ in log.values())
    assert log["creer_mart"][1] == log["publier_entrepot"][1] > 0
    assert log["calculer_kpis"][1] == 13
    assert spark.read.option("header", True).csv(f"{out}/reports/kpi_cache_2000-12-31").count() == 13
