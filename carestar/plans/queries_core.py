"""Query registrations: warehouse tables and the KPI library."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.rejects import REASON
from . import kpis
from .build import FACTS, warehouse_for
from .catalog import QUERIES, bi_query, wh_query

# warehouse tables
wh_query("dim_region", lambda wh: wh.dim_region)
wh_query("dim_hospital", lambda wh: wh.dim_hospital)
wh_query("dim_service", lambda wh: wh.dim_service)
wh_query("dim_disease", lambda wh: wh.dim_disease)
wh_query("dim_patient", lambda wh: wh.dim_patient)
wh_query("fact_admissions", lambda wh: wh.fact_admissions_readmit)
wh_query("fact_emergency", lambda wh: wh.fact_emergency)
wh_query("fact_lab", lambda wh: wh.fact_lab)
wh_query("fact_prescriptions", lambda wh: wh.fact_prescriptions)
wh_query("fact_bed_occupancy", lambda wh: wh.fact_bed_occupancy)
wh_query("fact_pharmacy_stock", lambda wh: wh.fact_pharmacy_stock)

# KPI library (A1–A15) and KPI cache
bi_query("kpi_bed_occupancy", kpis.kpi_bed_occupancy)
bi_query("kpi_length_of_stay", kpis.kpi_length_of_stay)
bi_query("kpi_daily_admissions", kpis.kpi_daily_admissions)
bi_query("kpi_top_diseases", kpis.kpi_top_diseases)
bi_query("kpi_cases_by_region", kpis.kpi_cases_by_region)
bi_query("kpi_age_split", kpis.kpi_age_split)
bi_query("kpi_readmission_rate", kpis.kpi_readmission_rate)
bi_query("kpi_emergency_wait", kpis.kpi_emergency_wait)
bi_query("kpi_abnormal_labs", kpis.kpi_abnormal_labs)
bi_query("kpi_urgent_vs_planned", kpis.kpi_urgent_vs_planned)
bi_query("kpi_admissions_by_service", kpis.kpi_admissions_by_service)
bi_query("kpi_monthly_trend", kpis.kpi_monthly_trend)
bi_query("kpi_sex_split", kpis.kpi_sex_split)
bi_query("kpi_top_drugs", kpis.kpi_top_drugs)
bi_query("kpi_incidence", kpis.kpi_incidence)
bi_query("kpi_cache", kpis.kpi_cache)
bi_query("kpi_cache_top5", kpis.kpi_cache_top5)


# Rows beyond a calendar that ends in 2000, by table and reason
def calendar_rejects(spark, sf_dir):
    """What was observed during the build next to the rows that were stored apart.

    Sensor and stock rows keep a NULL key in their fact (``conserve`` 1), so none of them is stored apart.
    """
    wh = warehouse_for(spark, sf_dir, calendar_end=dt.date(2000, 12, 31)).publish(FACTS)
    apart = None
    for name in FACTS:
        kept_apart = wh.rejects(name)
        if REASON not in kept_apart.columns:    # a fact without any row
            continue
        rows = (kept_apart.groupBy(F.col(REASON).alias("motif")).agg(F.count(F.lit(1)).alias("n_apart"))
                .withColumn("table_name", F.lit(name)))
        apart = rows if apart is None else apart.unionByName(rows)
    return (wh.reject_counts.join(apart, ["table_name", "motif"], "left")
            .select("table_name", "motif", "n_lignes", "conserve", F.coalesce("n_apart", F.lit(0)).alias("n_apart")))


QUERIES["calendar_rejects"] = calendar_rejects
