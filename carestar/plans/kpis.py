"""Named KPIs (the reference's KPI SQL library) and the KPI cache.

Every KPI takes the warehouse and an explicit ``as_of`` date instead of the
wall clock.  Shape: fact ⋈ dims -> groupBy.agg -> (optional) top-k.

* "current year / month / last 30 days" are range predicates on the fact's
  admission date (same rows as joining the calendar and filtering year/month).
* Shares of the grand total (``COUNT * 100 / SUM(COUNT) OVER ()``) use a
  scalar subquery over the aggregated frame: the total is one value, so no
  single-partition window and no cross join are needed.
* Top-k is ``orderBy(...).limit(k)`` with the group key as last tie-breaker,
  planned as a per-partition top-k plus merge (TakeOrderedAndProject).
* Aggregate before joining: Catalyst does not push an aggregate below a join,
  so a KPI grouped by a dimension is written as "fact -> groupBy(join key)
  -> join dimension".  The fact is collapsed map-side to one row per key
  before any shuffle, and the join (broadcast or shuffled, whichever the
  dimension's size allows) sees one row per key instead of every fact row.
  When the output is grouped by the key itself the aggregate is final at key
  level; when it is coarser (region, age band, sex) the per-key parts are
  re-added (counts, sums, and averages as sum / count).  That holds for every
  dimension and at every size; only the calendar, whose rows are bounded by its
  range, may be joined (broadcast) below the aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import pct
from ..operators.bitmaps import distinct_total
from ..operators.joins import bounded, join_dim
from .warehouse import Warehouse


def _d(x) -> Column:
    return F.lit(x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x)))


def in_year(col: str, as_of: dt.date) -> Column:
    return (F.col(col) >= _d(dt.date(as_of.year, 1, 1))) & (F.col(col) < _d(dt.date(as_of.year + 1, 1, 1)))


def in_month(col: str, as_of: dt.date) -> Column:
    start = dt.date(as_of.year, as_of.month, 1)
    nxt = dt.date(as_of.year + (as_of.month == 12), as_of.month % 12 + 1, 1)
    return (F.col(col) >= _d(start)) & (F.col(col) < _d(nxt))


def current_year(df: DataFrame, as_of: dt.date, col: str = "date_admission") -> DataFrame:
    """Rows of ``as_of``'s year; on a build stored by year the partition
    predicate prunes whole directories."""
    out = df.filter(in_year(col, as_of))
    return out.filter(F.col("annee_admission") == as_of.year) if "annee_admission" in df.columns else out


def current_month(df: DataFrame, as_of: dt.date, col: str = "date_admission") -> DataFrame:
    out = df.filter(in_month(col, as_of))
    return out.filter(F.col("annee_admission") == as_of.year) if "annee_admission" in df.columns else out


def last_days(col: str, as_of: dt.date, days: int = 30) -> Column:
    return F.col(col).between(_d(as_of - dt.timedelta(days=days)), _d(as_of))


def share_of_total(agg: DataFrame, count_col: str, name: str, digits: int = 2,
                   rows: DataFrame | None = None) -> DataFrame:
    """Add ``ROUND(count * 100 / total, digits)``; the total is a scalar subquery.

    With ``rows`` (the frame that was grouped) the total is its row count — a
    global partial/final count with no shuffle by group key — instead of a
    second pass of the group-by.
    """
    total = (rows.select(F.count(F.lit(1))) if rows is not None else agg.select(F.sum(count_col))).scalar()
    return agg.withColumn(name, pct(F.col(count_col), total, digits))


def _n() -> Column:
    return F.count(F.lit(1))


def _sum_int(c: str) -> Column:
    return F.sum(c).cast("bigint")


def _avg1(c: str) -> Column:
    return F.round(F.avg(c), 1)


def avg_parts(c: str) -> list[Column]:
    """Sum and count of ``c``: the mergeable parts of ``avg(c)``."""
    return [F.sum(c).alias(f"__sum_{c}"), F.count(c).alias(f"__cnt_{c}")]


def merged_avg(c: str) -> Column:
    """``avg(c)`` from per-key :func:`avg_parts` (NULL when no value)."""
    return F.try_divide(F.sum(f"__sum_{c}").cast("double"), F.sum(f"__cnt_{c}").cast("double"))


def per_key(fact: DataFrame, *keys: str) -> DataFrame:
    """Admission parts, one row per key: count, urgent count, stay sum and count.

    They are re-added per output group after the joins, so a dimension that
    grows with the data meets one row per key; a hot key is collapsed on every
    mapper before the shuffle.
    """
    return fact.groupBy(*keys).agg(_n().alias("__n"), F.sum("est_urgence").alias("__urg"), *avg_parts("duree_sejour"))


def _calendar(wh: Warehouse, *cols: str) -> DataFrame:
    return bounded(wh.dim_date.select("temps_id", *cols), wh.calendar_rows)


def kpi_bed_occupancy(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS) -> DataFrame:
    """A1: admissions in the current month per hospital, % of bed capacity."""
    per = (current_month(wh.fact_admissions, as_of).groupBy("hopital_id")
           .agg(F.count("admission_id").alias("admissions_actives")))
    h = wh.dim_hospital.select("hopital_id", "nom", "capacite_lits")
    g = join_dim(per, h, "hopital_id")
    return g.select("hopital_id", F.col("nom").alias("hopital"), "capacite_lits", "admissions_actives",
                    pct("admissions_actives", "capacite_lits", 2).alias("taux_occupation_pct")).orderBy(F.desc("taux_occupation_pct"), "hopital_id")


def kpi_length_of_stay(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS) -> DataFrame:
    """A2: length of stay per service in the current year."""
    per = (current_year(wh.fact_admissions, as_of).groupBy("service_id")
           .agg(_avg1("duree_sejour").alias("dms_jours"), F.min("duree_sejour").alias("min_jours"),
                F.max("duree_sejour").alias("max_jours"), _n().alias("nb_sejours")))
    s = wh.dim_service.select("service_id", "nom_service")
    return join_dim(per, s, "service_id").select("service_id", "nom_service", "dms_jours", "min_jours", "max_jours",
                                                 "nb_sejours").orderBy(F.desc("dms_jours"), "service_id")


def kpi_daily_admissions(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS, days: int = 30) -> DataFrame:
    """A3: admissions per day over the last ``days`` days (inclusive), urgent vs planned."""
    fa = wh.fact_admissions.filter(last_days("date_admission", as_of, days)).select("temps_id", "est_urgence")
    j = fa.join(_calendar(wh, "date", "jour_semaine"), "temps_id")
    g = j.groupBy("date", "jour_semaine").agg(_n().alias("nb_admissions"), _sum_int("est_urgence").alias("nb_urgences"))
    return (g.withColumn("nb_programmees", F.col("nb_admissions") - F.col("nb_urgences"))
            .orderBy(F.desc("date")))


def kpi_top_diseases(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS, k: int = 10) -> DataFrame:
    """A4: top-k diseases of the current year with their share of all cases."""
    per = current_year(wh.fact_admissions, as_of).groupBy("maladie_id").agg(_n().alias("nb_cas"))
    m = wh.dim_disease.select("maladie_id", "nom_maladie", "categorie", "code_cim10", "gravite")
    g = join_dim(per, m, "maladie_id").select("maladie_id", "nom_maladie", "categorie", "code_cim10",
                                              "gravite", "nb_cas")
    g = share_of_total(g, "nb_cas", "pct_total", 2)
    return g.orderBy(F.desc("nb_cas"), F.asc("maladie_id")).limit(k)


def kpi_cases_by_region(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS) -> DataFrame:
    """A5: admissions per patient region, rate per 100,000 inhabitants, mean stay."""
    p = wh.dim_patient.select("patient_id", "region_id")
    per = per_key(current_year(wh.fact_admissions, as_of), "patient_id")
    r = wh.dim_region.select("region_id", "nom_region", "population")
    g = join_dim(per, p, "patient_id").groupBy("region_id").agg(
        F.sum("__n").alias("nb_admissions"), F.round(merged_avg("duree_sejour"), 1).alias("dms_moy"))
    g = join_dim(g, r, "region_id")
    rate = F.round(F.try_divide(F.col("nb_admissions") * 100000.0, F.nullif(F.col("population"), F.lit(0.0))), 1)
    return (g.select("region_id", "nom_region", "population", "nb_admissions", rate.alias("taux_pour_100k"), "dms_moy")
            .orderBy(F.desc("nb_admissions"), "region_id"))


def kpi_age_split(wh: Warehouse) -> DataFrame:
    """Admissions per age band with share of total."""
    p = wh.dim_patient.select("patient_id", "tranche_age")
    j = join_dim(per_key(wh.fact_admissions, "patient_id"), p, "patient_id")
    g = (j.groupBy("tranche_age")
         .agg(F.sum("__n").alias("nb_admissions"), _sum_int("__urg").alias("nb_urgences"),
              F.round(merged_avg("duree_sejour"), 1).alias("dms_moy")))
    return share_of_total(g, "nb_admissions", "pct_total", 2).orderBy("tranche_age")


def kpi_readmission_rate(wh: Warehouse) -> DataFrame:
    """30-day readmission rate per service."""
    per = (wh.fact_admissions_readmit.groupBy("service_id")
           .agg(_n().alias("total_admissions"), _sum_int("est_readmission").alias("nb_readmissions")))
    s = wh.dim_service.select("service_id", "nom_service")
    g = join_dim(per, s, "service_id").select("service_id", "nom_service", "total_admissions", "nb_readmissions")
    return (g.withColumn("taux_readmission_pct", pct("nb_readmissions", "total_admissions", 2))
            .orderBy(F.desc("taux_readmission_pct"), "service_id"))


def kpi_emergency_wait(wh: Warehouse) -> DataFrame:
    """Emergency waiting time per month and hospital."""
    fu = wh.fact_emergency.select("temps_id", "hopital_id", "temps_attente_minutes", "urgence_id", "est_hospitalise")
    h = wh.dim_hospital.select("hopital_id", "nom")
    # the calendar is a broadcast (no shuffle); the hospital name joins the
    # per (month, hospital) rows
    per = (fu.join(_calendar(wh, "annee", "mois", "nom_mois"), "temps_id")
           .groupBy("annee", "mois", "nom_mois", "hopital_id")
           .agg(F.round(F.avg("temps_attente_minutes"), 0).alias("attente_moy_min"),
              F.min("temps_attente_minutes").alias("attente_min"),
              F.max("temps_attente_minutes").alias("attente_max"),
              F.count("urgence_id").alias("nb_passages"),
              _sum_int("est_hospitalise").alias("nb_hospitalises")))
    g = join_dim(per, h, "hopital_id")
    return g.select(F.col("nom_mois").alias("mois"), F.col("mois").alias("mois_num"), "annee", "hopital_id",
                    F.col("nom").alias("hopital"), "attente_moy_min", "attente_min", "attente_max",
                    "nb_passages", "nb_hospitalises").orderBy(F.desc("annee"), F.desc("mois_num"), "hopital_id")


def kpi_abnormal_labs(wh: Warehouse, as_of: dt.date = K.AS_OF_EVENTS) -> DataFrame:
    """Abnormal lab results per test type in the current year."""
    cal = bounded(wh.dim_date.filter(F.col("annee") == as_of.year).select("temps_id"), wh.calendar_rows)
    fl = wh.fact_lab.select("temps_id", "type_test", "est_anormal").join(cal, "temps_id")
    g = fl.groupBy("type_test").agg(_n().alias("total_tests"), _sum_int("est_anormal").alias("nb_anormaux"))
    return (g.withColumn("taux_anomalie_pct", pct("nb_anormaux", "total_tests", 2))
            .orderBy(F.desc("taux_anomalie_pct"), "type_test"))


def _monthly(wh: Warehouse) -> DataFrame:
    fa = wh.fact_admissions.select("temps_id", "est_urgence", "duree_sejour", "admission_id")
    return fa.join(_calendar(wh, "annee", "mois", "nom_mois"), "temps_id")


def kpi_urgent_vs_planned(wh: Warehouse) -> DataFrame:
    """A10: urgent vs planned admissions per month."""
    g = (_monthly(wh).groupBy("annee", "mois", "nom_mois")
         .agg(_sum_int("est_urgence").alias("nb_urgences"), _n().alias("total")))
    return (g.withColumn("nb_programmees", F.col("total") - F.col("nb_urgences"))
            .withColumn("pct_urgences", pct("nb_urgences", "total", 2))
            .orderBy(F.desc("annee"), F.desc("mois")))


def kpi_admissions_by_service(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS) -> DataFrame:
    """Admissions per service in the current year."""
    per = (current_year(wh.fact_admissions, as_of).groupBy("service_id")
           .agg(_n().alias("nb_admissions"), _avg1("duree_sejour").alias("dms"),
                _sum_int("est_urgence").alias("nb_urgences")))
    s = wh.dim_service.select("service_id", "nom_service", "specialite", "nb_lits")
    return join_dim(per, s, "service_id").select("service_id", "nom_service", "specialite", "nb_lits",
                                                 "nb_admissions", "dms", "nb_urgences"
                                                 ).orderBy(F.desc("nb_admissions"), "service_id")


def kpi_monthly_trend(wh: Warehouse) -> DataFrame:
    """Monthly admissions, urgent admissions and mean stay (ascending)."""
    return (_monthly(wh).groupBy("annee", "mois", "nom_mois")
            .agg(_n().alias("nb_admissions"), _sum_int("est_urgence").alias("nb_urgences"),
                 _avg1("duree_sejour").alias("dms_moy"))
            .orderBy("annee", "mois"))


def kpi_sex_split(wh: Warehouse) -> DataFrame:
    """Admissions per sex with share of total."""
    p = wh.dim_patient.select("patient_id", "sexe")
    j = join_dim(per_key(wh.fact_admissions, "patient_id"), p, "patient_id")
    g = (j.groupBy("sexe")
         .agg(F.sum("__n").alias("nb_admissions"), F.round(merged_avg("duree_sejour"), 1).alias("dms_moy"),
              _sum_int("__urg").alias("nb_urgences")))
    return share_of_total(g, "nb_admissions", "pct", 2)


def kpi_top_drugs(wh: Warehouse, k: int = 15) -> DataFrame:
    """The k most prescribed drugs."""
    g = (wh.fact_prescriptions.groupBy("medicament")
         .agg(_n().alias("nb_prescriptions"), _avg1("duree_jours").alias("duree_moy_jours"),
              _sum_int("est_chronique").alias("nb_chroniques")))
    return g.orderBy(F.desc("nb_prescriptions"), F.asc("medicament")).limit(k)


def kpi_incidence(wh: Warehouse, as_of: dt.date = K.AS_OF_ADMISSIONS) -> DataFrame:
    """Incidence per 100,000 by region × disease in the current year."""
    p = wh.dim_patient.select("patient_id", "region_id")
    r = wh.dim_region.select("region_id", "nom_region", "population")
    m = wh.dim_disease.select("maladie_id", "nom_maladie", "categorie")
    per = current_year(wh.fact_admissions, as_of).groupBy("patient_id", "maladie_id").agg(_n().alias("__n"))
    g = join_dim(per, p, "patient_id").groupBy("region_id", "maladie_id").agg(F.sum("__n").alias("nb_cas"))
    g = join_dim(join_dim(g, r, "region_id"), m, "maladie_id").select(
        "region_id", "nom_region", "maladie_id", "nom_maladie", "categorie", "population", "nb_cas")
    rate = F.round(F.try_divide(F.col("nb_cas") * 100000.0, F.nullif(F.col("population"), F.lit(0.0))), 2)
    return g.withColumn("taux_incidence_100k", rate).orderBy(F.desc("taux_incidence_100k"), "region_id", "maladie_id")


# ---------------------------------------------------------------------------
# KPI cache

def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("N/A"))


def kpi_cache(wh: Warehouse, computed_at: str = K.COMPUTED_AT) -> DataFrame:
    """Scalar KPIs as ``(kpi, valeur, date_calcul)`` text rows.

    One aggregation pass per fact, and a scan of one column for each distinct
    count: its ids become bitmaps on the mappers, so no row is expanded.
    """
    occ = wh.fact_bed_occupancy.agg(
        F.round(F.avg(F.try_divide(F.col("lits_occupes").cast("double"),
                                   F.nullif(F.col("lits_total").cast("double"), F.lit(0.0))) * 100.0), 1)
        .alias("taux_occupation_moyen"))
    fa = wh.fact_admissions
    adm = fa.agg(
        F.round(F.avg(F.when(F.col("duree_sejour") > 0, F.col("duree_sejour"))), 1).alias("dms_moyen"),
        _n().alias("nb_admissions_total"),
        F.round(F.avg("cout_hospitalisation"), 2).alias("cout_moyen_sejour"),
        F.round(F.try_divide(F.sum(F.when(F.col("mode_admission") == K.MODE_URGENT, 1).otherwise(0)) * 100.0,
                             F.nullif(_n().cast("double"), F.lit(0.0))), 1).alias("pct_mode_urgence"),
    ).select("*", *[distinct_total(fa, c).scalar().alias(n) for c, n in
                    (("patient_id", "nb_patients_distincts"), ("maladie_id", "nb_maladies_distinctes"),
                     ("hopital_id", "nb_hopitaux_actifs"))])
    occ_long = occ.select(F.lit("taux_occupation_moyen").alias("kpi"), _text(F.col("taux_occupation_moyen")).alias("valeur"))
    names = ["dms_moyen", "nb_admissions_total", "nb_patients_distincts", "cout_moyen_sejour",
             "nb_maladies_distinctes", "nb_hopitaux_actifs", "pct_mode_urgence"]
    adm_txt = adm.select(*[_text(F.col(n)).alias(n) for n in names])
    adm_long = adm_txt.unpivot([], names, "kpi", "valeur")
    return occ_long.unionByName(adm_long).withColumn("date_calcul", F.lit(computed_at))


def kpi_cache_top5(wh: Warehouse, computed_at: str = K.COMPUTED_AT, k: int = 5) -> DataFrame:
    """``top_maladie_i`` = ``"<name> (<n> cas)"`` for the k most frequent disease names."""
    per = wh.fact_admissions.groupBy("maladie_id").agg(_n().alias("nb"))
    m = wh.dim_disease.select("maladie_id", "nom_maladie")
    # several ids may share a name: the per-id counts are re-added per name
    g = join_dim(per, m, "maladie_id").groupBy("nom_maladie").agg(F.sum("nb").alias("nb"))
    top = g.orderBy(F.desc("nb"), F.asc("nom_maladie")).limit(k)
    # numbering runs over the k rows kept by the top-k, never over the fact
    ranked = top.withColumn("rang", F.row_number().over(Window.orderBy(F.desc("nb"), F.asc("nom_maladie"))))
    return ranked.select(F.concat(F.lit("top_maladie_"), F.col("rang").cast("string")).alias("kpi"),
                         F.format_string("%s (%d cas)", F.col("nom_maladie"), F.col("nb")).alias("valeur"),
                         F.lit(computed_at).alias("date_calcul"))
