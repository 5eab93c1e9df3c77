"""Report aggregates (weekly report tables, BI visuals, API statistics).

All are fact -> groupBy.agg with dimension attributes; top-k always breaks
ties on the group key (ascending, NULL first) so the kept rows are
deterministic.  As in the KPIs, the fact is aggregated to one row per join
key before a dimension join wherever the result is grouped by that key or by
attributes of it (counts and sums re-added, averages as sum / count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import AGE_BAND_WAREHOUSE, AGE_BAND_WAREHOUSE_ELSE, EPIDEMIC_ACTIVE
from ..functions import occupancy_level
from ..operators.joins import bounded, join_dim
from ..operators.pivot import pivot_counts
from .kpis import avg_parts, merged_avg, per_key
from .warehouse import Warehouse

AGE_BANDS = [label for _, label in AGE_BAND_WAREHOUSE] + [AGE_BAND_WAREHOUSE_ELSE]


def _n() -> Column:
    return F.count(F.lit(1))


def _cal(wh: Warehouse, *cols: str) -> DataFrame:
    return bounded(wh.dim_date.select("temps_id", *cols), wh.calendar_rows)


def report_diseases(wh: Warehouse, k: int = 10) -> DataFrame:
    """Top diseases (by name and category) with mean stay."""
    per = wh.fact_admissions.groupBy("maladie_id").agg(_n().alias("__n"), *avg_parts("duree_sejour"))
    m = wh.dim_disease.select("maladie_id", "nom_maladie", "categorie")
    g = (join_dim(per, m, "maladie_id").groupBy("nom_maladie", "categorie")
         .agg(F.sum("__n").alias("admissions"), F.round(merged_avg("duree_sejour"), 1).alias("dms_moy")))
    return g.orderBy(F.desc("admissions"), F.asc_nulls_first("nom_maladie"), F.asc_nulls_first("categorie")).limit(k)


def _hospital_region(wh: Warehouse) -> DataFrame:
    r = wh.dim_region.select("region_id", "nom_region")
    return wh.dim_hospital.select("hopital_id", F.col("nom").alias("nom_hopital"), "region_id").join(r, "region_id", "left")


def report_hospitals(wh: Warehouse, k: int = 8) -> DataFrame:
    """R2: top hospitals with region, admissions, mean stay, mean cost."""
    per = wh.fact_admissions.groupBy("hopital_id").agg(_n().alias("__n"), *avg_parts("duree_sejour"),
                                                       *avg_parts("cout_hospitalisation"))
    g = (join_dim(per, _hospital_region(wh), "hopital_id").groupBy("nom_hopital", "nom_region")
         .agg(F.sum("__n").alias("admissions"), F.round(merged_avg("duree_sejour"), 1).alias("dms_moy"),
              F.round(merged_avg("cout_hospitalisation"), 0).alias("cout_moy")))
    return g.orderBy(F.desc("admissions"), F.asc_nulls_first("nom_hopital"), F.asc_nulls_first("nom_region")).limit(k)


def report_regions(wh: Warehouse) -> DataFrame:
    """Per region of the hospital: admissions, distinct patients, mean cost."""
    per = (wh.fact_admissions.groupBy("hopital_id", "patient_id")
           .agg(_n().alias("__n"), *avg_parts("cout_hospitalisation")))
    r = wh.dim_region.select("region_id", "nom_region")
    hr = wh.dim_hospital.select("hopital_id", "region_id").join(r, "region_id", "inner")
    return (join_dim(per, hr, "hopital_id").groupBy("nom_region")
            .agg(F.sum("__n").alias("admissions"), F.count_distinct("patient_id").alias("patients_uniques"),
                 F.round(merged_avg("cout_hospitalisation"), 0).alias("cout_moy")))


def report_monthly(wh: Warehouse, k: int = 12) -> DataFrame:
    """The last k months: admissions, mean stay, total cost."""
    fa = wh.fact_admissions.select("temps_id", "duree_sejour", "cout_hospitalisation")
    g = (fa.join(_cal(wh, "annee", "mois", "nom_mois"), "temps_id").groupBy("annee", "mois", "nom_mois")
         .agg(_n().alias("admissions"), F.round(F.avg("duree_sejour"), 1).alias("dms_moy"),
              F.round(F.sum("cout_hospitalisation"), 0).alias("ca_total")))
    return g.orderBy(F.desc("annee"), F.desc("mois")).limit(k)


def report_sex(wh: Warehouse) -> DataFrame:
    """Per sex: admissions, mean age, mean stay."""
    p = wh.dim_patient.select("patient_id", "sexe", "age")
    j = join_dim(per_key(wh.fact_admissions, "patient_id"), p, "patient_id")
    # the mean age is over admissions: each patient's age weighs its admission count
    n_known_age = F.when(F.col("age").isNotNull(), F.col("__n"))
    mean_age = F.try_divide(F.sum(F.col("age") * F.col("__n")), F.sum(n_known_age).cast("double"))
    return (j.groupBy("sexe")
            .agg(F.sum("__n").alias("admissions"), F.round(mean_age, 1).alias("age_moyen"),
                 F.round(merged_avg("duree_sejour"), 1).alias("dms_moy")))


def report_occupancy(wh: Warehouse, k: int = 8) -> DataFrame:
    """Top hospitals by mean sensor occupancy, with peak and alert count."""
    per = wh.fact_bed_occupancy.groupBy("hopital_id").agg(
        *avg_parts("taux_occupation"), F.max("taux_occupation").alias("__max"), F.sum("alertes").alias("__alertes"))
    h = wh.dim_hospital.select("hopital_id", F.col("nom").alias("hopital"))
    g = (join_dim(per, h, "hopital_id").groupBy("hopital")
         .agg(F.round(merged_avg("taux_occupation"), 1).alias("taux_moy"), F.max("__max").alias("pic_max"),
              F.sum("__alertes").cast("bigint").alias("nb_alertes")))
    return g.orderBy(F.desc("taux_moy"), F.asc_nulls_first("hopital")).limit(k)


def cases_by_category(wh: Warehouse) -> DataFrame:
    """Admissions per disease category."""
    per = wh.fact_admissions.groupBy("maladie_id").agg(_n().alias("__n"))
    m = wh.dim_disease.select("maladie_id", "categorie")
    return join_dim(per, m, "maladie_id").groupBy("categorie").agg(F.sum("__n").alias("nb_cas"))


def top_occupancy_hospitals(wh: Warehouse, k: int = 5) -> DataFrame:
    """Top hospitals (ids) by mean sensor occupancy, with the maximum."""
    g = (wh.fact_bed_occupancy.groupBy("hopital_id")
         .agg(F.round(F.avg("taux_occupation"), 1).alias("taux_moy"), F.max("taux_occupation").alias("taux_max")))
    return g.orderBy(F.desc("taux_moy"), F.asc_nulls_first("hopital_id")).limit(k)


def occupancy_by_hour(wh: Warehouse) -> DataFrame:
    """Mean occupancy per hour of day."""
    return wh.fact_bed_occupancy.groupBy("heure").agg(F.round(F.avg("taux_occupation"), 2).alias("taux_moy"),
                                                      _n().alias("nb_mesures"))


def occupancy_by_service(wh: Warehouse) -> DataFrame:
    """Mean occupancy per service."""
    return wh.fact_bed_occupancy.groupBy("service_id").agg(F.round(F.avg("taux_occupation"), 2).alias("taux_moy"),
                                                           _n().alias("nb_mesures"))


def matrix_disease_region(wh: Warehouse) -> DataFrame:
    """Admissions per disease and patient region, one row per pair that occurs.

    The long form takes any number of regions, and those without a name, and
    reads nothing to the driver; a fixed list of columns is one pivot away.
    """
    p = wh.dim_patient.select("patient_id", "region_id")
    r = wh.dim_region.select("region_id", "nom_region")
    m = wh.dim_disease.select("maladie_id", "nom_maladie")
    per = wh.fact_admissions.groupBy("patient_id", "maladie_id").agg(_n().alias("__n"))
    g = join_dim(per, p, "patient_id").groupBy("region_id", "maladie_id").agg(F.sum("__n").alias("__n"))
    j = join_dim(join_dim(g, r, "region_id"), m, "maladie_id")
    return j.groupBy("nom_maladie", "nom_region").agg(F.sum("__n").alias("n"))


def pivot_disease_age_band(wh: Warehouse, bands: Sequence[str] = AGE_BANDS) -> DataFrame:
    """R10 as a matrix: admissions per disease category, one column per age band of ``bands``.

    The columns are the caller's list, so nothing is read to the driver to plan
    the pivot; ``autres`` counts admissions whose band is not in the list or
    unknown, so that a row always adds up to ``total``.
    """
    p = wh.dim_patient.select("patient_id", "tranche_age")
    m = wh.dim_disease.select("maladie_id", "categorie")
    per = wh.fact_admissions.groupBy("patient_id", "maladie_id").agg(_n().alias("__n"))
    g = join_dim(per, p, "patient_id").groupBy("maladie_id", "tranche_age").agg(F.sum("__n").alias("__n"))
    return pivot_counts(join_dim(g, m, "maladie_id"), ["categorie"], "tranche_age", bands, "__n")


def category_trend(wh: Warehouse) -> DataFrame:
    """Monthly admissions per disease category."""
    m = wh.dim_disease.select("maladie_id", "categorie")
    per = wh.fact_admissions.groupBy("temps_id", "maladie_id").agg(_n().alias("__n"))
    j = join_dim(per.join(_cal(wh, "annee", "mois"), "temps_id"), m, "maladie_id")
    return j.groupBy("annee", "mois", "categorie").agg(F.sum("__n").alias("admissions"))


def top_cities(wh: Warehouse, k: int = 10) -> DataFrame:
    """The k patient cities with most distinct admitted patients."""
    # distinct admitted patients first: the join sees each patient once
    admitted = wh.fact_admissions.select("patient_id").distinct()
    p = wh.dim_patient.select("patient_id", "ville")
    g = join_dim(admitted, p, "patient_id").groupBy("ville").agg(F.count_distinct("patient_id").alias("patients"))
    return g.orderBy(F.desc("patients"), F.asc_nulls_first("ville")).limit(k)


def top_hospital(wh: Warehouse) -> DataFrame:
    """The hospital with most admissions."""
    per = wh.fact_admissions.groupBy("hopital_id").agg(_n().alias("admissions"))
    h = wh.dim_hospital.select("hopital_id", "nom")
    g = join_dim(per, h, "hopital_id").select("hopital_id", "nom", "admissions")
    return g.orderBy(F.desc("admissions"), F.asc("hopital_id")).limit(1)


def top_consumed_drugs(wh: Warehouse, k: int = 10) -> DataFrame:
    """Drugs with the largest total consumption."""
    g = (wh.fact_pharmacy_stock.groupBy("code_medicament", "nom_medicament")
         .agg(F.sum("consommation_j").cast("bigint").alias("consommation_totale")))
    return g.orderBy(F.desc("consommation_totale"), F.asc("code_medicament")).limit(k)


def stock_alert_trend(wh: Warehouse) -> DataFrame:
    """Stock rows under their alert threshold, per day."""
    return (wh.fact_pharmacy_stock.groupBy("date")
            .agg(F.sum("sous_seuil_alerte").cast("bigint").alias("nb_sous_seuil"), _n().alias("nb_lignes")))


def abnormal_by_month(wh: Warehouse) -> DataFrame:
    """Abnormal lab results per month."""
    fl = wh.fact_lab.select("temps_id", "est_anormal").join(_cal(wh, "annee", "mois"), "temps_id")
    return fl.groupBy("annee", "mois").agg(F.sum("est_anormal").cast("bigint").alias("nb_anormaux"),
                                          _n().alias("nb_analyses"))


def national_stats(wh: Warehouse, regions: DataFrame, epidemics: DataFrame) -> DataFrame:
    """National totals from the reference tables and the landed payloads.

    ``regions`` has ``taux_mortalite`` per region (mean to two decimals, regions
    without a figure left out), ``epidemics`` a ``statut`` per epidemic: those in
    ``EPIDEMIC_ACTIVE`` count.  One aggregate per table; all but the first enter as
    scalar subqueries (no join of one-row frames).
    """
    h = wh.dim_hospital
    active = F.sum(F.when(F.col("statut").isin(*EPIDEMIC_ACTIVE), 1).otherwise(0))
    return wh.dim_region.agg(
        F.sum("population").alias("population_totale"),
        F.count(F.lit(1)).alias("nb_regions"),
    ).select(
        "population_totale",
        h.select(F.count(F.lit(1))).scalar().alias("nb_hopitaux"),
        h.select(F.sum("nb_medecins")).scalar().alias("nb_medecins"),
        h.select(F.sum("capacite_lits")).scalar().alias("capacite_totale"),
        "nb_regions",
        regions.select(F.round(F.avg("taux_mortalite"), 2)).scalar().alias("taux_mortalite_moyen"),
        F.coalesce(epidemics.select(active).scalar(), F.lit(0)).cast("bigint").alias("epidemies_actives"),
    )


def hospital_scorecard(wh: Warehouse) -> DataFrame:
    """Per hospital, admissions figures next to sensor occupancy.

    Drill-across: each fact is aggregated to one row per hospital first, then
    the two small results are joined (full outer) — facts are never joined row
    to row.
    """
    adm = (wh.fact_admissions.groupBy("hopital_id")
           .agg(_n().alias("admissions"), F.round(F.avg("duree_sejour"), 2).alias("dms_moy"),
                F.round(F.avg("cout_hospitalisation"), 2).alias("cout_moy")))
    occ = (wh.fact_bed_occupancy.groupBy("hopital_id")
           .agg(F.round(F.avg("taux_occupation"), 2).alias("taux_occupation_moy")))
    return adm.join(occ, "hopital_id", "full")


def occupancy_level_mix(wh: Warehouse) -> DataFrame:
    """Sensor readings per occupancy level."""
    return (wh.fact_bed_occupancy.select(occupancy_level("taux_occupation").alias("niveau_occupation"))
            .groupBy("niveau_occupation").agg(_n().alias("nb_mesures")))
