"""Query registrations: the measure layer."""

from __future__ import annotations

from ..session import scratch_path
from .catalog import bi_query
from .measures import MEASURES, hospital_model, measure, month_over_month, monthly_patient_bitmaps, yearly_patients


def _m(keys, by=(), slicers=None):
    return lambda wh: measure(hospital_model(wh), MEASURES, keys, by=by, slicers=slicers)


bi_query("measures_admissions", _m(["total_admissions", "patients_distincts", "dms_moyen", "cout_moyen_sejour",
                                    "cout_total", "pct_admissions_urgences", "admissions_programmees"], by=["annee"]))
bi_query("measure_readmission", _m(["taux_readmission"], by=["annee"]))
bi_query("measures_patients", _m(["age_moyen_patients", "patients_hommes", "patientes_femmes", "pct_femmes"],
                                 by=["nom_region"]))
bi_query("measures_capacity", _m(["hopitaux_actifs", "capacite_totale_lits", "taux_occupation_moyen",
                                  "pic_occupation", "alertes_capacite", "ratio_charge"], by=["type"]))
bi_query("measures_disease", _m(["pathologies_distinctes", "maladies_chroniques", "pct_maladies_chroniques",
                                 "dms_chroniques", "dms_aigues"], by=["categorie"]))
bi_query("measures_lab", _m(["total_analyses", "analyses_par_admission", "taux_anomalies"]))
bi_query("measures_rx", _m(["total_prescriptions", "prescriptions_par_admission", "cout_medicaments_total"],
                           by=["annee"]))
bi_query("measures_stock", _m(["valeur_stock_total", "ruptures_stock", "pct_alerte_stock"], by=["annee"]))
bi_query("measures_weekend", _m(["admissions_semaine", "admissions_weekend"], by=["annee"]))
bi_query("measures_month_over_month", lambda wh: month_over_month(wh.fact_admissions, wh.dim_date))
# replace vs intersect: a year slicer and a mode slicer; "programmées" replaces the mode
# slicer, "DMS chroniques" intersects it
bi_query("measures_by_slicer", _m(["total_admissions", "admissions_programmees", "pct_admissions_urgences",
                                   "dms_moyen", "dms_chroniques"], by=["nom_region"],
                                  slicers={"annee": [2000], "mode_admission": ["Urgence"]}))
bi_query("measures_by_axis", _m(["total_admissions", "cout_total", "population", "taux_100k"], by=["nom_region"]))
# One key per remaining axis
for _name, _keys, _by in [
    ("measures_by_month", ["total_admissions", "pct_admissions_urgences"], ["annee", "mois"]),
    ("measures_by_hospital", ["total_admissions", "dms_moyen"], ["hopital_id"]),
    ("measures_by_sex", ["total_admissions", "dms_moyen"], ["sexe"]),
    ("measures_by_age_band", ["total_admissions", "pct_admissions_urgences"], ["tranche_age"]),
    ("measures_by_category", ["total_admissions", "dms_moyen"], ["categorie"]),
    ("measures_by_chronic", ["total_admissions", "dms_moyen"], ["est_chronique"]),
    ("measures_by_test_type", ["total_analyses", "taux_anomalies"], ["type_test"]),
]:
    bi_query(_name, _m(_keys, by=_by))


def yearly_patients_from_months(wh):
    """M2 rolled up: monthly bitmaps written once, years merged from what was written."""
    path = scratch_path(wh.spark, "patient-bitmaps")
    monthly_patient_bitmaps(wh.fact_admissions, wh.dim_date, path)
    return yearly_patients(wh.spark.read.parquet(path))


bi_query("measures_yearly_patients", yearly_patients_from_months)
# several distinct counts next to each other: a bitmap plan for each, no expanded rows
bi_query("measures_distinct", _m(["patients_distincts", "pathologies_distinctes", "hopitaux_actifs"], by=["annee"]))
