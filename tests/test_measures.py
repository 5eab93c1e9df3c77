"""Measure layer: filter-context rules on a hand-built model."""

import datetime as dt

from carestar.operators import dims as D
from carestar.plans.measures import MEASURES, Model, measure, month_over_month
from conftest import rows


def _model(spark):
    cal = D.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    fa = spark.createDataFrame(
        [(1, "P1", 1, "H1", "M1", 3, "Urgence", 600.0),     # 2024-01-01 (Monday)
         (2, "P1", 6, "H1", "M2", 0, "Programmée", 0.0),    # 2024-01-06 (Saturday)
         (3, "P2", 68, "H2", "M1", 5, "Urgence", 1000.0),   # March
         (4, "P3", 68, "H2", "M2", 2, "Programmée", 400.0)],
        "admission_id int, patient_id string, temps_id int, hopital_id string, maladie_id string, "
        "duree_sejour int, mode_admission string, cout_hospitalisation double")
    dm = spark.createDataFrame([("M1", "Grippe", "Infectieuse", 0), ("M2", "Diabète", "Métabolique", 1)],
                               "maladie_id string, nom_maladie string, categorie string, est_chronique int")
    dp = spark.createDataFrame([("P1", "M", 40.0, "R1"), ("P2", "F", 60.0, "R1"), ("P3", "F", 20.0, "R2"),
                                ("P4", "F", 30.0, "R2")],
                               "patient_id string, sexe string, age double, region_id string")
    dr = spark.createDataFrame([("R1", "Nord", 1000.0), ("R2", "Sud", 0.0)],
                               "region_id string, nom_region string, population double")
    tables = {"fact_admissions": fa, "dim_date": cal, "dim_disease": dm, "dim_patient": dp, "dim_region": dr}
    rel = [("fact_admissions", "temps_id", "dim_date", "temps_id"),
           ("fact_admissions", "maladie_id", "dim_disease", "maladie_id"),
           ("fact_admissions", "patient_id", "dim_patient", "patient_id"),
           ("dim_patient", "region_id", "dim_region", "region_id")]
    return Model(tables, rel)


def test_grand_totals_and_divide(spark):
    out = measure(_model(spark), MEASURES, ["total_admissions", "patients_distincts", "dms_moyen",
                                            "pct_admissions_urgences", "taux_readmission"]).collect()[0]
    assert out["total_admissions"] == 4 and out["patients_distincts"] == 3
    assert out["dms_moyen"] == round((3 + 5 + 2) / 3, 4)          # stays of 0 days excluded
    assert out["pct_admissions_urgences"] == 50.0
    assert out["taux_readmission"] == round(100 / 3, 4)           # P1 has two stays


def test_replace_versus_intersect(spark):
    m = _model(spark)
    out = {r["mois"]: r for r in measure(m, MEASURES, ["total_admissions", "admissions_programmees",
                                                        "dms_chroniques"],
                                         by=["mois"], slicers={"mode_admission": ["Urgence"]}).collect()}
    # the slicer keeps urgent rows, but "programmées" replaces it with its own filter
    assert out[1]["total_admissions"] == 1 and out[1]["admissions_programmees"] == 1
    # "DMS chroniques" intersects: urgent AND chronic -> no row in January -> blank
    assert out[1]["dms_chroniques"] is None
    assert out[3]["total_admissions"] == 1 and out[3]["admissions_programmees"] == 1


def test_blank_instead_of_zero_and_weekend(spark):
    out = {r["mois"]: r for r in measure(_model(spark), MEASURES, ["admissions_weekend", "admissions_semaine"],
                                         by=["mois"]).collect()}
    assert out[1]["admissions_weekend"] == 1 and out[1]["admissions_semaine"] == 1
    assert out[3]["admissions_weekend"] is None and out[3]["admissions_semaine"] == 2


def test_cross_table_ratio_and_snowflake_axis(spark):
    out = {r["nom_region"]: r for r in measure(_model(spark), MEASURES,
                                               ["total_admissions", "population", "taux_100k", "pct_femmes"],
                                               by=["nom_region"]).collect()}
    assert out["Nord"]["taux_100k"] == 300.0
    assert out["Sud"]["taux_100k"] == 0.0          # DIVIDE by zero population -> 0
    # dim-level count (2 women in Sud) over admitted patients (1) can exceed 100 %
    assert out["Sud"]["pct_femmes"] == 200.0


def test_month_over_month_gap_safe(spark):
    m = _model(spark)
    out = rows(month_over_month(m.tables["fact_admissions"], m.tables["dim_date"]),
               "mois", "total_admissions", "admissions_periode_precedente", "delta_admissions",
               "pct_croissance_admissions")
    # January 2, February empty (previous = 2), March 2 with an empty February, April after March
    assert out == [(1, 2, None, 2, 0.0), (2, None, 2, -2, -100.0), (3, 2, None, 2, 0.0), (4, None, 2, -2, -100.0)]


def test_grand_total_parts_from_several_tables(spark):
    m = _model(spark)
    out = measure(m, MEASURES, ["total_admissions", "population", "taux_100k"]).collect()[0]
    assert out["total_admissions"] == 4 and out["population"] == 1000.0 and out["taux_100k"] == 400.0
