"""Dimensions and facts on hand-written rows (calendar, stay, date keys, readmission)."""

import datetime as dt

from pyspark.sql import functions as F

from carestar.operators import dims as D
from carestar.operators import facts as X
from conftest import rows

D1 = dt.date


def test_calendar_iso_week_leap_day_weekend(spark):
    cal = D.dim_date(spark, D1(2022, 1, 1), D1(2026, 12, 31))
    assert cal.count() >= 1826
    r = {x["date"]: x for x in cal.filter(F.col("date").isin(D1(2023, 1, 1), D1(2024, 2, 29), D1(2022, 1, 1)))
         .collect()}
    assert r[D1(2023, 1, 1)]["semaine"] == 52 and r[D1(2023, 1, 1)]["jour_semaine"] == "Dimanche"
    assert r[D1(2023, 1, 1)]["est_weekend"] == 1
    assert r[D1(2024, 2, 29)]["nom_mois"] == "Février" and r[D1(2024, 2, 29)]["trimestre"] == 1
    assert r[D1(2022, 1, 1)]["temps_id"] == 1
    years = cal.agg(F.min("annee"), F.max("annee")).collect()[0]
    assert tuple(years) == (2022, 2026)


def _adm(spark):
    return spark.createDataFrame(
        [("A00001", "P0001", "2024-01-10", "1", "H01", "S1", "M1", "Cardio"),
         ("A00002", "P0002", "2024-02-14", "0", "H05", "S2", "M2", None),
         ("A00003", "P0003", "2024-03-05", "1", "H03", "S1", "M1", None),
         ("A00004", "P0001", "2030-01-01", "0", "H01", "S1", "M1", None)],  # outside the calendar
        "admission_id string, patient_id string, date_admission string, urgence string, hopital_id string, "
        "service_id string, maladie_id string, service string")


def test_fact_admissions_left_joins_discharges_and_drops_outside_calendar(spark):
    # reference test fixture: A00001 -> 2024-01-15, A00002 -> 2024-02-18, A00003 absent
    sor = spark.createDataFrame([("A00001", "2024-01-15"), ("A00002", "2024-02-18")],
                                "admission_id string, date_sortie string")
    cal = D.dim_date(spark, D1(2024, 1, 1), D1(2024, 12, 31))
    fact = X.fact_admissions(_adm(spark), cal, discharges=sor, daily_rate=100.0)
    got = {r["admission_id"]: r for r in fact.collect()}
    assert set(got) == {"A00001", "A00002", "A00003"}
    assert got["A00001"]["duree_sejour"] == 5 and got["A00002"]["duree_sejour"] == 4
    assert 1 <= got["A00003"]["duree_sejour"] <= 10   # imputed, reproducible
    assert got["A00001"]["mode_admission"] == "Urgence" and got["A00002"]["mode_admission"] == "Programmée"
    assert got["A00001"]["cout_hospitalisation"] == 500.0
    again = {r["admission_id"]: r["duree_sejour"] for r in X.fact_admissions(_adm(spark), cal, discharges=sor).collect()}
    assert again["A00003"] == got["A00003"]["duree_sejour"]


def test_stay_without_imputation_and_min_one_day(spark):
    df = spark.createDataFrame([("a", "2024-01-10", "2024-01-10"), ("b", "2024-01-10", "2024-01-05"),
                                ("c", "2024-01-10", None), ("d", "2024-01-10", "2024-02-30")],
                               "id string, d1 string, d2 string")
    out = rows(df.select("id", X.stay_days("d1", "d2", "id", impute=None).alias("s")))
    assert out == [("a", 1), ("b", 1), ("c", None), ("d", None)]


def test_readmission_flag_gap_rules(spark):
    f = spark.createDataFrame(
        [(1, "P", D1(2024, 1, 1), 3),    # first stay, out 01-04
         (2, "P", D1(2024, 1, 20), 2),   # 16 days after -> readmission
         (3, "P", D1(2024, 3, 30), 1),   # 68 days after 01-22 -> not
         (4, "P", D1(2024, 3, 30), 5),   # same day as 3: not a readmission of it
         (5, "Q", D1(2024, 1, 1), 40),   # long stay, out 02-10
         (6, "Q", D1(2024, 1, 15), 1)],  # admitted before the previous discharge -> gap < 0 -> not
        "admission_id int, patient_id string, date_admission date, duree_sejour int")
    got = {r["admission_id"]: r["est_readmission"] for r in X.with_readmission(f).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0}


def test_fact_emergency_text_or_number_flag(spark):
    cal = D.dim_date(spark, D1(2024, 1, 1), D1(2024, 12, 31))
    adm = _adm(spark).withColumn("disposition", F.when(F.col("admission_id") == "A00001", "Hospitalisé"))
    out = X.fact_emergency(adm, cal).collect()
    assert sorted(r["urgence_id"] for r in out) == ["URG-A00001", "URG-A00003"]
    assert {r["urgence_id"]: r["est_hospitalise"] for r in out} == {"URG-A00001": 1, "URG-A00003": 0}


def test_dim_patient_region_lookup_default(spark):
    regions = spark.createDataFrame([("R02", "Bretagne", "100"), ("R03", "Normandie", "0")],
                                    "region_id string, nom_region string, population string")
    src = spark.createDataFrame([("P1", "A", "45", "M", "Bretagne"), ("P2", "B", "x", "F", "Atlantis"),
                                 ("P1", "A2", "46", "M", "Bretagne")],
                                "patient_id string, nom string, age string, sexe string, region string")
    out = {r["patient_id"]: r for r in D.dim_patient(src, D.dim_region(regions), "R01").collect()}
    assert out["P1"]["region_id"] == "R02" and out["P2"]["region_id"] == "R01"
    assert out["P2"]["tranche_age"] == "31-50" and out["P2"]["age"] is None
    assert len(out) == 2


def test_dim_defaults(spark):
    h = spark.createDataFrame([("H1", "n", None, "abc")], "hopital_id string, nom string, capacite_lits string, nb_medecins string")
    r = D.dim_hospital(h).collect()[0]
    assert (r["capacite_lits"], r["nb_medecins"]) == (200.0, 50.0)
    m = spark.createDataFrame([("M1", "Grippe", None)], "maladie_id string, nom string, gravite string")
    r = D.dim_disease(m).collect()[0]
    assert (r["nom_maladie"], r["gravite"], r["est_chronique"]) == ("Grippe", 3, 0)


def test_first_non_empty(spark):
    empty = spark.createDataFrame([], "a int")
    full = spark.createDataFrame([(1,)], "a int")
    assert D.first_non_empty(empty, full).count() == 1
