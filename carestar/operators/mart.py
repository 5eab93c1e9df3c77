"""Denormalised analytics mart: admissions with every dimension (33 columns).

The snowflake branch hospital -> region is resolved on the dimension side
first (two small tables), so the fact takes exactly one join per dimension
and never fans out (every dimension is unique on its key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_dim

MART_COLUMNS = [
    "admission_id", "patient_id", "nom", "prenom", "sexe", "age", "tranche_age", "ville",
    "hopital_id", "nom_hopital", "type_hopital", "capacite_lits", "ville_hopital", "nom_region", "pop_region",
    "maladie_id", "nom_maladie", "categorie_maladie", "code_cim10", "est_chronique",
    "temps_id", "date", "annee", "trimestre", "mois", "nom_mois", "semaine", "est_weekend",
    "duree_sejour", "cout_hospitalisation", "mode_admission", "mode_sortie", "service",
]


def analytics_mart(fact: DataFrame, dim_patient: DataFrame, dim_hospital: DataFrame, dim_region: DataFrame,
                   dim_disease: DataFrame, dim_date: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    p = dim_patient.select("patient_id", "nom", "prenom", "sexe", "age", "tranche_age", "ville")
    r = dim_region.select("region_id", "nom_region", F.col("population").alias("pop_region"))
    h = (dim_hospital.select("hopital_id", F.col("nom").alias("nom_hopital"), F.col("type").alias("type_hopital"),
                             "capacite_lits", F.col("ville").alias("ville_hopital"), "region_id")
         .join(r, "region_id", "left").drop("region_id"))
    m = dim_disease.select("maladie_id", "nom_maladie", F.col("categorie").alias("categorie_maladie"),
                           "code_cim10", "est_chronique")
    t = dim_date.select("temps_id", "date", "annee", "trimestre", "mois", "nom_mois", "semaine", "est_weekend")
    f = fact.select("admission_id", "patient_id", "hopital_id", "maladie_id", "temps_id", "duree_sejour",
                    "cout_hospitalisation", "mode_admission", "mode_sortie", "service")
    j = join_dim(f, p, "patient_id", "left")
    j = join_dim(j, h, "hopital_id", "left")
    j = join_dim(j, m, "maladie_id", "left")
    j = join_dim(j, t, "temps_id", "left", bounded_rows=calendar_rows)
    return j.select(*MART_COLUMNS)
