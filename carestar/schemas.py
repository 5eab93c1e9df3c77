"""Schemas of the warehouse tables.

FIXED VALUES: table layouts that must equal the reference's (column names, in
order), with the types of the bound data.  The build projects every table onto
its schema when it writes it, and the tests compare with the same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DDL = {
    "dim_date": "temps_id int, date date, jour int, mois int, annee int, trimestre int, semaine int, "
                "jour_semaine string, est_weekend int, nom_mois string",
    "dim_region": "region_id int, nom_region string, population double, superficie double, chef_lieu string",
    "dim_hospital": "hopital_id bigint, nom string, ville string, region_id int, capacite_lits double, type string, "
                    "nb_medecins double",
    "dim_service": "service_id int, nom_service string, departement string, specialite string, nb_lits double",
    "dim_disease": "maladie_id bigint, nom_maladie string, code_cim10 string, categorie string, gravite int, "
                   "est_chronique int",
    "dim_patient": "patient_id bigint, nom string, prenom string, date_naissance date, age double, sexe string, "
                   "tranche_age string, region_id int, ville string",
    "fact_admissions": "admission_id bigint, patient_id bigint, temps_id int, hopital_id bigint, service_id int, "
                       "maladie_id bigint, duree_sejour int, est_urgence int, mode_admission string, "
                       "mode_sortie string, service string, nb_lits_utilises int, cout_hospitalisation double, "
                       "cout_sejour double, est_readmission int, date_admission date",
    "fact_emergency": "urgence_id string, patient_id bigint, temps_id int, hopital_id bigint, "
                      "temps_attente_minutes int, niveau_urgence int, disposition string, est_hospitalise int, "
                      "duree_prise_en_charge int",
    "fact_lab": "labo_id bigint, patient_id bigint, temps_id int, hopital_id bigint, type_test string, "
                "resultat_numerique double, unite string, est_anormal int, valeur_ref_min double, "
                "valeur_ref_max double",
    "fact_prescriptions": "prescription_id bigint, patient_id bigint, temps_id int, hopital_id bigint, service_id int, "
                          "medicament string, dosage string, duree_jours int, est_chronique int, quantite double, "
                          "prix_unitaire double",
    "fact_bed_occupancy": "capteur_id bigint, hopital_id bigint, service_id int, temps_id int, date date, heure int, "
                          "lits_occupes int, lits_total int, taux_occupation double, alertes int",
    "fact_pharmacy_stock": "stock_id string, temps_id int, date date, code_medicament bigint, nom_medicament string, "
                           "stock_disponible int, consommation_j bigint, prix_unitaire double, valeur_stock double, "
                           "sous_seuil_alerte int",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's columns in order and of its types; columns beyond them (storage, reasons) follow.

    A missing column, or one whose values the type cannot hold, is an error.
    """
    fields = schema(table).fields
    names = {f.name for f in fields}
    if missing := sorted(names - set(df.columns)):
        raise ValueError(f"{table} lacks {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields],
                     *[c for c in df.columns if c not in names])
