"""Query registrations: data quality (Q), filters/projections (F, P), bins (B), mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (age_band_staging, age_band_warehouse, flag_label, iso_date, non_blank, normalize_sex,
                         occupancy_level, postcode, stay_class)
from ..operators import audit_state as A
from ..operators import dims as D
from ..operators import quality as Q
from ..operators.joins import bounded
from ..operators.mart import analytics_mart
from ..session import scratch_path
from ..sources import binding as B
from .catalog import bi_query, wh_query
from .warehouse import Warehouse


def _patients_raw(wh: Warehouse) -> DataFrame:
    return B.stg_patients_raw(wh.spark, wh.sf_dir)


def _admissions_audited(wh: Warehouse) -> DataFrame:
    return wh.stg_admissions_raw.withColumn("duree_sejour", F.datediff("date_sortie", "date_admission"))


# Calendar covering every year of the admissions (read from the data)
wh_query("dim_date", lambda wh: D.calendar(D.year_bounds((wh.table("orders"), "o_orderdate"))))

# Q1 / Q2: latest / earliest version of each admission
wh_query("dedup_keep_last", lambda wh: wh.stg_admissions)
wh_query("dedup_keep_first", lambda wh: B.admission_details(B.one_per_admission(wh.spark, wh.sf_dir, keep="first")))


def _in_part(wh: Warehouse) -> DataFrame:
    """Raw admissions with ``in_part``: those whose disease is in the part table (unique there) are prescriptions too.

    One lineitem-orders join serves the audits of both tables.
    """
    part = wh.table("part").select(F.col("p_partkey").alias("maladie_id"), F.lit(True).alias("in_part"))
    return _admissions_audited(wh).join(part, "maladie_id", "left")


def dedup_stats(wh: Warehouse) -> DataFrame:
    hospitals, labs = B.stg_hospitals(wh.spark, wh.sf_dir), B.stg_labs(wh.spark, wh.sf_dir)
    return A.duplicate_report(
        A.audit_state(_in_part(wh), "admission_id", [A.Audited("stg_admissions"),
                                                     A.Audited("stg_medicaments", where=F.col("in_part"))])
        .unionByName(A.audit_state(_patients_raw(wh), "patient_id", [A.Audited("stg_patients")]))
        .unionByName(A.audit_state(hospitals, "hopital_id", [A.Audited("stg_hopitaux")]))
        .unionByName(A.audit_state(labs, "labo_id", [A.Audited("stg_laboratoires")])))


wh_query("dedup_stats", dedup_stats)

# Q3–Q6: normalisation
wh_query("normalize_sex", lambda wh: _patients_raw(wh).select(
    "patient_id", "sexe", normalize_sex("sexe").alias("sexe_norm")))
wh_query("normalize_age", lambda wh: Q.keep_range(_patients_raw(wh).select("patient_id", "age"), "age", 0, 120))
wh_query("normalize_dates", lambda wh: _patients_raw(wh).select(
    "patient_id", "date_naissance", iso_date("date_naissance").alias("date_naissance_iso")))
wh_query("normalize_postcode", lambda wh: B.stg_hospitals(wh.spark, wh.sf_dir).select(
    "hopital_id", "code_postal", postcode("code_postal").alias("code_postal_norm")))


# Q7 / Q10: audit and quality score
def quality_audit(wh: Warehouse) -> DataFrame:
    admissions = A.audit_state(_in_part(wh), "admission_id", [
        A.Audited("stg_admissions", Q.admission_audit_metrics()),
        A.Audited("stg_medicaments", where=F.col("in_part"))])
    patients = A.audit_state(_patients_raw(wh), "patient_id", [A.Audited("stg_patients", Q.patient_audit_metrics())])
    labs = A.audit_state(B.stg_labs(wh.spark, wh.sf_dir), "labo_id", [
        A.Audited("stg_laboratoires", {"nulls_result": F.col("resultat").isNull()})])
    return A.audit_report(admissions.unionByName(patients).unionByName(labs))


def audit_by_load(wh: Warehouse) -> DataFrame:
    """Two loads of admissions, each audited when it lands; the report merges what was stored."""
    raw, path = _admissions_audited(wh), scratch_path(wh.spark, "audit-states")
    cut = F.col("date_admission") < F.lit(dt.date(1998, 1, 1))
    for load, rows in (("1", raw.filter(cut)), ("2", raw.filter(~cut | F.col("date_admission").isNull()))):
        A.store_load(A.audit_state(rows, "admission_id", [A.Audited("stg_admissions", Q.admission_audit_metrics())]),
                     path, load)
    return A.audit_report(wh.spark.read.parquet(path).drop("load"))


wh_query("audit_by_load", audit_by_load)
wh_query("quality_audit", quality_audit)
wh_query("quality_score", lambda wh: Q.quality_score(quality_audit(wh)))


# Q8 / Q12: rule validation
def validate_rules(wh: Warehouse) -> DataFrame:
    p = Q.validate(_patients_raw(wh), Q.patient_rules()).withColumn("table_name", F.lit("stg_patients"))
    a = Q.validate(wh.stg_admissions_raw, Q.admission_rules()).withColumn("table_name", F.lit("stg_admissions"))
    return p.unionByName(a).select("table_name", "rule", "violations")


wh_query("validate_rules", validate_rules)

# Q9: admissions whose patient is missing
bi_query("orphan_check", lambda wh: Q.orphan_counts(wh.fact_admissions, wh.dim_patient, "patient_id")
         .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphelins")))

# Q11: value counts
bi_query("value_counts", lambda wh: Q.value_counts(wh.dim_patient, "tranche_age"))

# keys that are neither NULL nor empty
wh_query("filter_blank_keys", lambda wh: _patients_raw(wh).filter(non_blank("patient_id")).select("patient_id", "nom"))

# Computed product column
bi_query("prescription_cost", lambda wh: wh.fact_prescriptions.select(
    "prescription_id", "quantite", "prix_unitaire",
    F.round(F.col("quantite") * F.col("prix_unitaire"), 2).alias("cout")))

# P5: typed projection driven by a schema
PATIENT_TYPED = T.StructType([
    T.StructField("patient_id", T.LongType()), T.StructField("nom", T.StringType()),
    T.StructField("age", T.IntegerType()), T.StructField("sexe", T.StringType()),
    T.StructField("date_naissance", T.DateType()),
])


def typed_projection(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One ``try_cast`` per column (dates through the ISO-prefix parser); absent
    columns become typed NULLs."""
    from ..functions import to_date
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(to_date(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


wh_query("typed_projection", lambda wh: typed_projection(_patients_raw(wh), PATIENT_TYPED))

# Bins and labels
wh_query("age_band_warehouse", lambda wh: _patients_raw(wh).select(
    "patient_id", "age", age_band_warehouse("age").alias("tranche_age")))
wh_query("age_band_staging", lambda wh: _patients_raw(wh).select(
    "patient_id", "age", age_band_staging("age").alias("tranche_age")))
bi_query("stay_class", lambda wh: wh.fact_admissions.select(
    "admission_id", "duree_sejour", stay_class("duree_sejour").alias("categorie_dms")))
bi_query("occupancy_level", lambda wh: wh.fact_bed_occupancy.select(
    "capteur_id", "taux_occupation", occupancy_level("taux_occupation").alias("niveau_occupation")))


def flag_labels(wh: Warehouse) -> DataFrame:
    cal = bounded(wh.dim_date.select("temps_id", "est_weekend"), wh.calendar_rows)
    return (wh.fact_lab.join(cal, "temps_id")
            .select("labo_id", flag_label("est_anormal", "Anormal", "Normal").alias("statut_resultat"),
                    flag_label("est_weekend", "Weekend", "Semaine").alias("type_jour")))


bi_query("flag_labels", flag_labels)
bi_query("disease_chronic_label", lambda wh: wh.dim_disease.select(
    "maladie_id", flag_label("est_chronique", "Oui", "Non").alias("chronique")))

# Denormalised mart
bi_query("analytics_mart", lambda wh: analytics_mart(wh.fact_admissions, wh.dim_patient, wh.dim_hospital,
                                                     wh.dim_region, wh.dim_disease, wh.dim_date,
                                                     calendar_rows=wh.calendar_rows))
# Columns of the admissions fact, read from the published build
bi_query("stay_duration", lambda wh: wh.fact_admissions.select("admission_id", "duree_sejour"))
bi_query("date_key_lookup", lambda wh: wh.fact_admissions.select("admission_id", "date_admission", "temps_id"))
bi_query("readmission_flag", lambda wh: wh.fact_admissions_readmit.select(
    "admission_id", "patient_id", "date_admission", "est_readmission"))
