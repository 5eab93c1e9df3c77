"""Oracle SQL for data quality, normalisation, bins, labels and the mart."""

from .warehouse_sql import CTES, MONTHS, WEEKDAYS
from .warehouse_sql import with_warehouse as W

CTES["stg_patients_raw"] = """
  SELECT CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS patient_id,
         CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END AS nom,
         CASE WHEN c_custkey % 11 = 0 THEN '-5' WHEN c_custkey % 11 = 1 THEN '130' WHEN c_custkey % 11 = 2 THEN 'abc'
              WHEN c_custkey % 11 = 3 THEN NULL ELSE CAST(age AS VARCHAR) END AS age,
         CASE WHEN c_custkey % 7 = 0 THEN ' homme ' WHEN c_custkey % 7 = 1 THEN 'FE' WHEN c_custkey % 7 = 2 THEN NULL
              WHEN c_custkey % 7 = 3 THEN 'female' WHEN c_custkey % 7 = 4 THEN 'x'
              ELSE CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END END AS sexe,
         CASE WHEN c_custkey % 13 = 0 THEN '2024-02-30' WHEN c_custkey % 13 = 1 THEN ''
              WHEN c_custkey % 13 = 2 THEN '1980-05-06T08:00:00'
              ELSE strftime(make_date(2000 - age, CAST(1 + c_custkey % 12 AS INTEGER),
                                      CAST(1 + c_custkey % 28 AS INTEGER)), '%Y-%m-%d') END AS date_naissance,
         c_mktsegment AS ville
  FROM (SELECT *, CAST(floor((c_acctbal + 1000.0) / 100.0) AS INTEGER) AS age FROM customer)"""

CTES["stg_hospitals"] = """
  SELECT s_suppkey AS hopital_id,
         CASE WHEN s_suppkey % 4 = 0 THEN CAST(1000 + s_suppkey AS VARCHAR)
              WHEN s_suppkey % 4 = 1 THEN ' ' || CAST(75000 + s_suppkey % 100 AS VARCHAR) || ' '
              WHEN s_suppkey % 4 = 2 THEN CAST(750000 + s_suppkey AS VARCHAR) END AS code_postal
  FROM supplier"""

CTES["stg_labs"] = """
  SELECT event_id AS labo_id, CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS resultat
  FROM events"""

CTES["quality_audit"] = """
  SELECT 'stg_patients' AS table_name, metric, value FROM (
    UNPIVOT (SELECT count(*) AS total,
                    count(*) - (count(DISTINCT patient_id) + max(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END))
                      AS doublons,
                    CAST(sum(CASE WHEN nom IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_nom,
                    CAST(sum(CASE WHEN age IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_age,
                    CAST(sum(CASE WHEN TRY_CAST(age AS DOUBLE) < 0 OR TRY_CAST(age AS DOUBLE) > 120 THEN 1 ELSE 0 END)
                         AS BIGINT) AS age_invalide,
                    CAST(sum(CASE WHEN sexe IS NULL OR upper(sexe) NOT IN ('M', 'F') THEN 1 ELSE 0 END) AS BIGINT)
                      AS sexe_invalide
             FROM stg_patients_raw)
    ON total, doublons, nulls_nom, nulls_age, age_invalide, sexe_invalide INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'stg_admissions', metric, value FROM (
    UNPIVOT (SELECT count(*) AS total, count(*) - count(DISTINCT admission_id) AS doublons,
                    CAST(sum(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_pid,
                    CAST(sum(CASE WHEN date_admission IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_date,
                    CAST(sum(CASE WHEN date_diff('day', date_admission, date_sortie) < 0 THEN 1 ELSE 0 END) AS BIGINT)
                      AS duree_neg
             FROM stg_admissions_raw)
    ON total, doublons, nulls_pid, nulls_date, duree_neg INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'stg_laboratoires', metric, value FROM (
    UNPIVOT (SELECT count(*) AS total, count(*) - count(DISTINCT labo_id) AS doublons,
                    CAST(sum(CASE WHEN resultat IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_result
             FROM stg_labs)
    ON total, doublons, nulls_result INTO NAME metric VALUE value)
  UNION ALL
  SELECT 'stg_medicaments', metric, value FROM (
    UNPIVOT (SELECT count(*) AS total, count(*) - count(DISTINCT admission_id) AS doublons
             FROM stg_admissions_raw a JOIN part p ON a.maladie_id = p.p_partkey)
    ON total, doublons INTO NAME metric VALUE value)"""

INT_AGE = "COALESCE(TRY_CAST(age AS INTEGER), CAST(trunc(TRY_CAST(age AS DOUBLE)) AS INTEGER))"
TO_DATE = "COALESCE(TRY_CAST({x} AS DATE), TRY_CAST(substr({x}, 1, 10) AS DATE))"

SQL = {
    "dim_date": W(f"""
SELECT CAST(date_diff('day', s, d) AS INTEGER) + 1 AS temps_id, d AS "date",
       CAST(day(d) AS INTEGER) AS jour, CAST(month(d) AS INTEGER) AS mois, CAST(year(d) AS INTEGER) AS annee,
       CAST(quarter(d) AS INTEGER) AS trimestre, CAST(weekofyear(d) AS INTEGER) AS semaine,
       {WEEKDAYS}[isodow(d)] AS jour_semaine, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS est_weekend,
       {MONTHS}[month(d)] AS nom_mois
FROM (SELECT s, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT make_date(year(min(CAST(o_orderdate AS DATE))), 1, 1) AS s,
                   make_date(year(max(CAST(o_orderdate AS DATE))), 12, 31) AS e FROM orders))"""),
    "dedup_keep_last": W("SELECT * FROM stg_admissions"),
    "dedup_keep_first": W("""
SELECT * FROM stg_admissions_raw
QUALIFY row_number() OVER (PARTITION BY admission_id ORDER BY loaded_at ASC NULLS FIRST,
    maladie_id ASC NULLS FIRST, hopital_id ASC NULLS FIRST, l_quantity ASC NULLS FIRST,
    l_extendedprice ASC NULLS FIRST, l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST,
    l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST) = 1"""),
    "dedup_stats": W("""
SELECT table_name, avant, apres, avant - apres AS supprimes FROM (
  SELECT 'stg_admissions' AS table_name, count(*) AS avant, count(DISTINCT admission_id) AS apres
  FROM stg_admissions_raw
  UNION ALL
  SELECT 'stg_patients', count(*), count(DISTINCT patient_id) + max(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END)
  FROM stg_patients_raw
  UNION ALL
  SELECT 'stg_hopitaux', count(*), count(DISTINCT s_suppkey) FROM supplier
  UNION ALL
  SELECT 'stg_laboratoires', count(*), count(DISTINCT event_id) FROM events
  UNION ALL
  SELECT 'stg_medicaments', count(*), count(DISTINCT admission_id)
  FROM stg_admissions_raw a JOIN part p ON a.maladie_id = p.p_partkey)"""),
    "normalize_sex": W("""
SELECT patient_id, sexe,
       CASE WHEN upper(trim(sexe)) IN ('HOMME', 'H', 'MALE') THEN 'M'
            WHEN upper(trim(sexe)) IN ('FEMME', 'FEMALE', 'FE') THEN 'F' ELSE upper(trim(sexe)) END AS sexe_norm
FROM stg_patients_raw"""),
    "normalize_age": W("""
SELECT patient_id, TRY_CAST(age AS DOUBLE) AS age FROM stg_patients_raw
WHERE TRY_CAST(age AS DOUBLE) BETWEEN 0 AND 120 OR TRY_CAST(age AS DOUBLE) IS NULL"""),
    "normalize_dates": W(f"""
SELECT patient_id, date_naissance, strftime({TO_DATE.format(x='date_naissance')}, '%Y-%m-%d') AS date_naissance_iso
FROM stg_patients_raw"""),
    "normalize_postcode": W("""
SELECT hopital_id, code_postal,
       CASE WHEN length(trim(code_postal)) >= 5 THEN substr(trim(code_postal), 1, 5)
            ELSE lpad(trim(code_postal), 5, '0') END AS code_postal_norm
FROM stg_hospitals"""),
    "quality_audit": W("SELECT table_name, metric, CAST(value AS BIGINT) AS value FROM quality_audit"),
    "quality_score": W("""
WITH t AS (
  SELECT count(DISTINCT table_name) AS tables_ok,
         CAST(COALESCE(sum(CASE WHEN metric = 'total' THEN value END), 0) AS BIGINT) AS total_lignes,
         CAST(COALESCE(sum(CASE WHEN metric = 'doublons' THEN value END), 0) AS BIGINT) AS total_doublons,
         CAST(COALESCE(sum(CASE WHEN metric LIKE 'nulls\\_%' ESCAPE '\\' THEN value END), 0) AS BIGINT) AS total_nulls
  FROM quality_audit),
s AS (
  SELECT *, CAST(CASE WHEN total_lignes > 0 THEN
              100 - least(20, CAST(round_even(total_doublons / CAST(greatest(total_lignes, 1) AS DOUBLE) * 100, 0) AS INTEGER))
                  - least(30, CAST(round_even(total_nulls / CAST(greatest(total_lignes, 1) AS DOUBLE) * 100, 0) AS INTEGER))
             ELSE 100 END AS INTEGER) AS score
  FROM t)
SELECT score, CASE WHEN score >= 90 THEN 'EXCELLENT' WHEN score >= 70 THEN 'BON' WHEN score >= 50 THEN 'MOYEN'
                   ELSE 'FAIBLE' END AS niveau,
       score >= 50 AS passe, tables_ok, total_lignes, total_doublons, total_nulls
FROM s"""),
    "validate_rules": W("""
SELECT 'stg_patients' AS table_name, rule, CAST(violations AS BIGINT) AS violations FROM (
  UNPIVOT (SELECT CAST(COALESCE(sum(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS patient_id_null,
                  CAST(COALESCE(sum(CASE WHEN sexe NOT IN ('M', 'F', 'm', 'f') THEN 1 ELSE 0 END), 0) AS BIGINT)
                    AS sexe_hors_domaine,
                  CAST(COALESCE(sum(CASE WHEN TRY_CAST(age AS DOUBLE) < 0 OR TRY_CAST(age AS DOUBLE) > 120
                                         THEN 1 ELSE 0 END), 0) AS BIGINT) AS age_hors_plage
           FROM stg_patients_raw)
  ON patient_id_null, sexe_hors_domaine, age_hors_plage INTO NAME rule VALUE violations)
UNION ALL
SELECT 'stg_admissions', rule, CAST(violations AS BIGINT) FROM (
  UNPIVOT (SELECT CAST(COALESCE(sum(CASE WHEN admission_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS admission_id_null,
                  CAST(COALESCE(sum(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS patient_id_null,
                  CAST(0 AS BIGINT) AS date_admission_invalide,
                  CAST(COALESCE(sum(CASE WHEN date_sortie < date_admission THEN 1 ELSE 0 END), 0) AS BIGINT)
                    AS sortie_avant_admission
           FROM stg_admissions_raw)
  ON admission_id_null, patient_id_null, date_admission_invalide, sortie_avant_admission
  INTO NAME rule VALUE violations)"""),
    "orphan_check": W("""
SELECT count(*) AS orphelins FROM fact_admissions f
WHERE NOT EXISTS (SELECT 1 FROM dim_patient p WHERE p.patient_id = f.patient_id)"""),
    "value_counts": W("SELECT tranche_age, count(*) AS n FROM dim_patient GROUP BY tranche_age"),
    "filter_blank_keys": W("""
SELECT patient_id, nom FROM stg_patients_raw WHERE patient_id IS NOT NULL AND patient_id <> ''"""),
    "prescription_cost": W("""
SELECT prescription_id, quantite, prix_unitaire, round(quantite * prix_unitaire, 2) AS cout FROM fact_prescriptions"""),
    "typed_projection": W(f"""
SELECT TRY_CAST(patient_id AS BIGINT) AS patient_id, nom, TRY_CAST(age AS INTEGER) AS age, sexe,
       {TO_DATE.format(x='date_naissance')} AS date_naissance
FROM stg_patients_raw"""),
    "age_band_warehouse": W(f"""
SELECT patient_id, age,
       CASE WHEN {INT_AGE} IS NULL THEN '31-50' WHEN {INT_AGE} < 18 THEN '0-17' WHEN {INT_AGE} < 31 THEN '18-30'
            WHEN {INT_AGE} < 51 THEN '31-50' WHEN {INT_AGE} < 66 THEN '51-65' ELSE '65+' END AS tranche_age
FROM stg_patients_raw"""),
    "age_band_staging": W("""
SELECT patient_id, age,
       CASE WHEN v > 0 AND v <= 14 THEN '0-14' WHEN v > 14 AND v <= 29 THEN '15-29' WHEN v > 29 AND v <= 44 THEN '30-44'
            WHEN v > 44 AND v <= 59 THEN '45-59' WHEN v > 59 AND v <= 74 THEN '60-74'
            WHEN v > 74 AND v <= 89 THEN '75-89' WHEN v > 89 AND v <= 120 THEN '90+' END AS tranche_age
FROM (SELECT *, TRY_CAST(age AS DOUBLE) AS v FROM stg_patients_raw)"""),
    "stay_class": W("""
SELECT admission_id, duree_sejour,
       CASE WHEN duree_sejour <= 3 THEN 'Courte (<= 3j)' WHEN duree_sejour <= 7 THEN 'Moyenne (4-7j)'
            WHEN duree_sejour > 7 THEN 'Longue (> 7j)' ELSE 'Inconnue' END AS categorie_dms
FROM fact_admissions"""),
    "occupancy_level": W("""
SELECT capteur_id, taux_occupation,
       CASE WHEN taux_occupation < 60 THEN 'Faible' WHEN taux_occupation < 85 THEN 'Normal'
            WHEN taux_occupation >= 85 THEN 'Critique' ELSE 'Inconnu' END AS niveau_occupation
FROM fact_bed_occupancy"""),
    "flag_labels": W("""
SELECT l.labo_id,
       CASE WHEN l.est_anormal = 1 THEN 'Anormal' WHEN l.est_anormal = 0 THEN 'Normal' END AS statut_resultat,
       CASE WHEN t.est_weekend = 1 THEN 'Weekend' WHEN t.est_weekend = 0 THEN 'Semaine' END AS type_jour
FROM fact_lab l JOIN dim_date t ON l.temps_id = t.temps_id"""),
    "disease_chronic_label": W("""
SELECT maladie_id, CASE WHEN est_chronique = 1 THEN 'Oui' WHEN est_chronique = 0 THEN 'Non' END AS chronique
FROM dim_disease"""),
    "analytics_mart": W("""
SELECT f.admission_id, f.patient_id, p.nom, p.prenom, p.sexe, p.age, p.tranche_age, p.ville,
       f.hopital_id, h.nom AS nom_hopital, h.type AS type_hopital, h.capacite_lits, h.ville AS ville_hopital,
       r.nom_region, r.population AS pop_region,
       f.maladie_id, m.nom_maladie, m.categorie AS categorie_maladie, m.code_cim10, m.est_chronique,
       f.temps_id, t."date", t.annee, t.trimestre, t.mois, t.nom_mois, t.semaine, t.est_weekend,
       f.duree_sejour, f.cout_hospitalisation, f.mode_admission, f.mode_sortie, f.service
FROM fact_admissions f
LEFT JOIN dim_patient p ON f.patient_id = p.patient_id
LEFT JOIN dim_hospital h ON f.hopital_id = h.hopital_id
LEFT JOIN dim_region r ON h.region_id = r.region_id
LEFT JOIN dim_disease m ON f.maladie_id = m.maladie_id
LEFT JOIN dim_date t ON f.temps_id = t.temps_id"""),
    "stay_duration": W("SELECT admission_id, duree_sejour FROM fact_admissions"),
    "date_key_lookup": W("SELECT admission_id, date_admission, temps_id FROM fact_admissions"),
    "readmission_flag": W("SELECT admission_id, patient_id, date_admission, est_readmission FROM fact_admissions_readmit"),
}

SQL["audit_by_load"] = W("SELECT table_name, metric, CAST(value AS BIGINT) AS value FROM quality_audit "
                         "WHERE table_name = 'stg_admissions'")
