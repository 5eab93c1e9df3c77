"""Oracle SQL for sources, sinks and streaming round trips."""

from . import kpi_sql, quality_sql  # (the latter registers the staging CTEs used below)
from .warehouse_sql import STAY
from .warehouse_sql import with_warehouse as W

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
LOADED = "CAST(TIMESTAMP '2000-12-31 00:00:00' AS TIMESTAMP)"
Z1 = "'Z' || CAST(p.p_partkey % 90 AS VARCHAR) || ':Diag-' || CAST(p.p_partkey % 13 AS VARCHAR)"
Z2 = "'Y' || CAST(p.p_partkey % 70 AS VARCHAR) || ':Diag-' || CAST(p.p_partkey % 17 AS VARCHAR)"
COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)

SQL = {
    "ingest_csv": W(f"""
SELECT NULLIF(patient_id, '') AS patient_id, NULLIF(nom, '') AS nom, NULLIF(age, '') AS age, NULLIF(sexe, '') AS sexe,
       NULLIF(date_naissance, '') AS date_naissance, NULLIF(ville, '') AS ville,
       'patients.csv' AS source_file, {LOADED} AS loaded_at
FROM stg_patients_raw WHERE NULLIF(patient_id, '') IS NOT NULL"""),
    "ingest_json_envelope": W("""
SELECT capteur_id, hopital_id, service_id, "date", heure, lits_occupes, lits_total, taux_occupation, alertes
FROM fact_bed_occupancy"""),
    "ingest_xml_documents": W(f"""
SELECT CAST(a.admission_id AS VARCHAR) AS cr_id, CAST(a.admission_id AS VARCHAR) AS admission_id,
       CAST(a.patient_id AS VARCHAR) AS patient_id, strftime(a.date_admission, '%Y-%m-%d') AS date_admission,
       strftime(a.date_sortie, '%Y-%m-%d') AS date_sortie, CAST({STAY} AS VARCHAR) AS duree_sejour,
       p.p_brand AS code_cim10_principal, p.p_name AS diagnostic_principal,
       CASE a.service_id % 3 WHEN 0 THEN '' WHEN 1 THEN {Z1} ELSE {Z1} || '|' || {Z2} END AS diagnostics_secondaires,
       CAST(p.p_partkey % 4 AS INTEGER) AS nb_actes, 'Dr ' || CAST(a.hopital_id AS VARCHAR) AS medecin_responsable,
       CASE WHEN a.urgence = 1 THEN 'Urgences' ELSE 'Programmé' END AS mode_entree, 'Domicile' AS mode_sortie,
       CAST(a.hopital_id AS VARCHAR) AS hopital_id, 'Observation ' || CAST(a.admission_id AS VARCHAR) AS observations
FROM stg_admissions a JOIN part p ON a.maladie_id = p.p_partkey"""),
    "xml_explode_acts": W("""
SELECT CAST(a.admission_id AS VARCHAR) AS cr_id, 'ACT' || CAST((p.p_partkey + r.i) % 50 AS VARCHAR) AS code_acte,
       'Acte ' || CAST((p.p_partkey + r.i) % 50 AS VARCHAR) AS libelle_acte
FROM stg_admissions a JOIN part p ON a.maladie_id = p.p_partkey
JOIN (SELECT range AS i FROM range(3)) r ON r.i < p.p_partkey % 4"""),
    "staff_union": W(f"""
SELECT 'MED' || CAST(c_custkey AS VARCHAR) AS medecin_id, CAST(NULL AS VARCHAR) AS infirmier_id, c_name AS nom,
       'Prenom-' || CAST(c_custkey % 100 AS VARCHAR) AS prenom, CAST(1 + c_custkey % 7 AS VARCHAR) AS service_id,
       CAST(c_custkey % 100 AS VARCHAR) AS hopital_id, c_mktsegment AS specialite,
       CASE WHEN c_custkey % 4 = 0 THEN 'Senior' ELSE 'Junior' END AS grade, CAST(NULL AS VARCHAR) AS horaire,
       'Medecins' AS source_file, {LOADED} AS loaded_at, 'Médecin' AS type_personnel
FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT NULL, 'INF' || CAST(c_custkey AS VARCHAR), c_name, 'Prenom-' || CAST(c_custkey % 100 AS VARCHAR),
       CAST(1 + c_custkey % 7 AS VARCHAR), CAST(c_custkey % 100 AS VARCHAR), NULL,
       CASE WHEN c_custkey % 3 = 0 THEN 'IDE' ELSE 'AS' END, CASE WHEN c_custkey % 4 = 1 THEN 'Nuit' ELSE 'Jour' END,
       'Infirmiers', {LOADED}, 'Infirmier'
FROM customer WHERE c_custkey % 2 = 1"""),
    "shift_plan": W(f"""
SELECT CAST(o_orderkey AS VARCHAR) AS planning_id,
       CASE WHEN o_custkey % 2 = 0 THEN 'MED' ELSE 'INF' END || CAST(o_custkey AS VARCHAR) AS personnel_id,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS "date",
       CASE o_orderkey % 3 WHEN 0 THEN 'Nuit' WHEN 1 THEN 'Matin' ELSE 'Soir' END AS poste,
       CAST(1 + o_orderkey % 7 AS VARCHAR) AS service_id, 'Plannings' AS source_file, {LOADED} AS loaded_at
FROM orders"""),
    "ingest_regions_payload": W("""
, p AS (SELECT c_nationkey, count(*) AS population,
               round(CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 1) AS taux_mortalite
        FROM customer GROUP BY c_nationkey),
h AS (SELECT s_nationkey, count(*) AS nb_hopitaux,
             sum(CASE WHEN s_suppkey % 7 <> 0 THEN 10 + s_suppkey % 90 END) AS nb_medecins
      FROM supplier GROUP BY s_nationkey)
SELECT CAST(n_nationkey AS BIGINT) AS region_id, n_name AS nom_region, COALESCE(population, 0) AS population,
       CAST(COALESCE(nb_medecins, 0) AS BIGINT) AS nb_medecins, COALESCE(nb_hopitaux, 0) AS nb_hopitaux,
       taux_mortalite, 'mock_api' AS source_api
FROM nation LEFT JOIN p ON n_nationkey = c_nationkey LEFT JOIN h ON n_nationkey = s_nationkey"""),
    "incremental_extract": W("""
SELECT o_orderkey AS id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS date_admission,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS est_urgence,
       o_orderdate AS updated_at,
       CASE WHEN o_orderdate <= TIMESTAMP '1998-12-31 00:00:00' THEN 'initial' ELSE 'increment' END AS lot
FROM orders"""),
    "ingest_reference_payload": W("""
SELECT p_partkey AS maladie_id, p_name AS nom_maladie, p_brand AS code_cim10, p_type AS categorie,
       CAST(1 + p_size % 5 AS INTEGER) AS gravite,
       CASE WHEN p_size % 9 = 0 THEN 0 WHEN p_size > 25 THEN 1 ELSE 0 END AS est_chronique
FROM part"""),
    "source_fallback": W("""
SELECT CAST(region_id AS VARCHAR) AS region_id, nom_region, population, superficie, chef_lieu FROM dim_region"""),
    "table_counts": W(f"""
{COUNTS} UNION ALL SELECT 'stg_absente', CAST(NULL AS BIGINT)"""),
    "fact_admissions_from_csv": W("""
SELECT CAST(admission_id AS VARCHAR) AS admission_id, CAST(patient_id AS VARCHAR) AS patient_id, temps_id,
       CAST(hopital_id AS VARCHAR) AS hopital_id, CAST(service_id AS VARCHAR) AS service_id,
       CAST(maladie_id AS VARCHAR) AS maladie_id, duree_sejour, est_urgence, mode_admission, mode_sortie, service,
       nb_lits_utilises, cout_hospitalisation, cout_sejour, date_admission
FROM fact_admissions"""),
    "lookup_by_id": W("SELECT * FROM dim_disease WHERE maladie_id = 42"),
    "reload_by_source": W("""
SELECT CASE WHEN TRY_CAST(patient_id AS BIGINT) % 2 = 0 THEN 'patients_a.csv' ELSE 'patients_b.csv' END
         AS source_file, count(*) AS n
FROM stg_patients_raw GROUP BY 1"""),
    "run_log_latest": W(f"""
SELECT 'run-' || table_name AS run_id, 'ingestion' AS dag_name, 'extract_' || table_name AS task_name,
       TIMESTAMP '2000-12-31 06:05:00' AS event_time, 'SUCCESS' AS status, n_rows AS records,
       CAST(NULL AS VARCHAR) AS error, table_name AS source
FROM ({COUNTS})"""),
        "stream_incremental_ingest": W("""
SELECT admission_id, patient_id, date_admission, date_sortie, urgence, hopital_id, service_id, maladie_id, loaded_at
FROM stg_admissions"""),
    "stream_bed_occupancy": W("""
SELECT time_bucket(INTERVAL 4 HOUR, ts) AS window_start, time_bucket(INTERVAL 4 HOUR, ts) + INTERVAL 4 HOUR AS window_end,
       hopital_id, round(avg(taux_occupation), 2) AS taux_moy, max(taux_occupation) AS taux_max,
       CAST(sum(alertes) AS BIGINT) AS nb_alertes, count(*) AS nb_mesures
FROM (SELECT e.user_id % 100 AS hopital_id, e.ts, f.taux_occupation, f.alertes
      FROM events e JOIN fact_bed_occupancy f ON f.capteur_id = e.event_id)
GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL 4 HOUR, max(ts)) + INTERVAL 4 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""),
}

SQL["export_csv_roundtrip"] = quality_sql.SQL["analytics_mart"]

SQL["stream_upsert"] = W("""
, v AS (SELECT admission_id, patient_id, date_admission, date_sortie, urgence, hopital_id, service_id, maladie_id, loaded_at
        FROM stg_admissions_raw
        UNION ALL
        SELECT admission_id, patient_id, date_admission + 45, date_sortie, urgence, hopital_id, service_id, maladie_id,
               loaded_at + INTERVAL 30 DAY FROM stg_admissions_raw WHERE admission_id % 5 = 0)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY admission_id ORDER BY loaded_at DESC NULLS LAST,
   maladie_id DESC NULLS LAST, hopital_id DESC NULLS LAST, patient_id DESC NULLS LAST, date_admission DESC NULLS LAST,
   date_sortie DESC NULLS LAST, urgence DESC NULLS LAST, service_id DESC NULLS LAST) = 1""")

SQL["stream_late_readings"] = W("""
, r AS (SELECT e.event_id AS id, e.user_id % 100 AS hopital_id, e.ts, f.taux_occupation, f.alertes,
               time_bucket(INTERVAL 4 HOUR, e.ts) + INTERVAL 4 HOUR AS w_end,
               CAST(least(3, (day(e.ts) - 1) // 8) AS INTEGER) AS d
        FROM events e JOIN fact_bed_occupancy f ON f.capteur_id = e.event_id),
a AS (SELECT *, d + CASE WHEN id % 41 = 0 THEN 1 ELSE 0 END AS arrives FROM r
      UNION ALL SELECT *, d + 1 FROM r WHERE id % 53 = 0),
m AS (SELECT x.d, (SELECT max(ts) FROM a WHERE arrives < x.d) - INTERVAL 1 HOUR AS mark FROM (SELECT unnest(range(6)) AS d) x),
l AS (SELECT a.*, coalesce(a.w_end <= m.mark, false) AS is_late FROM a JOIN m ON m.d = a.arrives),
k AS (SELECT DISTINCT id, hopital_id, w_end, taux_occupation, alertes FROM l WHERE NOT is_late)
SELECT w_end - INTERVAL 4 HOUR AS window_start, w_end AS window_end, hopital_id, round(avg(taux_occupation), 2) AS taux_moy,
       max(taux_occupation) AS taux_max, CAST(sum(alertes) AS BIGINT) AS nb_alertes, count(*) AS nb_mesures,
       CASE WHEN w_end <= (SELECT mark FROM m WHERE d = 5) THEN 'filigrane' ELSE 'fin' END AS cloture
FROM k GROUP BY w_end, hopital_id
UNION ALL
SELECT NULL, NULL, hopital_id, NULL, NULL, NULL, count(*), 'tardif' FROM l WHERE is_late GROUP BY hopital_id""")

SQL["incremental_ties"] = W("""
SELECT o_orderkey AS id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS date_admission,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS est_urgence, o_orderdate AS updated_at,
       CASE WHEN o_orderdate <= TIMESTAMP '1998-12-31 00:00:00'
             AND NOT (o_orderkey % 3 = 0 AND o_orderdate >= TIMESTAMP '1998-12-11 00:00:00') THEN 'initial' ELSE 'increment' END AS lot
FROM orders""")

SQL["ingest_epidemics_payload"] = W("""
SELECT 'EPI-' || e.event_type || '-' || CAST(e.r AS VARCHAR) AS epidemie_id, e.event_type AS maladie, n_name AS region,
       e.n AS nb_cas, e.d1 AS date_debut, CASE WHEN e.n % 4 IN (1, 3) THEN e.d2 END AS date_fin,
       CASE e.n % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'Contrôlée' WHEN 2 THEN 'Alerte' ELSE 'Terminée' END AS statut,
       'mock_api' AS source_api
FROM (SELECT event_type, user_id % 25 AS r, count(*) AS n, CAST(min(ts) AS DATE) AS d1, CAST(max(ts) AS DATE) AS d2
      FROM events GROUP BY 1, 2) e JOIN nation ON n_nationkey % 25 = e.r""")

SQL["ingest_stock_json"] = W(f"""
SELECT stock_id, "date", code_medicament, nom_medicament, stock_disponible, consommation_j, prix_unitaire, valeur_stock,
       sous_seuil_alerte, 'stock_pharmacie.json' AS source_file, {LOADED} AS loaded_at
FROM fact_pharmacy_stock""")

# K5: what each exported table holds
_EXPORTED = {
    "dim_patient": "dim_patient", "dim_hopital": "dim_hospital", "dim_maladie": "dim_disease", "dim_region": "dim_region",
    "dim_temps": "dim_date", "dim_service": "dim_service", "fact_admissions": "fact_admissions_readmit",
    "fact_urgences": "fact_emergency", "fact_laboratoires": "fact_lab", "fact_prescriptions": "fact_prescriptions",
    "fact_occupation_lits": "fact_bed_occupancy", "fact_stock_pharmacie": "fact_pharmacy_stock",
    "analytics_mart": f"({quality_sql.SQL['analytics_mart']})",
    "kpi_cache": f"({kpi_sql.SQL['kpi_cache']} UNION ALL SELECT * FROM ({kpi_sql.SQL['kpi_cache_top5']}))",
}
_counts = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {rows} x" for name, rows in _EXPORTED.items())
SQL["export_manifest"] = W(f"""
, c AS ({_counts})
SELECT table_name, n_rows, 'carestar' AS project, '2000-12-31T00:00:00' AS exported_at,
       CAST((SELECT count(*) FROM c) AS BIGINT) AS nb_tables, CAST((SELECT sum(n_rows) FROM c) AS BIGINT) AS total_lignes
FROM c WHERE n_rows > 0""")
