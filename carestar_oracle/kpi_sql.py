"""Oracle SQL for the warehouse tables and the KPI library."""

from .warehouse_sql import with_warehouse as W

Y2000 = "date_admission >= DATE '2000-01-01' AND date_admission < DATE '2001-01-01'"
M200012 = "date_admission >= DATE '2000-12-01' AND date_admission < DATE '2001-01-01'"

SQL = {
    "dim_region": W("SELECT * FROM dim_region"),
    "dim_hospital": W("SELECT * FROM dim_hospital"),
    "dim_service": W("SELECT * FROM dim_service"),
    "dim_disease": W("SELECT * FROM dim_disease"),
    "dim_patient": W("SELECT * FROM dim_patient"),
    "fact_admissions": W("SELECT * FROM fact_admissions_readmit"),
    "fact_emergency": W("SELECT * FROM fact_emergency"),
    "fact_lab": W("SELECT * FROM fact_lab"),
    "fact_prescriptions": W("SELECT * FROM fact_prescriptions"),
    "fact_bed_occupancy": W("SELECT * FROM fact_bed_occupancy"),
    "fact_pharmacy_stock": W("SELECT * FROM fact_pharmacy_stock"),
    "kpi_bed_occupancy": W(f"""
SELECT h.hopital_id, h.nom AS hopital, h.capacite_lits, count(f.admission_id) AS admissions_actives,
       round(CAST(count(f.admission_id) AS DOUBLE) * 100 / NULLIF(h.capacite_lits, 0), 2) AS taux_occupation_pct
FROM fact_admissions f JOIN dim_hospital h ON f.hopital_id = h.hopital_id
WHERE {M200012}
GROUP BY h.hopital_id, h.nom, h.capacite_lits"""),
    "kpi_length_of_stay": W(f"""
SELECT s.service_id, s.nom_service, round(avg(f.duree_sejour), 1) AS dms_jours, min(f.duree_sejour) AS min_jours,
       max(f.duree_sejour) AS max_jours, count(*) AS nb_sejours
FROM fact_admissions f JOIN dim_service s ON f.service_id = s.service_id
WHERE {Y2000}
GROUP BY s.service_id, s.nom_service"""),
    "kpi_daily_admissions": W("""
SELECT t."date", t.jour_semaine, count(*) AS nb_admissions, CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences,
       count(*) - CAST(sum(f.est_urgence) AS BIGINT) AS nb_programmees
FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id
WHERE f.date_admission BETWEEN DATE '2000-12-01' AND DATE '2000-12-31'
GROUP BY t."date", t.jour_semaine"""),
    "kpi_top_diseases": W(f"""
WITH g AS (
  SELECT m.maladie_id, m.nom_maladie, m.categorie, m.code_cim10, m.gravite, count(*) AS nb_cas
  FROM fact_admissions f JOIN dim_disease m ON f.maladie_id = m.maladie_id
  WHERE {Y2000}
  GROUP BY m.maladie_id, m.nom_maladie, m.categorie, m.code_cim10, m.gravite)
SELECT *, round(CAST(nb_cas AS DOUBLE) * 100 / (SELECT sum(nb_cas) FROM g), 2) AS pct_total
FROM g ORDER BY nb_cas DESC, maladie_id ASC LIMIT 10"""),
    "kpi_cases_by_region": W(f"""
SELECT r.region_id, r.nom_region, r.population, count(*) AS nb_admissions,
       round(CAST(count(*) AS DOUBLE) * 100000 / NULLIF(r.population, 0), 1) AS taux_pour_100k,
       round(avg(f.duree_sejour), 1) AS dms_moy
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
JOIN dim_region r ON p.region_id = r.region_id
WHERE {Y2000}
GROUP BY r.region_id, r.nom_region, r.population"""),
    "kpi_age_split": W("""
WITH g AS (
  SELECT p.tranche_age, count(*) AS nb_admissions, CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences,
         round(avg(f.duree_sejour), 1) AS dms_moy
  FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
  GROUP BY p.tranche_age)
SELECT *, round(CAST(nb_admissions AS DOUBLE) * 100 / (SELECT sum(nb_admissions) FROM g), 2) AS pct_total FROM g"""),
    "kpi_readmission_rate": W("""
SELECT s.service_id, s.nom_service, count(*) AS total_admissions,
       CAST(sum(f.est_readmission) AS BIGINT) AS nb_readmissions,
       round(CAST(sum(f.est_readmission) AS DOUBLE) * 100 / count(*), 2) AS taux_readmission_pct
FROM fact_admissions_readmit f JOIN dim_service s ON f.service_id = s.service_id
GROUP BY s.service_id, s.nom_service"""),
    "kpi_emergency_wait": W("""
SELECT t.nom_mois AS mois, t.mois AS mois_num, t.annee, h.hopital_id, h.nom AS hopital,
       round(avg(u.temps_attente_minutes), 0) AS attente_moy_min, min(u.temps_attente_minutes) AS attente_min,
       max(u.temps_attente_minutes) AS attente_max, count(u.urgence_id) AS nb_passages,
       CAST(sum(u.est_hospitalise) AS BIGINT) AS nb_hospitalises
FROM fact_emergency u JOIN dim_date t ON u.temps_id = t.temps_id
JOIN dim_hospital h ON u.hopital_id = h.hopital_id
GROUP BY t.annee, t.mois, t.nom_mois, h.hopital_id, h.nom"""),
    "kpi_abnormal_labs": W("""
SELECT l.type_test, count(*) AS total_tests, CAST(sum(l.est_anormal) AS BIGINT) AS nb_anormaux,
       round(CAST(sum(l.est_anormal) AS DOUBLE) * 100 / count(*), 2) AS taux_anomalie_pct
FROM fact_lab l JOIN dim_date t ON l.temps_id = t.temps_id
WHERE t.annee = 2024
GROUP BY l.type_test"""),
    "kpi_urgent_vs_planned": W("""
SELECT t.annee, t.mois, t.nom_mois, CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences, count(*) AS total,
       count(*) - CAST(sum(f.est_urgence) AS BIGINT) AS nb_programmees,
       round(CAST(sum(f.est_urgence) AS DOUBLE) * 100 / count(*), 2) AS pct_urgences
FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.mois, t.nom_mois"""),
    "kpi_admissions_by_service": W(f"""
SELECT s.service_id, s.nom_service, s.specialite, s.nb_lits, count(*) AS nb_admissions,
       round(avg(f.duree_sejour), 1) AS dms, CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences
FROM fact_admissions f JOIN dim_service s ON f.service_id = s.service_id
WHERE {Y2000}
GROUP BY s.service_id, s.nom_service, s.specialite, s.nb_lits"""),
    "kpi_monthly_trend": W("""
SELECT t.annee, t.mois, t.nom_mois, count(*) AS nb_admissions, CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences,
       round(avg(f.duree_sejour), 1) AS dms_moy
FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.mois, t.nom_mois ORDER BY t.annee, t.mois"""),
    "kpi_sex_split": W("""
WITH g AS (
  SELECT p.sexe, count(*) AS nb_admissions, round(avg(f.duree_sejour), 1) AS dms_moy,
         CAST(sum(f.est_urgence) AS BIGINT) AS nb_urgences
  FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
  GROUP BY p.sexe)
SELECT *, round(CAST(nb_admissions AS DOUBLE) * 100 / (SELECT sum(nb_admissions) FROM g), 2) AS pct FROM g"""),
    "kpi_top_drugs": W("""
SELECT medicament, count(*) AS nb_prescriptions, round(avg(duree_jours), 1) AS duree_moy_jours,
       CAST(sum(est_chronique) AS BIGINT) AS nb_chroniques
FROM fact_prescriptions GROUP BY medicament
ORDER BY nb_prescriptions DESC, medicament ASC LIMIT 15"""),
    "kpi_incidence": W(f"""
SELECT r.region_id, r.nom_region, m.maladie_id, m.nom_maladie, m.categorie, r.population, count(*) AS nb_cas,
       round(CAST(count(*) AS DOUBLE) * 100000 / NULLIF(r.population, 0), 2) AS taux_incidence_100k
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
JOIN dim_region r ON p.region_id = r.region_id
JOIN dim_disease m ON f.maladie_id = m.maladie_id
WHERE {Y2000}
GROUP BY r.region_id, r.nom_region, m.maladie_id, m.nom_maladie, m.categorie, r.population"""),
    "kpi_cache": W("""
SELECT 'taux_occupation_moyen' AS kpi,
       COALESCE(CAST(round(avg(CAST(lits_occupes AS DOUBLE) / NULLIF(lits_total, 0) * 100), 1) AS VARCHAR), 'N/A')
         AS valeur, '2000-12-31T00:00:00' AS date_calcul
FROM fact_bed_occupancy
UNION ALL SELECT 'dms_moyen', COALESCE(CAST(round(avg(CASE WHEN duree_sejour > 0 THEN duree_sejour END), 1) AS VARCHAR), 'N/A'),
       '2000-12-31T00:00:00' FROM fact_admissions
UNION ALL SELECT 'nb_admissions_total', CAST(count(*) AS VARCHAR), '2000-12-31T00:00:00' FROM fact_admissions
UNION ALL SELECT 'nb_patients_distincts', CAST(count(DISTINCT patient_id) AS VARCHAR), '2000-12-31T00:00:00'
  FROM fact_admissions
UNION ALL SELECT 'cout_moyen_sejour', COALESCE(CAST(round(avg(cout_hospitalisation), 2) AS VARCHAR), 'N/A'),
       '2000-12-31T00:00:00' FROM fact_admissions
UNION ALL SELECT 'nb_maladies_distinctes', CAST(count(DISTINCT maladie_id) AS VARCHAR), '2000-12-31T00:00:00'
  FROM fact_admissions
UNION ALL SELECT 'nb_hopitaux_actifs', CAST(count(DISTINCT hopital_id) AS VARCHAR), '2000-12-31T00:00:00'
  FROM fact_admissions
UNION ALL SELECT 'pct_mode_urgence',
       COALESCE(CAST(round(100.0 * sum(CASE WHEN mode_admission = 'Urgence' THEN 1 ELSE 0 END)
                           / NULLIF(CAST(count(*) AS DOUBLE), 0), 1) AS VARCHAR), 'N/A'),
       '2000-12-31T00:00:00' FROM fact_admissions"""),
    "kpi_cache_top5": W("""
SELECT 'top_maladie_' || CAST(row_number() OVER (ORDER BY nb DESC, nom_maladie ASC) AS VARCHAR) AS kpi,
       nom_maladie || ' (' || CAST(nb AS VARCHAR) || ' cas)' AS valeur, '2000-12-31T00:00:00' AS date_calcul
FROM (SELECT m.nom_maladie, count(*) AS nb FROM fact_admissions f JOIN dim_disease m ON f.maladie_id = m.maladie_id
      GROUP BY m.nom_maladie ORDER BY nb DESC, m.nom_maladie ASC LIMIT 5)"""),
}

# Every fact's rows by what their date is to a calendar of 1995 to 2000
_DATED = [("fact_admissions", "date_admission", "stg_admissions", 0),
          ("fact_emergency", "date_admission", "stg_admissions WHERE urgence = 1", 0),
          ("fact_lab", "CAST(ts AS DATE)", "events", 0),
          ("fact_prescriptions", "CAST(loaded_at AS DATE)", "stg_admissions a JOIN part p ON a.maladie_id = p.p_partkey", 0),
          ("fact_bed_occupancy", "CAST(ts AS DATE)", "events", 1),
          ("fact_pharmacy_stock", "d", "(SELECT DISTINCT l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN part "
                                       "ON l_partkey = p_partkey)", 1)]
_MOTIFS = {"non": "BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'", "date_absente": "IS NULL",
           "avant_calendrier": "< DATE '1995-01-01'", "apres_calendrier": "> DATE '2000-12-31'"}
SQL["calendar_rejects"] = W("SELECT *, CASE WHEN conserve = 1 OR motif = 'non' THEN 0 ELSE n_lignes END AS n_apart FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{m}' AS motif, count(*) FILTER ({d} {cond}) AS n_lignes, "
    f"CAST({1 if keep or m == 'non' else 0} AS INTEGER) AS conserve FROM {rows}"
    for t, d, rows, keep in _DATED for m, cond in _MOTIFS.items()) + ")")
