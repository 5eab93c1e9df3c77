"""Oracle SQL for the report aggregates."""

from .warehouse_sql import with_warehouse as W

HOSP_REGION = """(SELECT h.hopital_id, h.nom AS nom_hopital, h.region_id, r.nom_region
   FROM dim_hospital h LEFT JOIN dim_region r ON h.region_id = r.region_id)"""

SQL = {
    "report_diseases": W("""
SELECT m.nom_maladie, m.categorie, count(*) AS admissions, round(avg(f.duree_sejour), 1) AS dms_moy
FROM fact_admissions f JOIN dim_disease m ON f.maladie_id = m.maladie_id
GROUP BY m.nom_maladie, m.categorie
ORDER BY admissions DESC, m.nom_maladie ASC NULLS FIRST, m.categorie ASC NULLS FIRST LIMIT 10"""),
    "report_hospitals": W(f"""
SELECT hr.nom_hopital, hr.nom_region, count(*) AS admissions, round(avg(f.duree_sejour), 1) AS dms_moy,
       round(avg(f.cout_hospitalisation), 0) AS cout_moy
FROM fact_admissions f JOIN {HOSP_REGION} hr ON f.hopital_id = hr.hopital_id
GROUP BY hr.nom_hopital, hr.nom_region
ORDER BY admissions DESC, hr.nom_hopital ASC NULLS FIRST, hr.nom_region ASC NULLS FIRST LIMIT 8"""),
    "report_regions": W("""
SELECT r.nom_region, count(*) AS admissions, count(DISTINCT f.patient_id) AS patients_uniques,
       round(avg(f.cout_hospitalisation), 0) AS cout_moy
FROM fact_admissions f JOIN dim_hospital h ON f.hopital_id = h.hopital_id
JOIN dim_region r ON h.region_id = r.region_id
GROUP BY r.nom_region"""),
    "report_monthly": W("""
SELECT t.annee, t.mois, t.nom_mois, count(*) AS admissions, round(avg(f.duree_sejour), 1) AS dms_moy,
       round(sum(f.cout_hospitalisation), 0) AS ca_total
FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.mois, t.nom_mois ORDER BY t.annee DESC, t.mois DESC LIMIT 12"""),
    "report_sex": W("""
SELECT p.sexe, count(*) AS admissions, round(avg(p.age), 1) AS age_moyen, round(avg(f.duree_sejour), 1) AS dms_moy
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id GROUP BY p.sexe"""),
    "report_occupancy": W("""
SELECT h.nom AS hopital, round(avg(o.taux_occupation), 1) AS taux_moy, max(o.taux_occupation) AS pic_max,
       CAST(sum(o.alertes) AS BIGINT) AS nb_alertes
FROM fact_bed_occupancy o JOIN dim_hospital h ON o.hopital_id = h.hopital_id
GROUP BY h.nom ORDER BY taux_moy DESC, hopital ASC NULLS FIRST LIMIT 8"""),
    "cases_by_category": W("""
SELECT m.categorie, count(*) AS nb_cas FROM fact_admissions f JOIN dim_disease m ON f.maladie_id = m.maladie_id
GROUP BY m.categorie"""),
    "top_occupancy_hospitals": W("""
SELECT hopital_id, round(avg(taux_occupation), 1) AS taux_moy, max(taux_occupation) AS taux_max
FROM fact_bed_occupancy GROUP BY hopital_id ORDER BY taux_moy DESC, hopital_id ASC NULLS FIRST LIMIT 5"""),
    "occupancy_by_hour": W("""
SELECT heure, round(avg(taux_occupation), 2) AS taux_moy, count(*) AS nb_mesures FROM fact_bed_occupancy
GROUP BY heure"""),
    "occupancy_by_service": W("""
SELECT service_id, round(avg(taux_occupation), 2) AS taux_moy, count(*) AS nb_mesures FROM fact_bed_occupancy
GROUP BY service_id"""),
    "matrix_disease_region": W("""
SELECT m.nom_maladie, r.nom_region, count(*) AS n
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
JOIN dim_region r ON p.region_id = r.region_id JOIN dim_disease m ON f.maladie_id = m.maladie_id
GROUP BY m.nom_maladie, r.nom_region"""),
    "pivot_disease_age_band": W("""
SELECT m.categorie,
       count(*) FILTER (p.tranche_age = '0-17') AS "0-17", count(*) FILTER (p.tranche_age = '18-30') AS "18-30",
       count(*) FILTER (p.tranche_age = '31-50') AS "31-50", count(*) FILTER (p.tranche_age = '51-65') AS "51-65",
       count(*) FILTER (p.tranche_age = '65+') AS "65+",
       count(*) FILTER (p.tranche_age IS NULL OR p.tranche_age NOT IN ('0-17', '18-30', '31-50', '51-65', '65+')) AS autres,
       count(*) AS total
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
JOIN dim_disease m ON f.maladie_id = m.maladie_id GROUP BY m.categorie"""),
    "category_trend": W("""
SELECT t.annee, t.mois, m.categorie, count(*) AS admissions
FROM fact_admissions f JOIN dim_disease m ON f.maladie_id = m.maladie_id JOIN dim_date t ON f.temps_id = t.temps_id
GROUP BY t.annee, t.mois, m.categorie"""),
    "top_cities": W("""
SELECT p.ville, count(DISTINCT f.patient_id) AS patients
FROM fact_admissions f JOIN dim_patient p ON f.patient_id = p.patient_id
GROUP BY p.ville ORDER BY patients DESC, p.ville ASC NULLS FIRST LIMIT 10"""),
    "top_hospital": W("""
SELECT h.hopital_id, h.nom, count(*) AS admissions
FROM fact_admissions f JOIN dim_hospital h ON f.hopital_id = h.hopital_id
GROUP BY h.hopital_id, h.nom ORDER BY admissions DESC, h.hopital_id ASC LIMIT 1"""),
    "top_consumed_drugs": W("""
SELECT code_medicament, nom_medicament, CAST(sum(consommation_j) AS BIGINT) AS consommation_totale
FROM fact_pharmacy_stock GROUP BY code_medicament, nom_medicament
ORDER BY consommation_totale DESC, code_medicament ASC LIMIT 10"""),
    "stock_alert_trend": W("""
SELECT "date", CAST(sum(sous_seuil_alerte) AS BIGINT) AS nb_sous_seuil, count(*) AS nb_lignes
FROM fact_pharmacy_stock GROUP BY "date\""""),
    "abnormal_by_month": W("""
SELECT t.annee, t.mois, CAST(sum(l.est_anormal) AS BIGINT) AS nb_anormaux, count(*) AS nb_analyses
FROM fact_lab l JOIN dim_date t ON l.temps_id = t.temps_id GROUP BY t.annee, t.mois"""),
    "national_stats": W("""
SELECT (SELECT sum(population) FROM dim_region) AS population_totale,
       (SELECT count(*) FROM dim_hospital) AS nb_hopitaux,
       (SELECT sum(nb_medecins) FROM dim_hospital) AS nb_medecins,
       (SELECT sum(capacite_lits) FROM dim_hospital) AS capacite_totale,
       (SELECT count(*) FROM dim_region) AS nb_regions,
       (SELECT round(avg(t), 2) FROM (SELECT round(CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 1) AS t
                                      FROM customer GROUP BY c_nationkey)) AS taux_mortalite_moyen,
       (SELECT count(*) FROM (SELECT count(*) AS n FROM events JOIN nation ON n_nationkey % 25 = user_id % 25
                              GROUP BY event_type, n_nationkey) WHERE n % 4 IN (0, 2)) AS epidemies_actives"""),
    "hospital_scorecard": W("""
SELECT COALESCE(a.hopital_id, o.hopital_id) AS hopital_id, a.admissions, a.dms_moy, a.cout_moy, o.taux_occupation_moy
FROM (SELECT hopital_id, count(*) AS admissions, round(avg(duree_sejour), 2) AS dms_moy,
             round(avg(cout_hospitalisation), 2) AS cout_moy FROM fact_admissions GROUP BY hopital_id) a
FULL OUTER JOIN (SELECT hopital_id, round(avg(taux_occupation), 2) AS taux_occupation_moy
                 FROM fact_bed_occupancy GROUP BY hopital_id) o ON a.hopital_id = o.hopital_id"""),
    "occupancy_level_mix": W("""
SELECT CASE WHEN taux_occupation < 60 THEN 'Faible' WHEN taux_occupation < 85 THEN 'Normal'
            WHEN taux_occupation >= 85 THEN 'Critique' ELSE 'Inconnu' END AS niveau_occupation,
       count(*) AS nb_mesures
FROM fact_bed_occupancy GROUP BY 1"""),
}
