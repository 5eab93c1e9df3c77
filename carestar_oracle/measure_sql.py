"""Oracle SQL for the measure layer (conditional aggregation + drill-across)."""

from .warehouse_sql import with_warehouse as W


def div(a: str, b: str) -> str:
    """DAX DIVIDE(a, b, 0) in SQL."""
    return f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN 0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def cnt(cond: str = "TRUE") -> str:
    return f"NULLIF(count(CASE WHEN {cond} THEN 1 END), 0)"


FA_Y = "(SELECT f.*, t.annee FROM fact_admissions f LEFT JOIN dim_date t ON f.temps_id = t.temps_id)"
FA_REGION = """(SELECT f.*, p.age, r.nom_region FROM fact_admissions f
   LEFT JOIN dim_patient p ON f.patient_id = p.patient_id LEFT JOIN dim_region r ON p.region_id = r.region_id)"""
DMS = "CASE WHEN duree_sejour > 0 THEN duree_sejour END"

SQL = {
    "measures_admissions": W(f"""
SELECT annee, {cnt()} AS total_admissions, NULLIF(count(DISTINCT patient_id), 0) AS patients_distincts,
       round(avg({DMS}), 4) AS dms_moyen, round(avg(cout_hospitalisation), 4) AS cout_moyen_sejour,
       round(sum(cout_hospitalisation), 4) AS cout_total,
       round({div(cnt("mode_admission = 'Urgence'"), cnt())} * 100, 4) AS pct_admissions_urgences,
       {cnt("mode_admission = 'Programmée'")} AS admissions_programmees
FROM {FA_Y} GROUP BY annee"""),
    "measure_readmission": W(f"""
, f AS {FA_Y},
p AS (SELECT annee, patient_id, count(*) AS n FROM f GROUP BY annee, patient_id),
a AS (SELECT annee, {cnt("n >= 2")} AS multi FROM p GROUP BY annee),
b AS (SELECT annee, NULLIF(count(DISTINCT patient_id), 0) AS pd FROM f GROUP BY annee)
SELECT COALESCE(a.annee, b.annee) AS annee, round({div("multi", "pd")} * 100, 4) AS taux_readmission
FROM a FULL JOIN b ON a.annee IS NOT DISTINCT FROM b.annee"""),
    "measures_patients": W(f"""
, a AS (SELECT nom_region, round(avg(age), 4) AS age_moyen_patients,
               NULLIF(count(DISTINCT patient_id), 0) AS patients_distincts
        FROM {FA_REGION} GROUP BY nom_region),
b AS (SELECT r.nom_region, NULLIF(count(DISTINCT CASE WHEN p.sexe = 'M' THEN p.patient_id END), 0) AS patients_hommes,
             NULLIF(count(DISTINCT CASE WHEN p.sexe = 'F' THEN p.patient_id END), 0) AS patientes_femmes
      FROM dim_patient p LEFT JOIN dim_region r ON p.region_id = r.region_id GROUP BY r.nom_region)
SELECT COALESCE(a.nom_region, b.nom_region) AS nom_region, age_moyen_patients, patients_hommes, patientes_femmes,
       round({div("patientes_femmes", "patients_distincts")} * 100, 4) AS pct_femmes
FROM a FULL JOIN b ON a.nom_region IS NOT DISTINCT FROM b.nom_region"""),
    "measures_capacity": W(f"""
, a AS (SELECT h.type, NULLIF(count(DISTINCT f.hopital_id), 0) AS hopitaux_actifs, {cnt()} AS total_admissions
        FROM fact_admissions f LEFT JOIN dim_hospital h ON f.hopital_id = h.hopital_id GROUP BY h.type),
c AS (SELECT type, sum(cap) AS capacite_totale_lits
      FROM (SELECT type, hopital_id, max(capacite_lits) AS cap FROM dim_hospital GROUP BY type, hopital_id)
      GROUP BY type),
o AS (SELECT h.type, round(avg(o.taux_occupation), 4) AS taux_occupation_moyen,
             round(max(o.taux_occupation), 4) AS pic_occupation, CAST(sum(o.alertes) AS BIGINT) AS alertes_capacite
      FROM fact_bed_occupancy o LEFT JOIN dim_hospital h ON o.hopital_id = h.hopital_id GROUP BY h.type),
ac AS (SELECT COALESCE(a.type, c.type) AS type, hopitaux_actifs, total_admissions, capacite_totale_lits
       FROM a FULL JOIN c ON a.type IS NOT DISTINCT FROM c.type)
SELECT COALESCE(ac.type, o.type) AS type, hopitaux_actifs, round(capacite_totale_lits, 4) AS capacite_totale_lits,
       taux_occupation_moyen, pic_occupation, alertes_capacite,
       round({div("total_admissions", "capacite_totale_lits")}, 4) AS ratio_charge
FROM ac FULL JOIN o ON ac.type IS NOT DISTINCT FROM o.type"""),
    "measures_disease": W(f"""
SELECT categorie, NULLIF(count(DISTINCT maladie_id), 0) AS pathologies_distinctes,
       {cnt("est_chronique = 1")} AS maladies_chroniques,
       round({div(cnt("est_chronique = 1"), cnt())} * 100, 4) AS pct_maladies_chroniques,
       round(avg(CASE WHEN est_chronique = 1 AND duree_sejour > 0 THEN duree_sejour END), 4) AS dms_chroniques,
       round(avg(CASE WHEN est_chronique = 0 AND duree_sejour > 0 THEN duree_sejour END), 4) AS dms_aigues
FROM (SELECT f.*, m.categorie, m.est_chronique FROM fact_admissions f
      LEFT JOIN dim_disease m ON f.maladie_id = m.maladie_id)
GROUP BY categorie"""),
    "measures_lab": W(f"""
, l AS (SELECT {cnt()} AS n, {cnt("est_anormal = 1")} AS ab FROM fact_lab),
a AS (SELECT {cnt()} AS adm FROM fact_admissions)
SELECT l.n AS total_analyses, round({div("l.n", "a.adm")}, 4) AS analyses_par_admission,
       round({div("l.ab", "l.n")} * 100, 4) AS taux_anomalies
FROM l, a"""),
    "measures_rx": W(f"""
, p AS (SELECT t.annee, {cnt()} AS total_prescriptions,
               CAST(sum(CAST(f.quantite * f.prix_unitaire AS DECIMAL(18, 2))) AS DOUBLE) AS cout
        FROM fact_prescriptions f LEFT JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY t.annee),
a AS (SELECT annee, {cnt()} AS adm FROM {FA_Y} GROUP BY annee)
SELECT COALESCE(p.annee, a.annee) AS annee, total_prescriptions,
       round({div("total_prescriptions", "adm")}, 4) AS prescriptions_par_admission,
       round(cout, 4) AS cout_medicaments_total
FROM p FULL JOIN a ON p.annee IS NOT DISTINCT FROM a.annee"""),
    "measures_stock": W(f"""
SELECT t.annee, round(CAST(sum(CAST(s.valeur_stock AS DECIMAL(18, 2))) AS DOUBLE), 4) AS valeur_stock_total,
       {cnt("s.sous_seuil_alerte = 1")} AS ruptures_stock,
       round({div(cnt("s.sous_seuil_alerte = 1"), cnt())} * 100, 4) AS pct_alerte_stock
FROM fact_pharmacy_stock s LEFT JOIN dim_date t ON s.temps_id = t.temps_id GROUP BY t.annee"""),
    "measures_weekend": W(f"""
SELECT t.annee, {cnt("t.est_weekend = 0")} AS admissions_semaine, {cnt("t.est_weekend = 1")} AS admissions_weekend
FROM fact_admissions f LEFT JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY t.annee"""),
    "measures_month_over_month": W(f"""
, m AS (SELECT make_date(t.annee, t.mois, 1) AS mois_debut, count(*) AS total_admissions
        FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY 1),
p AS (SELECT CAST(mois_debut + INTERVAL 1 MONTH AS DATE) AS mois_debut, total_admissions AS prev FROM m),
j AS (SELECT COALESCE(m.mois_debut, p.mois_debut) AS d, m.total_admissions, p.prev
      FROM m FULL JOIN p ON m.mois_debut = p.mois_debut)
SELECT CAST(year(d) AS INTEGER) AS annee, CAST(month(d) AS INTEGER) AS mois, total_admissions,
       prev AS admissions_periode_precedente,
       COALESCE(total_admissions, 0) - COALESCE(prev, 0) AS delta_admissions,
       round({div("COALESCE(total_admissions, 0) - COALESCE(prev, 0)", "prev")} * 100, 4) AS pct_croissance_admissions
FROM j"""),
    "measures_by_slicer": W(f"""
SELECT nom_region, {cnt("mode_admission = 'Urgence'")} AS total_admissions,
       {cnt("mode_admission = 'Programmée'")} AS admissions_programmees,
       round({div(cnt("mode_admission = 'Urgence'"), cnt("mode_admission = 'Urgence'"))} * 100, 4)
         AS pct_admissions_urgences,
       round(avg(CASE WHEN mode_admission = 'Urgence' AND duree_sejour > 0 THEN duree_sejour END), 4) AS dms_moyen,
       round(avg(CASE WHEN mode_admission = 'Urgence' AND est_chronique = 1 AND duree_sejour > 0
                      THEN duree_sejour END), 4) AS dms_chroniques
FROM (SELECT f.*, t.annee, r.nom_region, m.est_chronique FROM fact_admissions f
      LEFT JOIN dim_date t ON f.temps_id = t.temps_id
      LEFT JOIN dim_patient p ON f.patient_id = p.patient_id
      LEFT JOIN dim_region r ON p.region_id = r.region_id
      LEFT JOIN dim_disease m ON f.maladie_id = m.maladie_id)
WHERE annee = 2000
GROUP BY nom_region"""),
    "measures_by_axis": W(f"""
, a AS (SELECT nom_region, {cnt()} AS total_admissions, sum(cout_hospitalisation) AS cout_total
        FROM {FA_REGION} GROUP BY nom_region),
b AS (SELECT nom_region, sum(population) AS population FROM dim_region GROUP BY nom_region)
SELECT COALESCE(a.nom_region, b.nom_region) AS nom_region, total_admissions, round(cout_total, 4) AS cout_total,
       round(population, 4) AS population, round({div("total_admissions", "population")} * 100000, 4) AS taux_100k
FROM a FULL JOIN b ON a.nom_region IS NOT DISTINCT FROM b.nom_region"""),
}

URGENT = f"round({div(cnt("mode_admission = 'Urgence'"), cnt())} * 100, 4) AS pct_admissions_urgences"
STAY_MEAN = f"round(avg({DMS}), 4) AS dms_moyen"
BY_DATE = "fact_admissions f LEFT JOIN dim_date t ON f.temps_id = t.temps_id"
BY_PATIENT = "fact_admissions f LEFT JOIN dim_patient p ON f.patient_id = p.patient_id"
BY_DISEASE = "fact_admissions f LEFT JOIN dim_disease m ON f.maladie_id = m.maladie_id"
for _name, _axes, _figure, _rows in [
    ("measures_by_month", "t.annee, t.mois", URGENT, BY_DATE),
    ("measures_by_hospital", "f.hopital_id", STAY_MEAN, "fact_admissions f"),
    ("measures_by_sex", "p.sexe", STAY_MEAN, BY_PATIENT),
    ("measures_by_age_band", "p.tranche_age", URGENT, BY_PATIENT),
    ("measures_by_category", "m.categorie", STAY_MEAN, BY_DISEASE),
    ("measures_by_chronic", "m.est_chronique", STAY_MEAN, BY_DISEASE),
]:
    SQL[_name] = W(f"SELECT {_axes}, {cnt()} AS total_admissions, {_figure} FROM {_rows} GROUP BY {_axes}")
SQL["measures_by_test_type"] = W(f"""
SELECT type_test, {cnt()} AS total_analyses, round({div(cnt("est_anormal = 1"), cnt())} * 100, 4) AS taux_anomalies
FROM fact_lab GROUP BY type_test""")
SQL["measures_yearly_patients"] = W("""
, m AS (SELECT t.annee, t.mois, count(DISTINCT f.patient_id) AS n
        FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY t.annee, t.mois),
y AS (SELECT t.annee, count(DISTINCT f.patient_id) AS patients_distincts
      FROM fact_admissions f JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY t.annee)
SELECT y.annee, y.patients_distincts, CAST(sum(m.n) AS BIGINT) AS patients_mois_cumules
FROM y JOIN m ON y.annee = m.annee GROUP BY y.annee, y.patients_distincts""")
SQL["measures_distinct"] = W("""
SELECT t.annee, count(DISTINCT f.patient_id) AS patients_distincts, count(DISTINCT f.maladie_id) AS pathologies_distinctes,
       count(DISTINCT f.hopital_id) AS hopitaux_actifs
FROM fact_admissions f LEFT JOIN dim_date t ON f.temps_id = t.temps_id GROUP BY t.annee""")
