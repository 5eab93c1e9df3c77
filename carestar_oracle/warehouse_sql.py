"""The bound warehouse as DuckDB CTEs over the driver's tables.

Independent re-statement of ``carestar.sources.binding`` + dims + facts in
plain SQL, used only to check the Spark results.  DuckDB inlines CTEs, so
unused ones cost nothing.
"""

CAL_START = "DATE '1995-01-01'"
CAL_END = "DATE '2024-12-31'"

WEEKDAYS = "['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche']"
MONTHS = ("['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre',"
          "'Novembre','Décembre']")

STAY = ("COALESCE(CASE WHEN date_sortie IS NOT NULL AND date_admission IS NOT NULL "
        "THEN CAST(GREATEST(1, date_diff('day', date_admission, date_sortie)) AS INTEGER) END, "
        "CAST(1 + ('0x' || substr(md5(CAST(admission_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS INTEGER))")

CTES = {
    "stg_admissions_raw": """
  SELECT l.l_orderkey * 10 + l.l_linenumber AS admission_id,
         o.o_custkey AS patient_id,
         CAST(o.o_orderdate AS DATE) AS date_admission,
         CASE WHEN l.l_shipdate >= o.o_orderdate THEN CAST(l.l_shipdate AS DATE) END AS date_sortie,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgence,
         l.l_suppkey AS hopital_id, l.l_linenumber AS service_id, l.l_partkey AS maladie_id,
         'Service-' || CAST(l.l_linenumber AS VARCHAR) AS service,
         CAST(l.l_quantity * 4 AS INTEGER) AS temps_attente_minutes,
         1 + l.l_linenumber % 5 AS niveau_urgence,
         CASE l.l_returnflag WHEN 'A' THEN 'Hospitalisé' WHEN 'R' THEN 'Renvoyé' WHEN 'N' THEN 'Transféré'
              ELSE 'DAMA' END AS disposition,
         CAST(30 + l.l_partkey % 91 AS INTEGER) AS duree_traitement_minutes,
         l.l_shipdate AS loaded_at, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "stg_admissions": """
  SELECT * FROM stg_admissions_raw
  QUALIFY row_number() OVER (PARTITION BY admission_id ORDER BY loaded_at DESC NULLS LAST,
      maladie_id DESC NULLS LAST, hopital_id DESC NULLS LAST, l_quantity DESC NULLS LAST,
      l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
      l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
    "dim_date": f"""
  SELECT CAST(date_diff('day', {CAL_START}, d) AS INTEGER) + 1 AS temps_id, d AS "date",
         CAST(day(d) AS INTEGER) AS jour, CAST(month(d) AS INTEGER) AS mois, CAST(year(d) AS INTEGER) AS annee,
         CAST(quarter(d) AS INTEGER) AS trimestre, CAST(weekofyear(d) AS INTEGER) AS semaine,
         {WEEKDAYS}[isodow(d)] AS jour_semaine,
         CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS est_weekend,
         {MONTHS}[month(d)] AS nom_mois
  FROM (SELECT CAST(unnest(generate_series({CAL_START}, {CAL_END}, INTERVAL 1 DAY)) AS DATE) AS d)""",
    "dim_region": """
  SELECT n.n_nationkey AS region_id, n.n_name AS nom_region,
         CAST(COALESCE(p.population, 0) AS DOUBLE) AS population,
         CAST(NULL AS DOUBLE) AS superficie, r.r_name AS chef_lieu
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS population FROM customer GROUP BY c_nationkey) p
         ON n.n_nationkey = p.c_nationkey""",
    "dim_hospital": """
  SELECT s_suppkey AS hopital_id, s_name AS nom, 'Ville-' || CAST(s_nationkey AS VARCHAR) AS ville,
         s_nationkey AS region_id,
         CAST(COALESCE(CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 100 + (s_suppkey * 37) % 700 END, 200) AS DOUBLE)
           AS capacite_lits,
         ['CHU', 'CH', 'Clinique'][CAST(s_suppkey % 3 + 1 AS INTEGER)] AS type,
         CAST(COALESCE(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 10 + s_suppkey % 90 END, 50) AS DOUBLE)
           AS nb_medecins
  FROM supplier""",
    "dim_service": """
  SELECT n AS service_id, 'Service-' || CAST(n AS VARCHAR) AS nom_service,
         'Departement-' || CAST(n % 3 AS VARCHAR) AS departement, 'Specialite-' || CAST(n AS VARCHAR) AS specialite,
         CAST(20 + n * 5 AS DOUBLE) AS nb_lits
  FROM (SELECT DISTINCT l_linenumber AS n FROM lineitem)""",
    "dim_disease": """
  SELECT p_partkey AS maladie_id, p_name AS nom_maladie, p_brand AS code_cim10, p_type AS categorie,
         CAST(1 + p_size % 5 AS INTEGER) AS gravite, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS est_chronique
  FROM part""",
    "dim_patient": """
  SELECT c.c_custkey AS patient_id, c.c_name AS nom, 'Prenom-' || CAST(c.c_custkey % 100 AS VARCHAR) AS prenom,
         make_date(2000 - c.age, CAST(1 + c.c_custkey % 12 AS INTEGER), CAST(1 + c.c_custkey % 28 AS INTEGER))
           AS date_naissance,
         CAST(c.age AS DOUBLE) AS age,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sexe,
         CASE WHEN c.age IS NULL THEN '31-50' WHEN c.age < 18 THEN '0-17' WHEN c.age < 31 THEN '18-30'
              WHEN c.age < 51 THEN '31-50' WHEN c.age < 66 THEN '51-65' ELSE '65+' END AS tranche_age,
         COALESCE(rg.region_id, 0) AS region_id, c.c_mktsegment AS ville
  FROM (SELECT *, CAST(floor((c_acctbal + 1000.0) / 100.0) AS INTEGER) AS age FROM customer) c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT n_name AS region, n_nationkey AS region_id FROM nation) rg ON rg.region = n.n_name""",
    "fact_admissions": f"""
  SELECT a.admission_id, a.patient_id, t.temps_id, a.hopital_id, a.service_id, a.maladie_id, a.duree_sejour,
         a.urgence AS est_urgence,
         CASE WHEN a.urgence = 1 THEN 'Urgence' WHEN a.urgence = 0 THEN 'Programmée' END AS mode_admission,
         'Domicile' AS mode_sortie, a.service, 1 AS nb_lits_utilises,
         CAST(a.duree_sejour AS DOUBLE) * 500.0 AS cout_hospitalisation,
         CAST(a.duree_sejour AS DOUBLE) * 500.0 AS cout_sejour,
         a.date_admission
  FROM (SELECT *, {STAY} AS duree_sejour FROM stg_admissions) a
  JOIN dim_date t ON t."date" = a.date_admission""",
    "readmit_prev": """
  SELECT patient_id, date_admission,
         max(last_out) OVER (PARTITION BY patient_id ORDER BY date_admission
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_out
  FROM (SELECT patient_id, date_admission, max(date_admission + duree_sejour) AS last_out
        FROM fact_admissions GROUP BY patient_id, date_admission)""",
    "fact_admissions_readmit": """
  SELECT f.*, CASE WHEN date_diff('day', p.prev_out, f.date_admission) BETWEEN 0 AND 30 THEN 1 ELSE 0 END
           AS est_readmission
  FROM fact_admissions f LEFT JOIN readmit_prev p
    ON f.patient_id = p.patient_id AND f.date_admission = p.date_admission""",
    "fact_emergency": """
  SELECT 'URG-' || CAST(a.admission_id AS VARCHAR) AS urgence_id, a.patient_id, t.temps_id, a.hopital_id,
         a.temps_attente_minutes, CAST(a.niveau_urgence AS INTEGER) AS niveau_urgence, a.disposition,
         CASE WHEN a.disposition = 'Hospitalisé' THEN 1 ELSE 0 END AS est_hospitalise,
         a.temps_attente_minutes + a.duree_traitement_minutes AS duree_prise_en_charge
  FROM stg_admissions a JOIN dim_date t ON t."date" = a.date_admission
  WHERE a.urgence = 1""",
    "fact_lab": """
  SELECT e.event_id AS labo_id, e.user_id AS patient_id, t.temps_id, e.user_id % 100 AS hopital_id,
         e.event_type AS type_test,
         CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE e.value END AS resultat_numerique,
         'mg/L' AS unite,
         CASE WHEN e.value < 10 OR e.value > 100 THEN 1 ELSE 0 END AS est_anormal,
         CAST(10 AS DOUBLE) AS valeur_ref_min, CAST(100 AS DOUBLE) AS valeur_ref_max
  FROM events e JOIN dim_date t ON t."date" = CAST(e.ts AS DATE)""",
    "fact_prescriptions": """
  SELECT a.admission_id AS prescription_id, a.patient_id, t.temps_id, a.hopital_id, a.service_id,
         p.p_name AS medicament, p.p_brand AS dosage,
         COALESCE(CAST(trunc(a.l_quantity) AS INTEGER), 7) AS duree_jours,
         CASE WHEN a.l_returnflag = 'R' THEN 1 ELSE 0 END AS est_chronique,
         a.l_quantity AS quantite, p.p_retailprice AS prix_unitaire
  FROM stg_admissions a JOIN part p ON a.maladie_id = p.p_partkey
  JOIN dim_date t ON t."date" = CAST(a.loaded_at AS DATE)""",
    "fact_bed_occupancy": """
  SELECT e.event_id AS capteur_id, e.user_id % 100 AS hopital_id, CAST(1 + e.user_id % 7 AS INTEGER) AS service_id,
         t.temps_id, CAST(e.ts AS DATE) AS "date", CAST(hour(e.ts) AS INTEGER) AS heure,
         e.occ AS lits_occupes, 100 AS lits_total,
         round(CAST(e.occ AS DOUBLE) / CAST(100 AS DOUBLE) * 100, 1) AS taux_occupation,
         CASE WHEN e.occ >= 100 THEN 1 ELSE 0 END AS alertes
  FROM (SELECT *, CAST(least(100, CAST(round(value) AS INTEGER)) AS INTEGER) AS occ FROM events) e
  LEFT JOIN dim_date t ON t."date" = CAST(e.ts AS DATE)""",
    "fact_pharmacy_stock": """
  SELECT CAST(g.l_partkey AS VARCHAR) || '-' || strftime(g.d, '%Y%m%d') AS stock_id, t.temps_id, g.d AS "date",
         g.l_partkey AS code_medicament, p.p_name AS nom_medicament,
         CAST(p.p_size * 10 AS INTEGER) AS stock_disponible, CAST(trunc(g.conso) AS BIGINT) AS consommation_j,
         p.p_retailprice AS prix_unitaire,
         round(CAST(p.p_size * 10 AS DOUBLE) * p.p_retailprice, 2) AS valeur_stock,
         CASE WHEN p.p_size * 10 < 100 THEN 1 ELSE 0 END AS sous_seuil_alerte
  FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS conso FROM lineitem
        GROUP BY l_partkey, CAST(l_shipdate AS DATE)) g
  JOIN part p ON g.l_partkey = p.p_partkey
  LEFT JOIN dim_date t ON t."date" = g.d""",
}


def with_warehouse(body: str) -> str:
    """Prefix ``body`` with every warehouse CTE."""
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    stripped = body.lstrip()
    if stripped.startswith(","):
        return f"WITH {ctes}\n{stripped}"
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
