"""Binding: the driver's TPC-H-like tables -> hospital staging tables.

Each staging frame is a projection of the driver tables, so every downstream
query reads the real tables and its work grows with them.

Mapping (fixed, documented in SURVEY §7.3):
* admissions  = lineitem ⋈ orders: admission = order line, patient = customer,
  hospital = supplier, service = line number, disease = part, urgent = priority
  1-URGENT/2-HIGH, discharge = ship date when not before the order date.
* patients    = customer (+ nation name as region), hospitals = supplier,
  regions = nation ⋈ region with population = customers per nation,
  services = distinct line numbers, diseases = part.
* labs and bed sensors = events; prescriptions = lineitem ⋈ orders ⋈ part;
  pharmacy stock = lineitem per (part, ship day) ⋈ part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import cached_frame, local_signature
from ..operators.facts import sensor_measures, stock_measures
from ..operators.quality import dedup

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# FIXED VALUES of the binding
URGENT_PRIORITIES = ["1-URGENT", "2-HIGH"]
RETURNFLAG_DISPOSITION = [("A", "Hospitalisé"), ("R", "Renvoyé"), ("N", "Transféré")]
HOSPITAL_TYPES = ["CHU", "CH", "Clinique"]
LAB_REF_MIN, LAB_REF_MAX = 10.0, 100.0
SENSOR_BEDS = 100
STOCK_THRESHOLD = 100


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Local inputs are read once per session and content
    signature (size, modification time); remote inputs are read every time."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    sig = local_signature(path)
    if sig is None:
        return spark.read.parquet(path)
    return cached_frame(spark, ("input", path, sig), lambda: spark.read.parquet(path))


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer splits than the cluster's
    parallelism (e.g. a single-row-group file): round-robin repartition to the
    default parallelism.  On real inputs (thousands of splits) this is a no-op.
    Round-robin is made deterministic for task retries by Spark's local sort
    before repartitioning."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


# Dedup order for admissions: latest load first, then every remaining source
# column so that the order is total.
ADMISSION_DEDUP_ORDER = ["loaded_at", "maladie_id", "hopital_id", "l_quantity", "l_extendedprice",
                         "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def stg_admissions(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """Raw admissions (duplicates included, as landed): source columns only;
    values derived from them are added after dedup by :func:`admission_details`,
    so the dedup moves the narrowest possible rows."""
    li = spread(read(spark, sf_dir, "lineitem"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("date_admission"),
        F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate").cast("date")).alias("date_sortie"),
        F.when(F.col("o_orderpriority").isin(*URGENT_PRIORITIES), 1).otherwise(0).alias("urgence"),
        F.col("l_suppkey").alias("hopital_id"),
        F.col("l_linenumber").alias("service_id"),
        F.col("l_partkey").alias("maladie_id"),
        F.col("l_shipdate").alias("loaded_at"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        *(["l_orderkey"] if with_order else []),
    )


def ids_name_orders(spark: SparkSession, sf_dir: str) -> bool:
    """Whether all line numbers have one digit, so that an admission id tells its order: one pass over that column."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    digit = F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))
    found = lambda: read(spark, sf_dir, "lineitem").agg(F.bool_and(digit)).first()[0] is not False
    sig = local_signature(path)
    return found() if sig is None else cached_frame(spark, ("digits", path, sig), found)


def one_per_admission(spark: SparkSession, sf_dir: str, keep: str = "last") -> DataFrame:
    """One version of each admission.  Where ids tell orders, rows are grouped by order and id: the
    join has already dealt them by order, so that the dedup needs no shuffle of its own."""
    if not ids_name_orders(spark, sf_dir):
        return dedup(stg_admissions(spark, sf_dir), ["admission_id"], ADMISSION_DEDUP_ORDER, keep)
    raw = stg_admissions(spark, sf_dir, with_order=True)
    return dedup(raw, ["l_orderkey", "admission_id"], ADMISSION_DEDUP_ORDER, keep).drop("l_orderkey")


def admission_details(adm: DataFrame) -> DataFrame:
    """Columns of the landed admission file that follow from its source columns:
    service name and the emergency feed (wait, triage level, disposition,
    treatment minutes)."""
    disposition = None
    for code, label in RETURNFLAG_DISPOSITION:
        c = F.col("l_returnflag") == code
        disposition = F.when(c, label) if disposition is None else disposition.when(c, label)
    return adm.select(
        *adm.columns[:adm.columns.index("loaded_at")],
        F.concat(F.lit("Service-"), F.col("service_id").cast("string")).alias("service"),
        (F.col("l_quantity") * 4).cast("int").alias("temps_attente_minutes"),
        (F.lit(1) + F.col("service_id") % 5).alias("niveau_urgence"),
        disposition.otherwise(K.DISPOSITIONS[3]).alias("disposition"),
        (F.lit(30) + F.col("maladie_id") % 91).cast("int").alias("duree_traitement_minutes"),
        *adm.columns[adm.columns.index("loaded_at"):],
    )


def patient_age(custkey_acctbal: str = "c_acctbal"):
    return F.floor((F.col(custkey_acctbal) + 1000.0) / 100.0).cast("int")


def stg_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean patient source (feeds the patient dimension)."""
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    age = patient_age()
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").alias("patient_id"),
        F.col("c_name").alias("nom"),
        F.concat(F.lit("Prenom-"), (F.col("c_custkey") % 100).cast("string")).alias("prenom"),
        F.date_format(F.make_date(F.lit(2000) - age, F.lit(1) + F.col("c_custkey") % 12,
                                  F.lit(1) + F.col("c_custkey") % 28), "yyyy-MM-dd").alias("date_naissance"),
        age.cast("string").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("sexe"),
        F.col("n_name").alias("region"),
        F.col("c_mktsegment").alias("ville"),
    )


def stg_patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty landed patient file (all text): bad ages, sex spellings, dates."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    age = patient_age()
    return c.select(
        F.when(k % 53 == 0, None).otherwise(k.cast("string")).alias("patient_id"),
        F.when(k % 19 == 0, None).otherwise(F.col("c_name")).alias("nom"),
        F.when(k % 11 == 0, "-5").when(k % 11 == 1, "130").when(k % 11 == 2, "abc")
         .when(k % 11 == 3, None).otherwise(age.cast("string")).alias("age"),
        F.when(k % 7 == 0, " homme ").when(k % 7 == 1, "FE").when(k % 7 == 2, None)
         .when(k % 7 == 3, "female").when(k % 7 == 4, "x")
         .otherwise(F.when(k % 2 == 0, "M").otherwise("F")).alias("sexe"),
        F.when(k % 13 == 0, "2024-02-30").when(k % 13 == 1, "").when(k % 13 == 2, "1980-05-06T08:00:00")
         .otherwise(F.date_format(F.make_date(F.lit(2000) - age, F.lit(1) + k % 12, F.lit(1) + k % 28),
                                  "yyyy-MM-dd")).alias("date_naissance"),
        F.col("c_mktsegment").alias("ville"),
    )


def stg_hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    htype = F.element_at(F.array(*[F.lit(t) for t in HOSPITAL_TYPES]), (k % 3 + 1).cast("int"))
    return s.select(
        k.alias("hopital_id"),
        F.col("s_name").alias("nom"),
        F.concat(F.lit("Ville-"), F.col("s_nationkey").cast("string")).alias("ville"),
        F.col("s_nationkey").alias("region_id"),
        F.when(k % 10 == 0, None).otherwise(F.lit(100) + (k * 37) % 700).alias("capacite_lits"),
        htype.alias("type"),
        F.when(k % 7 == 0, None).otherwise(F.lit(10) + k % 90).alias("nb_medecins"),
        F.when(k % 4 == 0, (F.lit(1000) + k).cast("string"))
         .when(k % 4 == 1, F.concat(F.lit(" "), (F.lit(75000) + k % 100).cast("string"), F.lit(" ")))
         .when(k % 4 == 2, (F.lit(750000) + k).cast("string")).alias("code_postal"),
    )


def stg_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    pop = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    j = (n.join(r, n["n_regionkey"] == r["r_regionkey"], "left")
         .join(pop, n["n_nationkey"] == pop["c_nationkey"], "left"))
    return j.select(F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("nom_region"),
                    F.coalesce(F.col("population"), F.lit(0)).alias("population"),
                    F.col("r_name").alias("chef_lieu"))


def stg_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("n")).distinct()
    return n.select(F.col("n").alias("service_id"),
                    F.concat(F.lit("Service-"), F.col("n").cast("string")).alias("nom_service"),
                    F.concat(F.lit("Departement-"), (F.col("n") % 3).cast("string")).alias("departement"),
                    F.concat(F.lit("Specialite-"), F.col("n").cast("string")).alias("specialite"),
                    (F.lit(20) + F.col("n") * 5).alias("nb_lits"))


def stg_diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("maladie_id"), F.col("p_name").alias("nom"),
                    F.col("p_brand").alias("code_cim10"), F.col("p_type").alias("categorie"),
                    (F.lit(1) + F.col("p_size") % 5).alias("gravite"),
                    F.when(F.col("p_size") > 25, 1).otherwise(0).alias("est_chronique"))


def stg_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    v = F.col("value")
    return e.select(
        F.col("event_id").alias("labo_id"),
        F.col("user_id").alias("patient_id"),
        F.col("event_type").alias("type_test"),
        F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(v.cast("string")).alias("resultat"),
        F.lit("mg/L").alias("unite"),
        F.lit(str(LAB_REF_MIN)).alias("valeur_ref_min"),
        F.lit(str(LAB_REF_MAX)).alias("valeur_ref_max"),
        F.when((v < LAB_REF_MIN) | (v > LAB_REF_MAX), "1").otherwise("0").alias("est_anormal"),
        F.col("ts").cast("string").alias("date_test"),
        (F.col("user_id") % 100).alias("hopital_id"),
    )


def stg_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    raw = e.select(
        F.col("event_id").alias("capteur_id"),
        (F.col("user_id") % 100).alias("hopital_id"),
        (F.lit(1) + F.col("user_id") % 7).cast("int").alias("service_id"),
        F.col("ts").alias("ts"),
        F.col("ts").cast("date").alias("date"),
        F.hour("ts").alias("heure"),
        F.lit(SENSOR_BEDS).alias("lits_total"),
        F.least(F.lit(SENSOR_BEDS), F.round(F.col("value")).cast("int")).alias("lits_occupes"),
    )
    return sensor_measures(raw)


def stg_prescriptions(spark: SparkSession, sf_dir: str, admissions: DataFrame | None = None) -> DataFrame:
    adm = admissions if admissions is not None else stg_admissions(spark, sf_dir)
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    j = adm.join(p, adm["maladie_id"] == p["p_partkey"], "inner")
    return j.select(
        F.col("admission_id").alias("prescription_id"), "patient_id", "hopital_id", "service_id",
        F.col("p_name").alias("medicament"), F.col("p_brand").alias("dosage"),
        F.col("l_quantity").cast("int").alias("duree_jours"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("est_chronique"),
        F.col("l_quantity").alias("quantite"), F.col("p_retailprice").alias("prix_unitaire"),
        F.col("loaded_at").cast("string").alias("date_prescription"),
    )


def stg_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(read(spark, sf_dir, "lineitem"))
    g = (li.groupBy("l_partkey", F.col("l_shipdate").cast("date").alias("date"))
         .agg(F.sum("l_quantity").alias("conso")))
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    j = g.join(p, g["l_partkey"] == p["p_partkey"], "inner")
    raw = j.select(
        F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.date_format("date", "yyyyMMdd")).alias("stock_id"),
        "date",
        F.col("l_partkey").alias("code_medicament"),
        F.col("p_name").alias("nom_medicament"),
        (F.col("p_size") * 10).alias("stock_disponible"),
        F.col("conso").cast("bigint").alias("consommation_j"),
        F.col("p_retailprice").alias("prix_unitaire"),
    )
    return stock_measures(raw, STOCK_THRESHOLD)
