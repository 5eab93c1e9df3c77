"""Fact tables.

Every fact resolves its date through the calendar (``temps_id``).  The calendar
has one row per day of a fixed range, so it is the one join side broadcast
unconditionally.  Rows whose date falls outside the calendar are dropped
(inner join) for admissions, emergencies, labs and prescriptions, and kept with
a NULL key (left join) for sensor and stock rows, as the reference does.  With
``bounds`` (first and last day of the calendar) no row is dropped: a column
``rejet`` tells why a date has no day, and ``rejects.write_split`` separates and
counts the rows while it writes them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import admission_mode, date_key, flag, int_or, to_date, to_number
from .joins import join_dim
from .quality import dedup
from .rejects import ACCEPTED, REASON, reason

Bounds = tuple[dt.date, dt.date]


def _cal(calendar: DataFrame) -> DataFrame:
    return calendar.select("temps_id", F.col("date").alias("date_key"))


def as_date(df: DataFrame, col: str) -> Column:
    """The cheapest expression giving ``col`` as a date: the column itself for
    DATE, a cast for timestamps, the ISO-prefix parser only for text."""
    t = df.schema[col].dataType
    if isinstance(t, T.DateType):
        return F.col(col)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col).cast("date")
    return date_key(col)


def _with_date_key(df: DataFrame, calendar: DataFrame, source_col: str, how: str,
                   calendar_rows: int | None, bounds: Bounds | None = None) -> DataFrame:
    keyed = df.withColumn("date_key", as_date(df, source_col))
    if bounds is None:
        return join_dim(keyed, _cal(calendar), on="date_key", how=how, bounded_rows=calendar_rows)
    return (join_dim(keyed, _cal(calendar), on="date_key", how="left", bounded_rows=calendar_rows)
            .withColumn(REASON, reason(F.col("date_key"), bounds)))


def _reason_of(df: DataFrame) -> list[str]:
    return [REASON] if REASON in df.columns else []


def hash_stay(admission_id) -> Column:
    """Reproducible stand-in for a random stay of 1..10 days: 1 + (first 32 bits
    of md5(id)) mod 10."""
    h = F.conv(F.substring(F.md5(F.col(admission_id).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (F.lit(1) + h % 10).cast("int")


def stay_days(date_admission, date_sortie, admission_id: str, impute: str | None = "hash") -> Column:
    """``max(1, discharge − admission)`` in days; missing/invalid dates -> imputed
    (``impute="hash"``) or NULL (``impute=None``).  Column names are parsed as
    text dates; pass Columns that are already dates to skip the parsing."""
    adm = to_date(date_admission) if isinstance(date_admission, str) else date_admission
    out = to_date(date_sortie) if isinstance(date_sortie, str) else date_sortie
    diff = F.datediff(out, adm)
    # greatest() skips NULLs, so guard it: a missing date must stay missing here
    days = F.when(diff.isNotNull(), F.greatest(F.lit(1), diff))
    if impute == "hash":
        return F.coalesce(days, hash_stay(admission_id)).cast("int")
    return days.cast("int")


def fact_admissions(adm: DataFrame, calendar: DataFrame, discharges: DataFrame | None = None,
                    daily_rate: float = K.DAILY_RATE, impute: str | None = "hash",
                    unique: bool = False, calendar_rows: int | None = None,
                    bounds: Bounds | None = None, attributes: bool = True) -> DataFrame:
    """Admissions fact.

    ``adm``: admission_id, patient_id, date_admission, urgence, hopital_id,
    service_id, maladie_id, service, [date_sortie].  ``discharges`` (optional):
    admission_id, date_sortie — left-joined after a keep-first dedup.  ``unique``
    declares ``adm`` already one row per admission (skips the dedup shuffle).
    Without ``attributes``, ``admission_attributes`` is left to the caller (after its shuffles).
    """
    df = adm
    if discharges is not None:
        d = dedup(discharges.select("admission_id", "date_sortie"), ["admission_id"], keep="first")
        df = (df.drop("date_sortie") if "date_sortie" in df.columns else df).join(d, "admission_id", "left")
    elif "date_sortie" not in df.columns:
        df = df.withColumn("date_sortie", F.lit(None).cast("date"))
    if "service" not in df.columns:
        df = df.withColumn("service", F.lit(None).cast("string"))
    df = df.withColumn("duree_sejour", stay_days(as_date(df, "date_admission"), as_date(df, "date_sortie"),
                                                 "admission_id", impute))
    df = _with_date_key(df, calendar, "date_admission", "inner", calendar_rows, bounds)
    out = df.select(
        "admission_id", "patient_id", "temps_id", "hopital_id", "service_id", "maladie_id",
        "duree_sejour", int_or("urgence", 0).alias("est_urgence"), "service",
        F.col("date_key").alias("date_admission"), *_reason_of(df))
    out = out if unique else dedup(out, ["admission_id"], keep="first")
    return admission_attributes(out, daily_rate) if attributes else out


def admission_attributes(fact: DataFrame, daily_rate: float = K.DAILY_RATE) -> DataFrame:
    """Add the columns of the admissions fact that follow from its others."""
    cost = F.col("duree_sejour").cast("double") * F.lit(float(daily_rate))
    first = ["admission_id", "patient_id", "temps_id", "hopital_id", "service_id", "maladie_id", "duree_sejour", "est_urgence"]
    return fact.select(
        *first,
        admission_mode(F.col("est_urgence")).alias("mode_admission"),
        F.lit(K.DISCHARGE_MODE).alias("mode_sortie"),
        "service",
        F.lit(1).alias("nb_lits_utilises"),
        cost.alias("cout_hospitalisation"),
        cost.alias("cout_sejour"),
        *[c for c in fact.columns if c not in first and c != "service"],
    )


def with_readmission(fact: DataFrame, window_days: int = K.READMISSION_DAYS) -> DataFrame:
    """Add ``est_readmission``: 1 when the latest discharge among the patient's
    admissions on earlier days falls 0..``window_days`` days before this admission.

    Skew-safe shape: (1) one row per (patient, day) with that day's latest
    discharge — a partial-aggregated group-by; (2) a running max over those
    day rows per patient — a patient has at most one row per calendar day, so
    even the hottest patient's window is bounded by the calendar length;
    (3) join back on (patient, day), where AQE splits skewed partitions.
    """
    # a rejected admission is no earlier stay of anybody
    valid = fact.filter(F.col(REASON) == ACCEPTED) if REASON in fact.columns else fact
    day = (valid.groupBy("patient_id", "date_admission")
           .agg(F.max(F.date_add("date_admission", F.col("duree_sejour"))).alias("last_out")))
    w = Window.partitionBy("patient_id").orderBy("date_admission").rowsBetween(Window.unboundedPreceding, -1)
    prev = day.select("patient_id", "date_admission", F.max("last_out").over(w).alias("prev_out"))
    gap = F.datediff(F.col("date_admission"), F.col("prev_out"))
    # only the days that are readmissions travel to the join
    prev = prev.filter(gap.between(0, window_days))
    return (fact.join(prev, ["patient_id", "date_admission"], "left")
            .withColumn("est_readmission", flag(F.col("prev_out").isNotNull()))
            .drop("prev_out"))


def fact_emergency(adm: DataFrame, calendar: DataFrame, calendar_rows: int | None = None, bounds: Bounds | None = None) -> DataFrame:
    """Emergency visits: the urgent subset of admissions (``urgence`` = 1 as text
    or number, read as for the admissions).  Wait, triage level, disposition and treatment minutes are
    source columns (NULL when absent)."""
    df = adm.filter(int_or("urgence", 0) == 1)
    for c, t in (("temps_attente_minutes", "int"), ("niveau_urgence", "int"), ("disposition", "string"),
                 ("duree_traitement_minutes", "int")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    df = _with_date_key(df, calendar, "date_admission", "inner", calendar_rows, bounds)
    wait = F.col("temps_attente_minutes").cast("int")
    return df.select(
        F.concat(F.lit("URG-"), F.col("admission_id").cast("string")).alias("urgence_id"),
        "patient_id", "temps_id", "hopital_id",
        wait.alias("temps_attente_minutes"),
        F.col("niveau_urgence").cast("int").alias("niveau_urgence"),
        "disposition",
        flag(F.col("disposition") == K.DISPOSITION_ADMITTED).alias("est_hospitalise"),
        (wait + F.col("duree_traitement_minutes").cast("int")).alias("duree_prise_en_charge"),
        *_reason_of(df),
    )


def fact_lab(labs: DataFrame, calendar: DataFrame, calendar_rows: int | None = None, bounds: Bounds | None = None) -> DataFrame:
    df = _with_date_key(labs, calendar, "date_test", "inner", calendar_rows, bounds)
    return df.select(
        "labo_id", "patient_id", "temps_id", "hopital_id", "type_test",
        to_number("resultat").alias("resultat_numerique"),
        "unite",
        int_or("est_anormal", 0).alias("est_anormal"),
        to_number("valeur_ref_min").alias("valeur_ref_min"),
        to_number("valeur_ref_max").alias("valeur_ref_max"),
        *_reason_of(df),
    )


def fact_prescriptions(rx: DataFrame, calendar: DataFrame, calendar_rows: int | None = None, bounds: Bounds | None = None) -> DataFrame:
    df = ensure_rx_columns(rx)
    df = _with_date_key(df, calendar, "date_prescription", "inner", calendar_rows, bounds)
    return df.select(
        "prescription_id", "patient_id", "temps_id", "hopital_id", "service_id", "medicament", "dosage",
        int_or("duree_jours", K.DEFAULT_RX_DAYS).alias("duree_jours"),
        int_or("est_chronique", 0).alias("est_chronique"),
        to_number("quantite").alias("quantite"),
        to_number("prix_unitaire").alias("prix_unitaire"),
        *_reason_of(df),
    )


def ensure_rx_columns(rx: DataFrame) -> DataFrame:
    for c, t in (("dosage", "string"), ("quantite", "double"), ("prix_unitaire", "double"),
                 ("hopital_id", "string"), ("service_id", "string")):
        if c not in rx.columns:
            rx = rx.withColumn(c, F.lit(None).cast(t))
    return rx


def sensor_measures(sensors: DataFrame) -> DataFrame:
    """``taux_occupation = round(occupied/total*100, 1)``, ``alertes = occupied >= total``."""
    occ, tot = F.col("lits_occupes").cast("double"), F.col("lits_total").cast("double")
    return (sensors.withColumn("taux_occupation", F.round(F.try_divide(occ, F.nullif(tot, F.lit(0.0))) * 100.0, 1))
            .withColumn("alertes", flag(occ >= tot)))


def fact_bed_occupancy(sensors: DataFrame, calendar: DataFrame, calendar_rows: int | None = None, bounds: Bounds | None = None) -> DataFrame:
    df = _with_date_key(sensors, calendar, "date", "left", calendar_rows, bounds)
    return df.select("capteur_id", "hopital_id", "service_id", "temps_id", F.col("date_key").alias("date"),
                     F.col("heure").cast("int").alias("heure"),
                     F.col("lits_occupes").cast("int").alias("lits_occupes"),
                     F.col("lits_total").cast("int").alias("lits_total"),
                     F.col("taux_occupation").cast("double").alias("taux_occupation"),
                     int_or("alertes", 0).alias("alertes"), *_reason_of(df))


def stock_measures(stock: DataFrame, threshold: int) -> DataFrame:
    """``valeur_stock = round(stock*price, 2)``, ``sous_seuil_alerte = stock < threshold``."""
    s, p = F.col("stock_disponible").cast("double"), F.col("prix_unitaire").cast("double")
    return (stock.withColumn("valeur_stock", F.round(s * p, 2))
            .withColumn("sous_seuil_alerte", flag(s < threshold)))


def fact_pharmacy_stock(stock: DataFrame, calendar: DataFrame, calendar_rows: int | None = None, bounds: Bounds | None = None) -> DataFrame:
    df = _with_date_key(stock, calendar, "date", "left", calendar_rows, bounds)
    return df.select("stock_id", "temps_id", F.col("date_key").alias("date"), "code_medicament", "nom_medicament",
                     F.col("stock_disponible").cast("int").alias("stock_disponible"),
                     F.col("consommation_j").cast("bigint").alias("consommation_j"),
                     F.col("prix_unitaire").cast("double").alias("prix_unitaire"),
                     F.col("valeur_stock").cast("double").alias("valeur_stock"),
                     int_or("sous_seuil_alerte", 0).alias("sous_seuil_alerte"), *_reason_of(df))
