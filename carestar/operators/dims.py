"""Conformed dimensions (star schema)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import age_band_warehouse, int_or, number_or, to_date, to_number
from .quality import dedup


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add absent optional columns as typed NULLs (reference: missing -> None)."""
    for name, dtype in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(dtype))
    return df


def first_non_empty(*dfs: DataFrame) -> DataFrame:
    """The first source that has at least one row (API/staging, else file).

    ``isEmpty`` reads at most one row, so the check is cheap at any size.
    """
    for df in dfs[:-1]:
        if df is not None and not df.isEmpty():
            return df
    return dfs[-1]


def dim_region(src: DataFrame) -> DataFrame:
    df = ensure_columns(src, {"population": "double", "superficie": "double", "chef_lieu": "string"})
    out = df.select("region_id", "nom_region",
                    to_number("population").alias("population"),
                    to_number("superficie").alias("superficie"),
                    F.col("chef_lieu").cast("string").alias("chef_lieu"))
    return dedup(out, ["region_id"], keep="first")


def dim_hospital(src: DataFrame) -> DataFrame:
    df = ensure_columns(src, {"ville": "string", "type": "string", "capacite_lits": "double",
                              "nb_medecins": "double", "region_id": "string"})
    out = df.select("hopital_id", "nom", "ville", "region_id",
                    number_or("capacite_lits", K.DEFAULT_HOSPITAL_BEDS).alias("capacite_lits"),
                    "type",
                    number_or("nb_medecins", K.DEFAULT_HOSPITAL_DOCTORS).alias("nb_medecins"))
    return dedup(out, ["hopital_id"], keep="first")


def dim_service(src: DataFrame) -> DataFrame:
    df = ensure_columns(src, {"departement": "string", "specialite": "string", "nb_lits": "double"})
    out = df.select("service_id", "nom_service", "departement", "specialite",
                    number_or("nb_lits", K.DEFAULT_SERVICE_BEDS).alias("nb_lits"))
    return dedup(out, ["service_id"], keep="first")


def dim_disease(src: DataFrame) -> DataFrame:
    df = src.withColumnRenamed("nom", "nom_maladie") if "nom" in src.columns else src
    df = ensure_columns(df, {"code_cim10": "string", "categorie": "string", "gravite": "int",
                             "est_chronique": "int"})
    out = df.select("maladie_id", "nom_maladie", "code_cim10", "categorie",
                    int_or("gravite", K.DEFAULT_DISEASE_SEVERITY).alias("gravite"),
                    int_or("est_chronique", K.DEFAULT_CHRONIC).alias("est_chronique"))
    return dedup(out, ["maladie_id"], keep="first")


def dim_patient(src: DataFrame, regions: DataFrame, default_region) -> DataFrame:
    """Patients with age band and region id looked up from the region name.

    Unknown region names get ``default_region``.  The look-up table is the
    region dimension (one row per name); the planner broadcasts it while small.
    """
    df = ensure_columns(src, {"prenom": "string", "date_naissance": "string", "ville": "string",
                              "region": "string"})
    lookup = dedup(regions.select(F.col("nom_region").alias("region"), "region_id"), ["region"], keep="first")
    joined = df.join(lookup, on="region", how="left")
    out = joined.select(
        "patient_id", "nom", "prenom",
        to_date("date_naissance").alias("date_naissance"),
        to_number("age").alias("age"),
        F.col("sexe"),
        age_band_warehouse("age").alias("tranche_age"),
        F.coalesce(F.col("region_id"), F.lit(default_region)).alias("region_id"),
        F.col("ville"),
    )
    return dedup(out, ["patient_id"], keep="first")


def calendar(bounds: DataFrame) -> DataFrame:
    """Dense calendar from a one-row frame with date columns ``start`` and ``end``.

    ``temps_id`` = days since ``start`` + 1, so no window is needed to number rows.
    Row count = days in the range: bounded by the range, not by the data volume.
    """
    days = bounds.select(F.col("start"),
                         F.explode(F.sequence(F.col("start"), F.col("end"), F.expr("INTERVAL 1 DAY"))).alias("date"))
    wd = F.weekday("date")  # Monday = 0
    return days.select(
        (F.datediff("date", "start") + 1).alias("temps_id"),
        "date",
        F.dayofmonth("date").alias("jour"),
        F.month("date").alias("mois"),
        F.year("date").alias("annee"),
        F.quarter("date").alias("trimestre"),
        F.weekofyear("date").alias("semaine"),
        F.element_at(F.array(*[F.lit(n) for n in K.WEEKDAY_NAMES_FR]), wd + 1).alias("jour_semaine"),
        F.when(wd >= 5, 1).otherwise(0).alias("est_weekend"),
        F.element_at(F.array(*[F.lit(n) for n in K.MONTH_NAMES_FR]), F.month("date")).alias("nom_mois"),
    )


def dim_date(spark: SparkSession, start: dt.date = K.CALENDAR_START, end: dt.date = K.CALENDAR_END) -> DataFrame:
    """Calendar for a fixed [start, end] range (reference: 2022..2026 by default)."""
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar(bounds)


def calendar_rows(start: dt.date = K.CALENDAR_START, end: dt.date = K.CALENDAR_END) -> int:
    return (end - start).days + 1


def year_bounds(*date_columns: tuple[DataFrame, str]) -> DataFrame:
    """One row: Jan 1 of the earliest year and Dec 31 of the latest year seen in
    the given (frame, column) pairs — a global aggregate per source."""
    parts = [df.agg(F.min(F.col(c).cast("date")).alias("lo"), F.max(F.col(c).cast("date")).alias("hi"))
             for df, c in date_columns]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.make_date(F.year(F.min("lo")), F.lit(1), F.lit(1)).alias("start"),
                 F.make_date(F.year(F.max("hi")), F.lit(12), F.lit(31)).alias("end"))
