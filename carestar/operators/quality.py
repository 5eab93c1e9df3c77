"""Data-quality operators: dedup, audit, rule validation, orphan check, score.

Skew: every operator here is a hash aggregate.  Spark runs a partial
(map-side) aggregation before the shuffle, so a key that holds a third of all
rows is collapsed on each mapper and never lands whole in one task.  Dedup in
particular is ``max(struct(order..., payload...))`` per key rather than a
``row_number`` window (a window would sort a hot key inside one task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import to_number, to_date


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
          keep: str = "last") -> DataFrame:
    """One row per key.

    ``keep="last"`` keeps the row with the greatest ``(order_by..., remaining
    columns...)`` tuple, ``keep="first"`` the smallest; the remaining columns make
    the order total, so the result never depends on physical row order.  NULL
    sorts lowest; NULL keys form a single group (as pandas ``drop_duplicates``).
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = list(keys)
    order = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = order + rest
    if not payload:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(payload)])
    pick = F.max(packed) if keep == "last" else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    fields = {c: F.col(f"__row.f{i}").alias(c) for i, c in enumerate(payload)}
    return out.select(*[F.col(f"`{c}`") if c in keys else fields[c] for c in df.columns])


def dedup_stats(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: rows before, distinct keys after, rows removed."""
    parts = []
    for name, (df, keys) in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("avant"),
                            F.count_distinct(F.struct(*keys)).alias("apres"))
                     .select(F.lit(name).alias("table_name"), "avant", "apres",
                             (F.col("avant") - F.col("apres")).alias("supprimes")))
    return _union_all(parts)


def keep_range(df: DataFrame, col: str, lo: float, hi: float, keep_null: bool = True) -> DataFrame:
    """Coerce ``col`` to a number and drop rows outside [lo, hi] (NULL kept)."""
    v = to_number(col)
    cond = v.between(lo, hi)
    if keep_null:
        cond = cond | v.isNull()
    return df.withColumn(col, v).filter(cond)


def audit(df: DataFrame, table: str, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """One aggregation pass -> long ``(table_name, metric, value)`` rows.

    Always includes ``total`` and ``doublons`` (rows beyond the first per key);
    each extra metric is a boolean Column counted where true.
    """
    aggs = [F.count(F.lit(1)).alias("total"),
            (F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("doublons")]
    aggs += [F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(name) for name, cond in metrics.items()]
    wide = df.agg(*aggs)
    names = ["total", "doublons", *metrics.keys()]
    return (wide.unpivot([], names, "metric", "value")
            .select(F.lit(table).alias("table_name"), "metric", F.col("value").cast("bigint").alias("value")))


def patient_audit_metrics() -> dict[str, Column]:
    age = to_number("age")
    return {
        "nulls_nom": F.col("nom").isNull(),
        "nulls_age": F.col("age").isNull(),
        "age_invalide": (age < K.AGE_MIN) | (age > K.AGE_MAX),
        # NULL sex counts as invalid (pandas ~isin on NaN is True)
        "sexe_invalide": F.coalesce(~F.upper(F.col("sexe")).isin(*K.SEX_VALID), F.lit(True)),
    }


def admission_audit_metrics() -> dict[str, Column]:
    return {
        "nulls_pid": F.col("patient_id").isNull(),
        "nulls_date": F.col("date_admission").isNull(),
        "duree_neg": to_number("duree_sejour") < 0,
    }


def validate(df: DataFrame, rules: Mapping[str, Column], raise_on_error: bool = False) -> DataFrame:
    """Count violations of each rule in one pass -> ``(rule, violations)``.

    With ``raise_on_error`` the (tiny, one row per rule) result is fetched and a
    ``ValueError`` lists every violated rule.
    """
    wide = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(f"r{i}")
                    for i, cond in enumerate(rules.values())])
    names = list(rules.keys())
    long = (wide.unpivot([], [f"r{i}" for i in range(len(names))], "rid", "violations")
            .select(F.element_at(F.array(*[F.lit(n) for n in names]),
                                 (F.substring("rid", 2, 10).cast("int") + 1)).alias("rule"),
                    F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations")))
    if raise_on_error:
        bad = [r for r in long.collect() if r["violations"] > 0]
        if bad:
            raise ValueError("; ".join(f"{r['rule']}: {r['violations']} row(s)" for r in bad))
    return long


def patient_rules() -> dict[str, Column]:
    age = to_number("age")
    return {
        "patient_id_null": F.col("patient_id").isNull(),
        "sexe_hors_domaine": F.coalesce(~F.col("sexe").isin("M", "F", "m", "f"), F.lit(False)),
        "age_hors_plage": (age < K.AGE_MIN) | (age > K.AGE_MAX),
    }


def admission_rules() -> dict[str, Column]:
    adm = to_date("date_admission")
    out = to_date("date_sortie")
    return {
        "admission_id_null": F.col("admission_id").isNull(),
        "patient_id_null": F.col("patient_id").isNull(),
        "date_admission_invalide": F.col("date_admission").isNotNull() & adm.isNull(),
        "sortie_avant_admission": out < adm,
    }


def run_log_rules() -> dict[str, Column]:
    return {"statut_invalide": F.coalesce(~F.col("status").isin(*K.RUN_STATUSES), F.lit(True))}


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (``LEFT JOIN … IS NULL``)."""
    return fact.join(dim.select(key), on=key, how="left_anti")


def orphan_counts(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """``key, n``: keys of the fact without a dimension row; the join meets one row per key."""
    return orphans(fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")), dim, key)


def quality_score(audit_df: DataFrame) -> DataFrame:
    """100 − min(20, dup %) − min(30, null %) over every audited table, with level.

    Percentages are rounded half-to-even (Python ``round``).
    """
    totals = audit_df.agg(
        F.count_distinct("table_name").alias("tables_ok"),
        F.coalesce(F.sum(F.when(F.col("metric") == "total", F.col("value"))), F.lit(0)).cast("bigint").alias("total_lignes"),
        F.coalesce(F.sum(F.when(F.col("metric") == "doublons", F.col("value"))), F.lit(0)).cast("bigint").alias("total_doublons"),
        F.coalesce(F.sum(F.when(F.col("metric").startswith("nulls_"), F.col("value"))), F.lit(0)).cast("bigint").alias("total_nulls"),
    )
    lines = F.greatest(F.col("total_lignes"), F.lit(1)).cast("double")
    dup_malus = F.least(F.lit(K.SCORE_DUP_MALUS_CAP), F.bround(F.col("total_doublons") / lines * 100.0, 0).cast("int"))
    null_malus = F.least(F.lit(K.SCORE_NULL_MALUS_CAP), F.bround(F.col("total_nulls") / lines * 100.0, 0).cast("int"))
    score = F.when(F.col("total_lignes") > 0, F.lit(100) - dup_malus - null_malus).otherwise(F.lit(100))
    level = None
    for floor, name in K.SCORE_LEVELS:
        level = F.when(F.col("score") >= floor, name) if level is None else level.when(F.col("score") >= floor, name)
    return (totals.withColumn("score", score.cast("int"))
            .withColumn("niveau", level.otherwise(K.SCORE_LEVEL_ELSE))
            .withColumn("passe", F.col("score") >= K.SCORE_FAIL_BELOW)
            .select("score", "niveau", "passe", "tables_ok", "total_lignes", "total_doublons", "total_nulls"))


def assert_quality(score_df: DataFrame) -> int:
    """Raise when the (one-row) score is below the failing threshold."""
    row = score_df.select("score").first()
    if row is not None and row["score"] < K.SCORE_FAIL_BELOW:
        raise ValueError(f"quality score too low ({row['score']}/100)")
    return row["score"] if row is not None else 100


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
