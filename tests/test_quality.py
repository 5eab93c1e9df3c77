"""Dedup, audit, validation, orphans, quality score."""

import datetime as dt

import pytest
from carestar.operators import quality as Q

from conftest import rows

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _dups(spark):
    return spark.createDataFrame(
        [("P1", T0, "old"), ("P1", T1, "new"), ("P2", T1, "b"), ("P2", T1, "a"), (None, T0, "x"), (None, T1, "y"),
         ("", T0, "empty")],
        "patient_id string, loaded_at timestamp, nom string")


def test_dedup_keep_last_is_deterministic_on_ties(spark):
    out = rows(Q.dedup(_dups(spark), ["patient_id"], ["loaded_at"], keep="last"), "patient_id", "nom")
    # NULL keys form one group; equal loaded_at broken by the remaining columns
    assert out == [(None, "y"), ("", "empty"), ("P1", "new"), ("P2", "b")]


def test_dedup_keep_first(spark):
    out = rows(Q.dedup(_dups(spark), ["patient_id"], ["loaded_at"], keep="first"), "patient_id", "nom")
    assert out == [(None, "x"), ("", "empty"), ("P1", "old"), ("P2", "a")]


def test_dedup_is_a_hash_or_sort_aggregate_not_a_window(spark):
    plan = Q.dedup(_dups(spark), ["patient_id"], ["loaded_at"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_dedup_stats_counts_null_key_group(spark):
    r = Q.dedup_stats({"t": (_dups(spark), ["patient_id"])}).collect()[0]
    assert (r["avant"], r["apres"], r["supprimes"]) == (7, 4, 3)


def test_audit_long_form(spark):
    df = spark.createDataFrame([("1", "A", "45", "M"), ("1", None, "130", None), ("2", "B", None, "f")],
                               "patient_id string, nom string, age string, sexe string")
    got = {r["metric"]: r["value"] for r in Q.audit(df, "stg_patients", ["patient_id"],
                                                   Q.patient_audit_metrics()).collect()}
    assert got == {"total": 3, "doublons": 1, "nulls_nom": 1, "nulls_age": 1, "age_invalide": 1, "sexe_invalide": 1}


def test_validate_raises_with_messages(spark):
    df = spark.createDataFrame([(None, "M", "45"), ("2", "X", "130")], "patient_id string, sexe string, age string")
    with pytest.raises(ValueError, match="patient_id_null"):
        Q.validate(df, Q.patient_rules(), raise_on_error=True)
    ok = spark.createDataFrame([("1", "m", "0"), ("2", "F", "120")], "patient_id string, sexe string, age string")
    assert all(r["violations"] == 0 for r in Q.validate(ok, Q.patient_rules(), raise_on_error=True).collect())


def test_discharge_before_admission_rule(spark):
    df = spark.createDataFrame([("A1", "P1", "2024-01-10", "2024-01-15"), ("A2", "P2", "2024-02-14", "2024-02-10")],
                               "admission_id string, patient_id string, date_admission string, date_sortie string")
    got = {r["rule"]: r["violations"] for r in Q.validate(df, Q.admission_rules()).collect()}
    assert got["sortie_avant_admission"] == 1 and got["date_admission_invalide"] == 0


def test_run_log_status_rule(spark):
    df = spark.createDataFrame([("SUCCESS",), ("INVALID_STATUS",)], "status string")
    assert Q.validate(df, Q.run_log_rules()).collect()[0]["violations"] == 1


def test_orphans(spark):
    fact = spark.createDataFrame([(1, "P1"), (2, "P9")], "admission_id int, patient_id string")
    dim = spark.createDataFrame([("P1",)], "patient_id string")
    assert [r["admission_id"] for r in Q.orphans(fact, dim, "patient_id").collect()] == [2]


@pytest.mark.parametrize("total,dups,nulls,score,level", [
    (100, 0, 0, 100, "EXCELLENT"), (100, 5, 5, 90, "EXCELLENT"), (100, 30, 0, 80, "BON"),
    (100, 30, 50, 50, "MOYEN"), (0, 0, 0, 100, "EXCELLENT"), (1000, 25, 0, 98, "EXCELLENT"),
])
def test_quality_score(spark, total, dups, nulls, score, level):
    audit = spark.createDataFrame([("t", "total", total), ("t", "doublons", dups), ("t", "nulls_x", nulls)],
                                  "table_name string, metric string, value bigint")
    r = Q.quality_score(audit).collect()[0]
    assert (r["score"], r["niveau"]) == (score, level)


def test_quality_score_half_even_rounding(spark):
    # 2.5 % duplicates rounds to 2 (half to even), 3.5 % to 4
    for dups, expected in ((25, 98), (35, 96)):
        audit = spark.createDataFrame([("t", "total", 1000), ("t", "doublons", dups)],
                                      "table_name string, metric string, value bigint")
        assert Q.quality_score(audit).collect()[0]["score"] == expected


def test_score_floor_is_50_and_assert_quality(spark):
    # the malus caps (20 + 30) make 50 the lowest reachable score
    audit = spark.createDataFrame([("t", "total", 10), ("t", "doublons", 9), ("t", "nulls_x", 9)],
                                  "table_name string, metric string, value bigint")
    assert Q.assert_quality(Q.quality_score(audit)) == 50
    with pytest.raises(ValueError):
        Q.assert_quality(spark.createDataFrame([(40,)], "score int"))


def test_keep_range_keeps_nulls(spark):
    df = spark.createDataFrame([(v,) for v in ["-1", "0", "120", "121", "abc", None]], "age string")
    assert rows(Q.keep_range(df, "age", 0, 120)) == [(None,), (None,), (0.0,), (120.0,)]
