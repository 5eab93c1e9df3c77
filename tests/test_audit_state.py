"""Audits as mergeable states: against the one-pass audit, over loads, replayed."""

import random

import pytest
from pyspark.sql import functions as F

from carestar.operators import audit_state as A
from carestar.operators import quality as Q
from conftest import rows


def _frame(spark, kind, n=4000):
    rnd = random.Random(5)
    data = [(None if i % 97 == 0 else (0 if i % 3 == 0 else rnd.randrange(-50_000, 90_000)),
             None if i % 11 == 0 else "x", i % 2 == 0, i) for i in range(n)]
    df = spark.createDataFrame(data, "k long, nom string, rx boolean, i int").repartition(5)
    return df.withColumn("k", F.col("k").cast(kind))


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_state_equals_one_pass_audit_over_any_loads(spark, tmp_dir, kind):
    df = _frame(spark, kind)
    nulls = {"nulls_nom": F.col("nom").isNull()}
    tables = [A.Audited("t", nulls), A.Audited("rx", where=F.col("rx"))]
    want = rows(Q.audit(df, "t", ["k"], nulls).unionByName(Q.audit(df.filter("rx"), "rx", ["k"], {})))
    assert rows(A.audit_report(A.audit_state(df, "k", tables))) == want
    path = tmp_dir("states")
    for load in range(3):
        A.store_load(A.audit_state(df.filter(F.col("i") % 3 == load), "k", tables), path, str(load))
    A.store_load(A.audit_state(df.filter(F.col("i") % 3 == 1), "k", tables), path, "1")      # replayed
    stored = spark.read.parquet(path).drop("load")
    assert rows(A.audit_report(stored)) == want
    assert rows(A.duplicate_report(stored)) == rows(Q.dedup_stats({"t": (df, ["k"]), "rx": (df.filter("rx"), ["k"])}))


def test_empty_table_and_hot_key(spark):
    df = _frame(spark, "bigint")
    assert A.audit_report(A.audit_state(df.filter("false"), "k", [A.Audited("t")])).count() == 0
    state = A.audit_state(df, "k", [A.Audited("t")])
    # whole-number keys: a row per bucket, not per key
    assert state.count() <= 90_000 // 32_768 + 50_000 // 32_768 + 4


def test_orphans_meet_the_dimension_once_per_key(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "p int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "p int")
    assert rows(Q.orphan_counts(fact, dim, "p")) == [(None, 1), (3, 1)]
    assert rows(Q.orphans(fact, dim, "p")) == [(None,), (3,)]
