"""Tables of a build are published one by one, by the queries that read them."""

import os

from pyspark.sql import functions as F

from carestar.operators import facts, rejects
from carestar.operators.quality import dedup
from carestar.plans import reports
from carestar.plans.build import BuiltWarehouse, TABLE_MARKS
from carestar.sources import binding as B
from conftest import SF_SMALL, rows


def test_a_query_publishes_only_what_it_reads(spark, tmp_dir):
    path = tmp_dir("lazy")
    wh = BuiltWarehouse(spark, SF_SMALL, path)
    assert reports.top_consumed_drugs(wh).count() == 10
    assert os.listdir(f"{path}/{TABLE_MARKS}") == ["fact_pharmacy_stock"]
    assert not os.path.exists(f"{path}/fact_admissions") and not os.path.exists(f"{path}/staging")
    reports.category_trend(wh)
    assert sorted(os.listdir(f"{path}/{TABLE_MARKS}")) == ["dim_date", "dim_disease", "fact_admissions", "fact_pharmacy_stock",
                                                           "staging"]
    # counts need every fact
    assert {r.table_name for r in wh.reject_counts.collect()} >= {"fact_lab", "fact_emergency"}


def test_an_unmarked_table_is_written_again(spark, tmp_dir):
    path = tmp_dir("broken")
    spark.range(3).write.parquet(f"{path}/dim_region")
    assert BuiltWarehouse(spark, SF_SMALL, path).dim_region.count() == 25


def _lines(spark, path, numbers):
    """Two orders with the given line numbers, each line in two versions."""
    li = [(o, n, n + v, 7, float(n + v), 1.0, 0.0, 0.0, "A", "O", v) for o in (1, 2) for n in numbers for v in (0, 1)]
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    df = spark.createDataFrame(li, ", ".join(f"{n} {t}" for n, t in zip(
        names, ["long", "int", "long", "long", "double", "double", "double", "double", "string", "string"])) + ", v int")
    (df.withColumn("l_shipdate", F.expr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(v)")).drop("v")
     .write.parquet(f"{path}/lineitem.parquet"))
    (spark.sql("SELECT 1L AS o_orderkey, 5L AS o_custkey, timestamp_ntz'2000-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority "
               "UNION ALL SELECT 2L, 6L, timestamp_ntz'2000-01-02 00:00:00', '3-MEDIUM'").write.parquet(f"{path}/orders.parquet"))
    return path


def test_admissions_are_deduplicated_without_a_shuffle_of_their_own(spark, tmp_dir):
    for numbers, one_shuffle in (([1, 2, 3], True), ([1, 11], False)):     # 1 * 10 + 11 = 2 * 10 + 1
        d = _lines(spark, tmp_dir("lines"), numbers)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = B.one_per_admission(spark, d)
            exchanges = got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
            assert B.ids_name_orders(spark, d) == one_shuffle and exchanges == (2 if one_shuffle else 3)
            assert rows(got) == rows(dedup(B.stg_admissions(spark, d), ["admission_id"], B.ADMISSION_DEDUP_ORDER, "last"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got.count() == (6 if one_shuffle else 3)


def test_admissions_travel_without_the_columns_that_follow(spark, tmp_dir):
    wh = BuiltWarehouse(spark, SF_SMALL, tmp_dir("narrow"))
    narrow = facts.with_readmission(wh._raw.dated_admissions())
    assert not {"mode_admission", "mode_sortie", "cout_sejour", "cout_hospitalisation"} & set(narrow.columns)
    want = wh._raw.fact_admissions_readmit
    assert rows(wh.fact_admissions.select(want.columns)) == rows(want)
    assert rejects.REASON not in wh.fact_admissions.columns
