"""Plan shape: pushdown, pruning, broadcast only of the bounded calendar, no Python UDFs."""

import pytest

import __spark_entry__ as E
from carestar.plans.kpis import kpi_length_of_stay, kpi_sex_split
from carestar.plans.catalog import all_queries
from carestar.plans.build import warehouse_for
from carestar.plans.warehouse import Warehouse
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_udf_in_any_query(spark, name):
    if name.startswith(("stream_", "ingest_", "xml_", "staff_", "export_", "reload_", "incremental_",
                        "run_log", "source_fallback", "table_counts")):
        pytest.skip("writes files while planning; covered by the oracle test")
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_fact_reads_only_needed_columns_and_pushes_filters(spark):
    fa = Warehouse(spark, SF_SMALL).fact_admissions
    plan = fa._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan


def test_calendar_is_broadcast(spark):
    plan = _plan(Warehouse(spark, SF_SMALL).fact_admissions)
    assert "BroadcastHashJoin" in plan


def test_year_filter_prunes_build_partitions(spark):
    wh = warehouse_for(spark, SF_SMALL)
    plan = _plan(kpi_length_of_stay(wh))
    assert "PartitionFilters: [isnotnull(annee_admission" in plan and "= 2000)" in plan


def test_share_of_total_has_no_global_window(spark):
    plan = _plan(kpi_sex_split(warehouse_for(spark, SF_SMALL)))
    assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _joins_above_aggregate(df) -> list[bool]:
    """Per Join of the optimized plan: is there an Aggregate below it on its
    fact side (the dimension is joined to per-key rows, not fact rows)?"""
    plan = df._jdf.queryExecution().optimizedPlan()

    def walk(node, acc):
        acc.append(node)
        for i in range(node.children().size()):
            walk(node.children().apply(i), acc)
        return acc

    def has_agg(node) -> bool:
        return any(n.nodeName() == "Aggregate" for n in walk(node, []))

    return [has_agg(j.children().apply(0)) for j in walk(plan, []) if j.nodeName() == "Join"]


@pytest.mark.parametrize("name", ["kpi_top_diseases", "kpi_length_of_stay", "kpi_bed_occupancy",
                                  "report_diseases", "cases_by_category", "top_hospital"])
def test_fact_is_aggregated_before_dimension_joins(spark, name):
    flags = _joins_above_aggregate(E.queries()[name](spark, SF_SMALL))
    assert flags and all(flags)


def _nodes(node, acc=None):
    acc = [] if acc is None else acc
    acc.append(node)
    for i in range(node.children().size()):
        _nodes(node.children().apply(i), acc)
    return acc


def _joins_below_first_aggregate(df) -> list[str]:
    """Joins under an Aggregate that has no Aggregate below it, except those with the bounded calendar."""
    plan = df._jdf.queryExecution().optimizedPlan()
    found = []
    for node in _nodes(plan):
        below = _nodes(node)[1:] if node.nodeName() == "Aggregate" else []
        if below and not any(n.nodeName() == "Aggregate" for n in below):
            found += [j.simpleString(200) for j in below if j.nodeName() == "Join" and "temps_id" not in j.simpleString(200)]
    return found


@pytest.mark.parametrize("name", [
    "kpi_sex_split", "kpi_age_split", "kpi_cases_by_region", "kpi_incidence", "category_trend", "matrix_disease_region",
    "pivot_disease_age_band", "report_sex", "report_regions", "report_occupancy", "measures_patients",
    "measures_disease", "measures_by_sex", "measures_by_age_band", "measures_by_category", "measures_by_chronic",
    "measures_by_axis", "measures_by_slicer", "measures_capacity"])
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_growing_dimension_meets_fact_rows(spark, name, threshold):
    """The facts are aggregated below every dimension join, whatever the broadcast threshold."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, threshold)
        assert _joins_below_first_aggregate(E.queries()[name](spark, SF_SMALL)) == []
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["kpi_cache", "measures_distinct", "measures_admissions", "measures_yearly_patients"])
def test_distinct_counts_expand_no_row(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    below = [n for a in _nodes(df._jdf.queryExecution().optimizedPlan()) if a.nodeName() == "Aggregate" for n in _nodes(a)]
    assert "bitmap" in _plan(df) or name == "measures_yearly_patients"     # there they are read from storage
    assert not any(n.nodeName() == "Expand" for n in below)
