"""KPIs come in their stated order."""

import pytest

import __spark_entry__ as E

SF_SMALL = "/root/testdata/sf0.001"
ORDERS = {
    "kpi_bed_occupancy": "-taux_occupation_pct", "kpi_length_of_stay": "-dms_jours", "kpi_daily_admissions": "-date",
    "kpi_cases_by_region": "-nb_admissions", "kpi_age_split": "+tranche_age",
    "kpi_readmission_rate": "-taux_readmission_pct", "kpi_emergency_wait": "-annee",
    "kpi_abnormal_labs": "-taux_anomalie_pct", "kpi_urgent_vs_planned": "-annee",
    "kpi_admissions_by_service": "-nb_admissions", "kpi_incidence": "-taux_incidence_100k",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_in_order(spark, name):
    column = ORDERS[name][1:]
    got = [r[column] for r in E.queries()[name](spark, SF_SMALL).collect() if r[column] is not None]
    assert got == sorted(got, reverse=ORDERS[name][0] == "-")
