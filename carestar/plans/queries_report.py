"""Query registrations: report aggregates."""

from __future__ import annotations

from . import reports as R
from .catalog import bi_query

for _name in ["report_diseases", "report_hospitals", "report_regions", "report_monthly", "report_sex",
              "report_occupancy", "cases_by_category", "top_occupancy_hospitals", "occupancy_by_hour",
              "occupancy_by_service", "matrix_disease_region", "pivot_disease_age_band", "category_trend", "top_cities", "top_hospital",
              "top_consumed_drugs", "stock_alert_trend", "abnormal_by_month",
              "hospital_scorecard", "occupancy_level_mix"]:
    bi_query(_name, getattr(R, _name))
