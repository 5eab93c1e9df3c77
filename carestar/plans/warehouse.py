"""The star schema assembled from the bound driver tables.

``Warehouse`` only builds lazy plans: nothing runs until a query acts on a
frame.  ``carestar.plans.build`` writes the dims and facts once and serves
them back (``BuiltWarehouse``); operator queries compose the plans they need
from the raw tables and Catalyst prunes everything else.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import dims, facts
from ..sources import binding as B


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, calendar_start: dt.date = K.CALENDAR_START,
                 calendar_end: dt.date = K.CALENDAR_END, daily_rate: float = K.DAILY_RATE,
                 default_region=0):
        self.spark = spark
        self.sf_dir = sf_dir
        self.calendar_start = calendar_start
        self.calendar_end = calendar_end
        self.calendar_rows = dims.calendar_rows(calendar_start, calendar_end)
        self.daily_rate = daily_rate
        self.default_region = default_region

    def replace(self, **tables: DataFrame) -> Warehouse:
        """A copy whose named tables are the given frames (e.g. a written staging
        table read back); everything built on them follows."""
        other = self.__class__.__new__(self.__class__)
        other.__dict__.update({k: v for k, v in self.__dict__.items() if not isinstance(v, DataFrame)})
        other.__dict__.update(tables)
        return other

    def table(self, name: str) -> DataFrame:
        return B.read(self.spark, self.sf_dir, name)

    # staging -------------------------------------------------------------
    @cached_property
    def stg_admissions_raw(self) -> DataFrame:
        return B.stg_admissions(self.spark, self.sf_dir)

    @cached_property
    def stg_admissions(self) -> DataFrame:
        """Cleaned admissions: latest version of each admission (Q1), with the
        derived columns of the landed file."""
        return B.admission_details(B.one_per_admission(self.spark, self.sf_dir, keep="last"))

    # dimensions ----------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark, self.calendar_start, self.calendar_end)

    @cached_property
    def dim_region(self) -> DataFrame:
        return dims.dim_region(B.stg_regions(self.spark, self.sf_dir))

    @cached_property
    def dim_hospital(self) -> DataFrame:
        return dims.dim_hospital(B.stg_hospitals(self.spark, self.sf_dir))

    @cached_property
    def dim_service(self) -> DataFrame:
        return dims.dim_service(B.stg_services(self.spark, self.sf_dir))

    @cached_property
    def dim_disease(self) -> DataFrame:
        return dims.dim_disease(B.stg_diseases(self.spark, self.sf_dir))

    @cached_property
    def dim_patient(self) -> DataFrame:
        return dims.dim_patient(B.stg_patients(self.spark, self.sf_dir), self.dim_region, self.default_region)

    # facts ---------------------------------------------------------------
    def dated(self, name: str, bounds: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """A fact by name; with ``bounds`` it keeps every row and tells in ``rejet`` why a date has no day."""
        cal = {"calendar_rows": self.calendar_rows, "bounds": bounds}
        if name == "fact_admissions":
            return facts.admission_attributes(self.dated_admissions(bounds), self.daily_rate)
        if name == "fact_emergency":
            return facts.fact_emergency(self.stg_admissions, self.dim_date, **cal)
        if name == "fact_lab":
            return facts.fact_lab(B.stg_labs(self.spark, self.sf_dir), self.dim_date, **cal)
        if name == "fact_prescriptions":
            # from the cleaned staging: prescriptions are deduped (latest version per
            # prescription) before the fact is built, and the build reuses the written
            # staging instead of joining the raw sources a second time
            return facts.fact_prescriptions(B.stg_prescriptions(self.spark, self.sf_dir, self.stg_admissions),
                                            self.dim_date, **cal)
        if name == "fact_bed_occupancy":
            return facts.fact_bed_occupancy(B.stg_sensors(self.spark, self.sf_dir), self.dim_date, **cal)
        if name == "fact_pharmacy_stock":
            return facts.fact_pharmacy_stock(B.stg_stock(self.spark, self.sf_dir), self.dim_date, **cal)
        raise ValueError(f"no dated fact {name!r}")

    def dated_admissions(self, bounds: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """The admissions fact without the columns that follow from its others."""
        return facts.fact_admissions(self.stg_admissions, self.dim_date, unique=True, attributes=False,
                                     calendar_rows=self.calendar_rows, bounds=bounds)

    @property
    def calendar_bounds(self) -> tuple[dt.date, dt.date]:
        return self.calendar_start, self.calendar_end

    @cached_property
    def fact_admissions(self) -> DataFrame:
        return self.dated("fact_admissions")

    @cached_property
    def fact_admissions_readmit(self) -> DataFrame:
        return facts.with_readmission(self.fact_admissions)

    @cached_property
    def fact_emergency(self) -> DataFrame:
        return self.dated("fact_emergency")

    @cached_property
    def fact_lab(self) -> DataFrame:
        return self.dated("fact_lab")

    @cached_property
    def fact_prescriptions(self) -> DataFrame:
        return self.dated("fact_prescriptions")

    @cached_property
    def fact_bed_occupancy(self) -> DataFrame:
        return self.dated("fact_bed_occupancy")

    @cached_property
    def fact_pharmacy_stock(self) -> DataFrame:
        return self.dated("fact_pharmacy_stock")


def data_calendar(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date] | None:
    """First and last day of the years that the sources' dates cover (one aggregate per source), None without dates.

    ``Warehouse(spark, sf_dir, *data_calendar(...))`` rejects no dated row.
    """
    dated = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    row = dims.year_bounds(*[(B.read(spark, sf_dir, t), c) for t, c in dated]).first()
    return (row["start"], row["end"]) if row["start"] is not None else None
