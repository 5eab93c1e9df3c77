"""The warehouse build: staging -> dims -> facts written once, then queried.

This is the reference's lifecycle (extract -> clean -> star schema -> KPIs)
as Spark jobs.  ``build_warehouse`` writes every dimension and fact as
Parquet below the shared ``spark.checkpoint.dir``; BI queries (KPIs, reports,
measures, mart) then read those tables instead of recomputing the dedup and
the joins of the raw sources for every question.  A query on a
``BuiltWarehouse`` publishes the tables it reads that no one published before,
and no others.  Writing the tables also cuts the lineage: a lost executor costs
a re-read of Parquet, not a replay of the whole pipeline.

Layout choices for scale:
* ``fact_admissions`` (the big fact) is range-partitioned on (admission date,
  admission id) before writing, sorted by date inside each task and stored by
  year (``annee_admission``): year filters prune directories, date filters
  skip row groups through Parquet min/max statistics, and even a date holding
  a third of all admissions is split over many write tasks.
* Rows without a calendar day are stored apart by reason and counted by
  ``observe`` during the same write (``operators.rejects``).
* A table is published by a mark written after it; a folder without its mark
  is never read (an interrupted build is simply rebuilt).
* The folder name is a fingerprint of the inputs (paths, sizes, modification
  times) and of the build parameters, so changed inputs get a new build.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import facts, rejects
from ..schemas import conform
from ..session import cached_frame, checkpoint_dir, local_path
from ..sources import binding as B
from .warehouse import Warehouse

DIMENSIONS = ["dim_date", "dim_region", "dim_hospital", "dim_service", "dim_disease", "dim_patient"]
FACTS = ["fact_admissions", "fact_emergency", "fact_lab", "fact_prescriptions", "fact_bed_occupancy",
         "fact_pharmacy_stock"]
# facts that keep rows without a calendar day (with a NULL key)
UNDATED_KEPT = {"fact_bed_occupancy", "fact_pharmacy_stock"}
# facts that are made from the cleaned admissions
FROM_STAGING = {"fact_admissions", "fact_emergency", "fact_prescriptions"}
STAGING = "staging/stg_admissions"
MARKER = "_BUILD_OK"
TABLE_MARKS = "_tables"
REJECT_COUNTS = "reject_counts"
# part of a build's key: raise it with every change of what a build or a landing holds
BUILD_VERSION = "5"


def fingerprint(wh: Warehouse) -> str:
    parts = [BUILD_VERSION, wh.sf_dir, str(wh.calendar_start), str(wh.calendar_end), str(wh.daily_rate),
             str(wh.default_region)]
    for t in B.TABLES:
        parts.append(f"{t}:{_stat(wh.spark, f'{wh.sf_dir.rstrip(chr(47))}/{t}.parquet')}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def _stat(spark: SparkSession, path: str) -> str:
    """Size, file count and modification times of an input (file or folder), from the file
    system's metadata; an input whose metadata cannot be read is an error, never an old build."""
    p = local_path(path)
    if "://" not in p:
        if not os.path.exists(p):
            return "absent"
        files = [os.path.join(d, f) for d, _, fs in os.walk(p) for f in fs] if os.path.isdir(p) else [p]
        stats = [os.stat(f) for f in files]
        return f"{sum(s.st_size for s in stats)}:{len(stats)}:{max((s.st_mtime_ns for s in stats), default=0)}"
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return "absent"
    files = fs.listStatus(hp)
    return f"{sum(f.getLen() for f in files)}:{len(files)}:{max((f.getModificationTime() for f in files), default=0)}"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.json(path)
        return True
    except AnalysisException:
        return False


def _write_table(wh: Warehouse, base: str, name: str, partitions: int | None) -> None:
    """Write one table below ``base``, with its counts if it is a fact, then its mark."""
    spark = wh.spark
    if name in FACTS:
        counts = _write_admissions(wh, base, partitions) if name == FACTS[0] else rejects.write_split(
            conform(wh.dated(name, wh.calendar_bounds), name), f"{base}/{name}", name, keep=name in UNDATED_KEPT)
        # a few rows per fact, observed while it was written
        (spark.createDataFrame(counts, rejects.COUNTS).coalesce(1).write.mode("overwrite")
         .parquet(f"{base}/{REJECT_COUNTS}/{name}"))
    elif name == STAGING:
        wh.stg_admissions.write.mode("overwrite").parquet(f"{base}/{STAGING}")
    else:
        conform(getattr(wh, name), name).write.mode("overwrite").parquet(f"{base}/{name}")
    _mark(spark, f"{base}/{TABLE_MARKS}/{name}")


def _write_admissions(wh: Warehouse, base: str, partitions: int | None) -> list[tuple]:
    fa = facts.with_readmission(wh.dated_admissions(wh.calendar_bounds))
    # range partitions sized by AQE (or fixed by ``partitions``); the id as second
    # range key splits a date that holds a large share of all admissions
    keys = ["date_admission", "admission_id"]
    ranged = fa.repartitionByRange(partitions, *keys) if partitions else fa.repartitionByRange(*keys)
    # columns that follow from others are added after the last shuffle
    out = conform(facts.admission_attributes(ranged, wh.daily_rate), FACTS[0])
    # the partitioned write sorts each task by reason and year anyway; sorting by
    # the date too costs the same and leaves every file ordered by date, so
    # row-group min/max statistics skip date ranges
    return rejects.write_split(out.withColumn("annee_admission", F.year("date_admission")), f"{base}/{FACTS[0]}", FACTS[0],
                               then_by=["annee_admission"], sort=["date_admission"])


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).select(F.lit(BUILD_VERSION).alias("version")).write.mode("overwrite").json(path)


def publish(wh: Warehouse, path: str, names: Sequence[str], partitions: int | None = None, parallel: int = 4) -> None:
    """Write those of the tables ``names`` that ``path`` does not hold yet.

    1. the cleaned admissions staging is written once, before the first table that
       needs it (its join is the costly shuffle), and read back by those tables;
    2. dimensions and facts are independent jobs, submitted concurrently so
       small tables do not wait for each other;
    3. each table's mark is written after it.
    """
    spark, base = wh.spark, path.rstrip("/")
    app = spark.sparkContext.applicationId

    def there(name: str) -> bool:
        key = (app, base, name)
        if key not in _PUBLISHED and _exists(spark, f"{base}/{TABLE_MARKS}/{name}"):
            _PUBLISHED.add(key)
        return key in _PUBLISHED

    with _LOCK:  # queries submitted from several threads share one build
        todo = [n for n in names if not there(n)]
        if not todo:
            return
        if FROM_STAGING.intersection(todo):
            if not there(STAGING):
                _write_table(wh, base, STAGING, partitions)
            wh = wh.replace(stg_admissions=spark.read.parquet(f"{base}/{STAGING}"))
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for f in [pool.submit(_write_table, wh, base, n, partitions) for n in todo]:
                f.result()
        _PUBLISHED.update((app, base, n) for n in todo)
        _mark(spark, f"{base}/{MARKER}")


def build_warehouse(wh: Warehouse, path: str, partitions: int | None = None, parallel: int = 4) -> str:
    """Write every dimension and fact below ``path``; returns ``path``."""
    base = path.rstrip("/")
    publish(wh, base, [FACTS[0], *DIMENSIONS, *FACTS[1:]], partitions, parallel)
    return base


class BuiltWarehouse(Warehouse):
    """A :class:`Warehouse` whose dimensions and facts are read from a build (written there on first use)."""

    def __init__(self, spark: SparkSession, sf_dir: str, path: str, **kw):
        super().__init__(spark, sf_dir, **kw)
        self.path = path.rstrip("/")
        self._raw = Warehouse(spark, sf_dir, **kw)

    def publish(self, names: Sequence[str] = (*DIMENSIONS, *FACTS)) -> BuiltWarehouse:
        """Write the named tables (all by default) unless they are there."""
        publish(self._raw, self.path, names)
        return self

    def _read(self, name: str) -> DataFrame:
        self.publish([name])
        # a published build never changes (new inputs or code get a new folder),
        # so its relations are resolved once per session
        path = f"{self.path}/{name}"
        if name not in FACTS:
            return cached_frame(self.spark, ("build", path), lambda: self.spark.read.parquet(path))
        path = rejects.accepted_path(path)
        return cached_frame(self.spark, ("build", path), lambda: self._or_empty(
            name, lambda: self.spark.read.parquet(path)))

    def _or_empty(self, name: str, read) -> DataFrame:
        """What ``read`` gives; a fact of which no row was written has no folder to read."""
        try:
            return read()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        none = self.dated(name)
        if name == FACTS[0]:
            none = facts.with_readmission(none).withColumn("annee_admission", F.year("date_admission"))
        return none.filter(F.lit(False))

    @cached_property
    def reject_counts(self) -> DataFrame:
        """``table_name, motif, n_lignes, conserve`` of every fact, as observed when it was written."""
        self.publish(FACTS)
        return self.spark.read.schema(rejects.COUNTS).parquet(*[f"{self.path}/{REJECT_COUNTS}/{t}" for t in FACTS])

    def rejects(self, name: str) -> DataFrame:
        """Rows of a fact whose date has no calendar day, with every column and the reason."""
        self.publish([name])
        return self._or_empty(name, lambda: rejects.read_rejects(self.spark, f"{self.path}/{name}"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._read("dim_date")

    @cached_property
    def dim_region(self) -> DataFrame:
        return self._read("dim_region")

    @cached_property
    def dim_hospital(self) -> DataFrame:
        return self._read("dim_hospital")

    @cached_property
    def dim_service(self) -> DataFrame:
        return self._read("dim_service")

    @cached_property
    def dim_disease(self) -> DataFrame:
        return self._read("dim_disease")

    @cached_property
    def dim_patient(self) -> DataFrame:
        return self._read("dim_patient")

    @cached_property
    def fact_admissions_readmit(self) -> DataFrame:
        return self._read("fact_admissions")

    @cached_property
    def fact_admissions(self) -> DataFrame:
        return self.fact_admissions_readmit

    @cached_property
    def fact_emergency(self) -> DataFrame:
        return self._read("fact_emergency")

    @cached_property
    def fact_lab(self) -> DataFrame:
        return self._read("fact_lab")

    @cached_property
    def fact_prescriptions(self) -> DataFrame:
        return self._read("fact_prescriptions")

    @cached_property
    def fact_bed_occupancy(self) -> DataFrame:
        return self._read("fact_bed_occupancy")

    @cached_property
    def fact_pharmacy_stock(self) -> DataFrame:
        return self._read("fact_pharmacy_stock")


_BUILDS: dict[tuple, str] = {}
_PUBLISHED: set[tuple] = set()      # (application, build, table)
_LOCK = threading.RLock()


def warehouse_for(spark: SparkSession, sf_dir: str, **kw) -> BuiltWarehouse:
    """The build for ``sf_dir``; its tables are published on first use."""
    fp = fingerprint(Warehouse(spark, sf_dir, **kw))
    base = f"{checkpoint_dir(spark).rstrip('/')}/carestar-warehouse/{fp}"
    with _LOCK:
        _BUILDS[spark.sparkContext.applicationId, base] = base
    return BuiltWarehouse(spark, sf_dir, base, **kw)


def retire_builds(spark: SparkSession, keep: int = 3) -> int:
    """Delete all but the ``keep`` builds published last below the checkpoint folder; returns how many went.

    A build that this session has in use is never deleted.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/carestar-warehouse")
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return 0
    found = []
    for f in fs.listStatus(root):
        marker = jvm.org.apache.hadoop.fs.Path(f.getPath(), MARKER)
        found.append((fs.getFileStatus(marker).getModificationTime() if fs.exists(marker) else -1, f.getPath()))
    used = {base.rsplit("/", 1)[-1] for base in _BUILDS.values()}
    old = [p for _, p in sorted(found, key=lambda x: -x[0])[keep:] if p.getName() not in used]
    for p in old:
        fs.delete(p, True)
    return len(old)


def run_daily(spark: SparkSession, sf_dir: str, out_dir: str, as_of=None, computed_at: str | None = None,
              **kw) -> DataFrame:
    """The daily chain of the reference's schedule, as one job sequence:

    audit staging -> quality gate -> publish the warehouse -> write the mart ->
    write the KPI cache -> dated CSV exports of both.  Every step appends a
    start and an end event (with the rows it wrote) to the run log below
    ``out_dir``; the returned frame is the latest event per step.
    """
    import datetime as dt

    from .. import constants as K
    from ..functions import ntz
    from ..operators import quality as Q
    from ..operators.mart import analytics_mart
    from ..sinks import writers as W
    from ..sources.files import write_csv
    from . import kpis
    from .queries_quality import quality_audit

    as_of = as_of or K.AS_OF_ADMISSIONS
    computed_at = computed_at or K.COMPUTED_AT
    base = out_dir.rstrip("/")
    log_path = f"{base}/etl_log"
    run = f"daily-{as_of.isoformat()}"

    def event(task: str, status: str, records=None, error=None) -> None:
        row = spark.range(1).select(
            F.lit(f"{run}-{task}").alias("run_id"), F.lit("daily").alias("dag_name"), F.lit(task).alias("task_name"),
            ntz(dt.datetime.now()).alias("event_time"), F.lit(status).alias("status"),
            F.lit(records).cast("bigint").alias("records"), F.lit(error).cast("string").alias("error"),
            F.lit(sf_dir).alias("source"))
        W.log_events(row, log_path)

    def step(task: str, fn):
        event(task, "RUNNING")
        try:
            n = fn()
        except Exception as e:  # noqa: BLE001 — logged, then raised
            event(task, "FAILED", error=str(e))
            raise
        event(task, "SUCCESS", records=n)

    raw = Warehouse(spark, sf_dir, **kw)
    state: dict = {}

    def audit() -> int:
        W.replace(quality_audit(raw), f"{base}/quality_audit")
        score = Q.quality_score(spark.read.parquet(f"{base}/quality_audit"))
        W.replace(score, f"{base}/quality_score")
        Q.assert_quality(spark.read.parquet(f"{base}/quality_score"))
        return spark.read.parquet(f"{base}/quality_audit").count()

    def publish() -> int:
        state["wh"] = warehouse_for(spark, sf_dir, **kw).publish()
        return state["wh"].fact_admissions.count()

    def mart() -> int:
        wh = state["wh"]
        W.replace(analytics_mart(wh.fact_admissions, wh.dim_patient, wh.dim_hospital, wh.dim_region,
                                 wh.dim_disease, wh.dim_date, calendar_rows=wh.calendar_rows), f"{base}/analytics_mart")
        return spark.read.parquet(f"{base}/analytics_mart").count()

    def kpi_cache() -> int:
        wh = state["wh"]
        W.replace(kpis.kpi_cache(wh, computed_at).unionByName(kpis.kpi_cache_top5(wh, computed_at)),
                  f"{base}/kpi_cache")
        return spark.read.parquet(f"{base}/kpi_cache").count()

    def export() -> int:
        day = as_of.isoformat()
        write_csv(spark.read.parquet(f"{base}/analytics_mart"), f"{base}/reports/analytics_mart_{day}")
        write_csv(spark.read.parquet(f"{base}/kpi_cache"), f"{base}/reports/kpi_cache_{day}")
        return 2

    for task, fn in (("audit_qualite", audit), ("publier_entrepot", publish), ("creer_mart", mart),
                     ("calculer_kpis", kpi_cache), ("export_csv", export)):
        step(task, fn)
    return W.latest_runs(spark.read.parquet(log_path))
