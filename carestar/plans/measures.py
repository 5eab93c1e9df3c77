"""Measure layer: named measures evaluated under a filter context.

``measure(model, keys, by=[...], slicers={...})`` returns one row per value of
the ``by`` columns with one column per requested measure.

Model: tables (facts and dimensions) plus N:1 relations ``(table, fk) ->
(dim, pk)``.  A column used as an axis or slicer is found on the measure's own
table or on a dimension reachable through relations (snowflakes included);
the needed dimension columns are joined on (left join, so rows without a
dimension member land on the NULL member).

Filter-context rules kept from the BI model:
* blank instead of zero: counts and distinct counts over no rows are NULL;
* ``DIVIDE(a, b, 0)``: 0 when b is 0 or blank, blank when a is blank;
* a measure's boolean filter on a column *replaces* a slicer on that column
  (``CALCULATE(…, col = v)``); an ``intersect`` filter is added to the slicers
  (``CALCULATE(…, FILTER(table, …))``);
* ratios combine aggregates *after* grouping; measures of different tables
  are aggregated per table and then joined on the axis keys (drill-across,
  never row to row).

Every measure is split into mergeable parts.  When an axis, slicer or filter
lies in a dimension that grows with the data, the parts are aggregated on the
table's own columns (foreign keys, own axes) first, the dimensions join those
rows, and the parts are merged under the measure's mask above the join: no
table row meets such a dimension.  The calendar is bounded by its range and is
joined (broadcast) below.  Distinct counts of whole-number ids are bitmaps where
no growing dimension takes part, distinct (keys, id) rows otherwise; each has a
plan of its own, so no row is expanded.  Two-level measures merge per (axis,
inner key).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bitmaps
from ..operators.joins import MAX_BROADCAST_ROWS

Pred = Callable[[Column], Column]


@dataclass(frozen=True)
class Aggregate:
    """An aggregate in two steps: ``parts`` over table rows, ``merge(part, mask)`` over rows of parts.

    ``part`` gives the column of a part by its name.  With ``distinct`` the
    aggregate counts the distinct values of that column and has no parts.
    """
    parts: Mapping[str, Column]
    merge: Callable[[Callable[[str], Column], Column], Column] | None = None
    distinct: str | None = None


@dataclass(frozen=True)
class Measure:
    key: str
    label: str
    table: str | None = None
    agg: Aggregate | Callable[[Column], Column] | None = None   # two-level measures: inner value -> aggregate
    filters: Mapping[str, Pred] = field(default_factory=dict)    # replace slicers on these columns
    intersect: Mapping[str, Pred] = field(default_factory=dict)  # added to the slicers
    inner: tuple[str, Aggregate] | None = None  # two-level: (key column, inner aggregate)
    derive: Callable[[dict[str, Column]], Column] | None = None
    deps: tuple[str, ...] = ()
    uses: tuple[str, ...] = ()  # columns the aggregate reads from related dimensions


@dataclass
class Model:
    tables: dict[str, DataFrame]
    relations: list[tuple[str, str, str, str]]  # (table, fk, dim, pk)
    bounded: frozenset[str] = frozenset()  # dimensions whose rows are bounded by construction

    def below(self, table: str, columns: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
        """``table`` joined with its bounded dimensions, and what its parts are grouped on:
        the columns found there, and the foreign keys that lead to the others."""
        here, away, keys = [], [], []
        for c in columns:
            path = self.path_to(table, c)
            if path is None:
                raise ValueError(f"column {c!r} is not reachable from table {table!r}")
            if all(dim in self.bounded for _, dim, _ in path):
                here.append(c)
            else:
                away.append(c)
                if path[0][0] not in keys:
                    keys.append(path[0][0])
        return self.frame(table, here, broadcast=True), here, keys if away else []

    def above(self, rows: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
        """Rows of parts of ``table`` with the columns of its growing dimensions."""
        return Model({**self.tables, table: rows}, self.relations).frame(table, columns)

    def _edges(self, table: str):
        return [(fk, dim, pk) for t, fk, dim, pk in self.relations if t == table]

    def path_to(self, table: str, column: str) -> list[tuple[str, str, str]] | None:
        """Shortest chain of relations from ``table`` to a table holding ``column``
        (``column`` may be qualified as ``dim.col``)."""
        owner, col = column.split(".", 1) if "." in column else (None, column)
        frontier = [(table, [])]
        seen = {table}
        while frontier:
            nxt = []
            for t, path in frontier:
                if (owner is None or owner == t) and col in self.tables[t].columns:
                    return path
                for fk, dim, pk in self._edges(t):
                    if dim not in seen:
                        seen.add(dim)
                        nxt.append((dim, path + [(fk, dim, pk)]))
            frontier = nxt
        return None

    def frame(self, table: str, columns: Sequence[str], broadcast: bool = False) -> DataFrame:
        """``table`` with every requested column available under its bare name.

        Each hop is a left join of one dimension column on the relation key
        (foreign and primary key share their name in this model); dimensions
        are unique on their key, so the fact never fans out.
        """
        df = self.tables[table]
        hops: dict[tuple, list[str]] = {}  # (depth, fk, dim, pk) -> columns to bring from dim
        for c in columns:
            bare = c.split(".", 1)[-1]
            path = self.path_to(table, c)
            if path is None:
                raise ValueError(f"column {c!r} is not reachable from table {table!r}")
            for i, (fk, dim, pk) in enumerate(path):
                target = path[i + 1][0] if i + 1 < len(path) else bare
                cols = hops.setdefault((i, fk, dim, pk), [])
                if target not in cols:
                    cols.append(target)
        for (_, fk, dim, pk), targets in sorted(hops.items(), key=lambda kv: kv[0][0]):
            missing = [t for t in targets if t not in df.columns]
            if missing:
                side = self.tables[dim].select(F.col(pk).alias(fk), *missing)
                df = df.join(F.broadcast(side) if broadcast else side, fk, "left")
        return df


def _and(preds: list[Column]) -> Column:
    out = F.lit(True)
    for p in preds:
        out = out & F.coalesce(p, F.lit(False))
    return out


def _col(expr) -> Column:
    return expr if isinstance(expr, Column) else F.col(expr)


def count_rows() -> Aggregate:
    return Aggregate({"n": F.count(F.lit(1))}, lambda p, m: F.nullif(F.coalesce(F.sum(F.when(m, p("n"))), F.lit(0)), F.lit(0)))


def distinct_count(col: str) -> Aggregate:
    return Aggregate({}, distinct=col)


def sum_of(expr) -> Aggregate:
    return Aggregate({"s": F.sum(_col(expr))}, lambda p, m: F.sum(F.when(m, p("s"))))


def exact_sum(expr: Column, scale: int = 2) -> Aggregate:
    """Money sum: each value rounded to ``scale`` decimals and summed as a decimal,
    so the total does not depend on the order in which partitions are added."""
    return Aggregate({"s": F.sum(expr.cast(f"decimal(18,{scale})"))}, lambda p, m: F.sum(F.when(m, p("s"))).cast("double"))


def avg_of(expr) -> Aggregate:
    return Aggregate({"s": F.sum(_col(expr)), "c": F.count(_col(expr))}, lambda p, m: F.try_divide(
        F.sum(F.when(m, p("s"))).cast("double"), F.sum(F.when(m, p("c"))).cast("double")))


def avg_of_related(col: str) -> Aggregate:
    """Mean of a dimension's column over the table's rows: weighted by the rows of each key."""
    def merge(p, m):
        known = m & F.col(col).isNotNull()
        return F.try_divide(F.sum(F.when(known, F.col(col) * p("n"))).cast("double"),
                            F.sum(F.when(known, p("n"))).cast("double"))
    return Aggregate({"n": F.count(F.lit(1))}, merge)


def max_of(expr) -> Aggregate:
    return Aggregate({"m": F.max(_col(expr))}, lambda p, m: F.max(F.when(m, p("m"))))


def divide(a: Column, b: Column) -> Column:
    """DAX ``DIVIDE(a, b, 0)``."""
    return F.when(b.isNull() | (b == 0), F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _requested(registry: Mapping[str, Measure], keys: Sequence[str]) -> list[Measure]:
    order: list[Measure] = []
    seen: set[str] = set()

    def visit(k: str):
        if k in seen:
            return
        m = registry[k]
        for d in m.deps:
            visit(d)
        seen.add(k)
        order.append(m)

    for k in keys:
        visit(k)
    return order


def _join_on_axes(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Full outer join on the axis columns with NULL-safe equality."""
    r = right.select(*[F.col(b).alias(f"__r_{b}") for b in by], *[c for c in right.columns if c not in by])
    cond = _and([F.col(b).eqNullSafe(F.col(f"__r_{b}")) for b in by]) if by else F.lit(True)
    j = left.join(r, cond, "full")
    return j.select(*[F.coalesce(F.col(b), F.col(f"__r_{b}")).alias(b) for b in by],
                    *[c for c in left.columns if c not in by],
                    *[c for c in right.columns if c not in by])


def _bare(c: str) -> str:
    return c.split(".", 1)[-1]


def _part(model: Model, ms: list[Measure], by: Sequence[str], axes: Sequence[str], slicers: Mapping[str, Sequence],
          all_axes: bool = True) -> DataFrame:
    """The measures of one table (and one inner key, or one distinct count): a row per axis value.

    Without ``all_axes`` a distinct count may leave out the axis values where it is blank.
    """
    table, inner_key = ms[0].table, ms[0].inner[0] if ms[0].inner else None
    replaced = {c for m in ms for c in m.filters}
    cols = sorted(set(by) | set(slicers) | {c for m in ms for c in (*m.filters, *m.intersect, *m.uses)})
    df, here, keys = model.below(table, cols)

    def sliced(frame: DataFrame, columns) -> DataFrame:
        common = [F.col(_bare(c)).isin(list(v)) for c, v in slicers.items() if c not in replaced and c in columns]
        return frame.filter(_and(common)) if common else frame

    def mask_of(m: Measure) -> Column:
        preds = [F.col(_bare(c)).isin(list(v)) for c, v in slicers.items() if c in replaced and c not in m.filters]
        preds += [p(F.col(_bare(c))) for c, p in (*m.filters.items(), *m.intersect.items())]
        return _and(preds)

    df, away = sliced(df, here), [c for c in cols if c not in here]
    own = [_bare(c) for c in here]
    group = list(dict.fromkeys([*own, *keys, *([inner_key] if inner_key else [])]))
    aggs = [m.inner[1] if m.inner else m.agg for m in ms]

    if inner_key is None and aggs[0].distinct:
        m, col = ms[0], aggs[0].distinct
        if not away and bitmaps.fits(df, col):
            maps = bitmaps.bitmaps(df, axes, col, mask_of(m))
            found = bitmaps.count(maps, axes, m.key)
            if not axes:
                return found.select(F.nullif(m.key, F.lit(0)).alias(m.key))
            return _join_on_axes(df.select(*axes).distinct(), found, axes) if all_axes else found
        rows = sliced(model.above(df.select(*dict.fromkeys([*group, col])).distinct(), table, away), away)
        counted = F.nullif(F.count_distinct(F.when(mask_of(m), F.col(col))), F.lit(0)).alias(m.key)
        return rows.groupBy(*axes).agg(counted) if axes else rows.agg(counted)

    named = [c.alias(f"__{m.key}_{n}") for m, a in zip(ms, aggs) for n, c in a.parts.items()]
    rows = df.groupBy(*group).agg(*named) if group else df.agg(*named)
    rows = sliced(model.above(rows, table, away), away) if away else rows
    merged = [a.merge(lambda n, m=m: F.col(f"__{m.key}_{n}"), mask_of(m)) for m, a in zip(ms, aggs)]
    if inner_key is None:
        out = [c.alias(m.key) for m, c in zip(ms, merged)]
        return rows.groupBy(*axes).agg(*out) if axes else rows.agg(*out)
    pre = rows.groupBy(*axes, inner_key).agg(*[c.alias(f"__in_{m.key}") for m, c in zip(ms, merged)])
    out = [m.agg(F.col(f"__in_{m.key}").isNotNull()).alias(m.key) for m in ms]
    return pre.groupBy(*axes).agg(*out) if axes else pre.agg(*out)


def measure(model: Model, registry: Mapping[str, Measure], keys: Sequence[str], by: Sequence[str] = (),
            slicers: Mapping[str, Sequence] | None = None, digits: int | None = 4) -> DataFrame:
    slicers = dict(slicers or {})
    by = list(by)
    axes = [b.split(".", 1)[-1] for b in by]
    plan = _requested(registry, keys)
    base = [m for m in plan if m.derive is None]
    groups: dict[tuple, list[Measure]] = {}
    for m in base:
        alone = m.key if m.inner is None and m.agg.distinct else None
        groups.setdefault((m.table, m.inner[0] if m.inner else None, alone), []).append(m)

    # without slicers, plain measures of a table bring every axis value that its distinct counts can have
    plain = set() if slicers else {table for table, inner_key, alone in groups if inner_key is None and alone is None}
    parts = [_part(model, ms, by, axes, slicers, all_axes=table not in plain) for (table, _, _), ms in groups.items()]
    if axes:
        out = parts[0]
        for p in parts[1:]:
            out = _join_on_axes(out, p, axes)
    else:
        # one row per part: every other part enters as ONE struct-typed scalar
        # subquery (evaluated once, its fields read from the struct)
        out = parts[0]
        for p in parts[1:]:
            packed = p.select(F.struct(*p.columns).alias("s")).scalar()
            out = out.select("*", *[packed.getField(c).alias(c) for c in p.columns])

    cols = {c: F.col(c) for c in out.columns}
    for m in plan:
        if m.derive is not None:
            out = out.withColumn(m.key, m.derive(cols))
            cols[m.key] = F.col(m.key)
    wanted = [k for k in keys]
    out = out.select(*axes, *wanted)
    if digits is not None:
        out = out.select(*[F.round(F.col(c), digits).alias(c)
                           if isinstance(out.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
                           for c in out.columns])
    return out


# ---------------------------------------------------------------------------
# the measure catalogue of the hospital model

def _eq(v) -> Pred:
    return lambda c: c == v


FA, FO, FL, FP, FS = "fact_admissions", "fact_bed_occupancy", "fact_lab", "fact_prescriptions", "fact_pharmacy_stock"
DP, DH = "dim_patient", "dim_hospital"

def _catalogue() -> list[Measure]:
    return [
    # admissions & activity
    Measure("total_admissions", "Total Admissions", FA, count_rows()),
    Measure("patients_distincts", "Patients Distincts", FA, distinct_count("patient_id")),
    Measure("dms_moyen", "DMS Moyen", FA, avg_of(F.when(F.col("duree_sejour") > 0, F.col("duree_sejour")))),
    Measure("cout_moyen_sejour", "Coût Moyen Séjour", FA, avg_of("cout_hospitalisation")),
    Measure("cout_total", "Coût Total", FA, sum_of("cout_hospitalisation")),
    Measure("admissions_urgence", "Admissions Urgence", FA, count_rows(),
            filters={"mode_admission": _eq("Urgence")}),
    Measure("pct_admissions_urgences", "% Admissions Urgences",
            derive=lambda c: divide(c["admissions_urgence"], c["total_admissions"]) * 100.0,
            deps=("admissions_urgence", "total_admissions")),
    Measure("admissions_programmees", "Admissions Programmées", FA, count_rows(),
            filters={"mode_admission": _eq("Programmée")}),
    Measure("patients_multi_sejours", "Patients 2+ séjours", FA,
            agg=lambda present: F.nullif(F.count(F.when(present & (F.col("__in_patients_multi_sejours") >= 2), 1)), F.lit(0)),
            inner=("patient_id", count_rows())),
    Measure("taux_readmission", "Taux Réadmission",
            derive=lambda c: divide(c["patients_multi_sejours"], c["patients_distincts"]) * 100.0,
            deps=("patients_multi_sejours", "patients_distincts")),
    # patients
    Measure("age_moyen_patients", "Âge Moyen Patients", FA, avg_of_related("age"), uses=("age",)),
    Measure("patients_hommes", "Patients Hommes", DP, distinct_count("patient_id"), filters={"sexe": _eq("M")}),
    Measure("patientes_femmes", "Patientes Femmes", DP, distinct_count("patient_id"), filters={"sexe": _eq("F")}),
    Measure("pct_femmes", "% Femmes",
            derive=lambda c: divide(c["patientes_femmes"], c["patients_distincts"]) * 100.0,
            deps=("patientes_femmes", "patients_distincts")),
    # hospitals & capacity
    Measure("hopitaux_actifs", "Hôpitaux Actifs", FA, distinct_count("hopital_id")),
    Measure("capacite_totale_lits", "Capacité Totale Lits", DH,
            agg=lambda present: F.sum(F.when(present, F.col("__in_capacite_totale_lits"))),
            inner=("hopital_id", max_of("capacite_lits"))),
    Measure("taux_occupation_moyen", "Taux Occupation Moyen", FO, avg_of("taux_occupation")),
    Measure("pic_occupation", "Pic Occupation", FO, max_of("taux_occupation")),
    Measure("alertes_capacite", "Alertes Capacité", FO, sum_of("alertes")),
    Measure("ratio_charge", "Ratio Charge",
            derive=lambda c: divide(c["total_admissions"], c["capacite_totale_lits"]),
            deps=("total_admissions", "capacite_totale_lits")),
    # diseases
    Measure("pathologies_distinctes", "Pathologies Distinctes", FA, distinct_count("maladie_id")),
    Measure("maladies_chroniques", "Maladies Chroniques", FA, count_rows(), filters={"est_chronique": _eq(1)}),
    Measure("pct_maladies_chroniques", "% Maladies Chroniques",
            derive=lambda c: divide(c["maladies_chroniques"], c["total_admissions"]) * 100.0,
            deps=("maladies_chroniques", "total_admissions")),
    Measure("dms_chroniques", "DMS Chroniques", FA, avg_of(F.when(F.col("duree_sejour") > 0, F.col("duree_sejour"))),
            intersect={"est_chronique": _eq(1)}),
    Measure("dms_aigues", "DMS Aiguës", FA, avg_of(F.when(F.col("duree_sejour") > 0, F.col("duree_sejour"))),
            intersect={"est_chronique": _eq(0)}),
    # laboratory
    Measure("total_analyses", "Total Analyses", FL, count_rows()),
    Measure("analyses_par_admission", "Analyses par Admission",
            derive=lambda c: divide(c["total_analyses"], c["total_admissions"]),
            deps=("total_analyses", "total_admissions")),
    Measure("analyses_anormales", "Analyses anormales", FL, count_rows(), filters={"est_anormal": _eq(1)}),
    Measure("taux_anomalies", "Taux Anomalies",
            derive=lambda c: divide(c["analyses_anormales"], c["total_analyses"]) * 100.0,
            deps=("analyses_anormales", "total_analyses")),
    # prescriptions
    Measure("total_prescriptions", "Total Prescriptions", FP, count_rows()),
    Measure("prescriptions_par_admission", "Prescriptions par Admission",
            derive=lambda c: divide(c["total_prescriptions"], c["total_admissions"]),
            deps=("total_prescriptions", "total_admissions")),
    Measure("cout_medicaments_total", "Coût Médicaments Total", FP,
            exact_sum(F.col("quantite") * F.col("prix_unitaire"))),
    # pharmacy stock
    Measure("valeur_stock_total", "Valeur Stock Total", FS, exact_sum(F.col("valeur_stock"))),
    Measure("ruptures_stock", "Ruptures Stock", FS, count_rows(), filters={"sous_seuil_alerte": _eq(1)}),
    Measure("lignes_stock", "Lignes stock", FS, count_rows()),
    Measure("pct_alerte_stock", "% Alerte Stock",
            derive=lambda c: divide(c["ruptures_stock"], c["lignes_stock"]) * 100.0,
            deps=("ruptures_stock", "lignes_stock")),
    # calendar
    Measure("admissions_semaine", "Admissions Semaine", FA, count_rows(), filters={"est_weekend": _eq(0)}),
    Measure("admissions_weekend", "Admissions Weekend", FA, count_rows(), filters={"est_weekend": _eq(1)}),
    # reference tables
    Measure("population", "Population", "dim_region", sum_of("population")),
    Measure("taux_100k", "Admissions pour 100 000 habitants",
            derive=lambda c: divide(c["total_admissions"], c["population"]) * 100000.0,
            deps=("total_admissions", "population")),
]


class _Catalogue(Mapping):
    """The catalogue, built on first use (its Columns need an active session)."""

    _items: dict[str, Measure] | None = None

    def _all(self) -> dict[str, Measure]:
        if self._items is None:
            self._items = {m.key: m for m in _catalogue()}
        return self._items

    def __getitem__(self, key: str) -> Measure:
        return self._all()[key]

    def __iter__(self):
        return iter(self._all())

    def __len__(self) -> int:
        return len(self._all())


MEASURES: Mapping[str, Measure] = _Catalogue()


def hospital_model(wh) -> Model:
    """The BI model over a :class:`~carestar.plans.warehouse.Warehouse`."""
    tables = {
        FA: wh.fact_admissions, FO: wh.fact_bed_occupancy, FL: wh.fact_lab, FP: wh.fact_prescriptions,
        FS: wh.fact_pharmacy_stock, DP: wh.dim_patient, DH: wh.dim_hospital, "dim_region": wh.dim_region,
        "dim_disease": wh.dim_disease, "dim_service": wh.dim_service, "dim_date": wh.dim_date,
    }
    rel = [
        (FA, "temps_id", "dim_date", "temps_id"), (FA, "patient_id", DP, "patient_id"),
        (FA, "hopital_id", DH, "hopital_id"), (FA, "maladie_id", "dim_disease", "maladie_id"),
        (FA, "service_id", "dim_service", "service_id"), (DP, "region_id", "dim_region", "region_id"),
        (FO, "temps_id", "dim_date", "temps_id"), (FO, "hopital_id", DH, "hopital_id"),
        (FL, "temps_id", "dim_date", "temps_id"), (FL, "hopital_id", DH, "hopital_id"),
        (FP, "temps_id", "dim_date", "temps_id"), (FP, "hopital_id", DH, "hopital_id"),
        (FP, "service_id", "dim_service", "service_id"), (FS, "temps_id", "dim_date", "temps_id"),
    ]
    # the calendar has a row per day of its range; beyond the broadcast bound it is joined like the others
    return Model(tables, rel, frozenset({"dim_date"} if wh.calendar_rows <= MAX_BROADCAST_ROWS else ()))


def monthly_patient_bitmaps(fact: DataFrame, calendar: DataFrame, path: str) -> None:
    """Store the patients of every month as bitmaps: ``annee, mois, bucket, bitmap``."""
    cal = calendar.select("temps_id", "annee", "mois")
    bitmaps.bitmaps(fact.join(cal, "temps_id"), ["annee", "mois"], "patient_id").write.mode("overwrite").parquet(path)


def yearly_patients(monthly: DataFrame) -> DataFrame:
    """Distinct patients per year from stored monthly bitmaps, next to the sum of the monthly counts.

    Counts of months cannot be added (a patient may come in several); their
    bitmaps merge without touching the fact again.
    """
    months = bitmaps.count(monthly, ["annee", "mois"], "n").groupBy("annee").agg(F.sum("n").alias("patients_mois_cumules"))
    years = bitmaps.count(bitmaps.merge(monthly, ["annee"]), ["annee"], "patients_distincts")
    return years.join(months, "annee").select("annee", "patients_distincts", "patients_mois_cumules")


def month_over_month(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Admissions per month next to the previous month.

    Gap-safe: the previous month is found by joining on ``add_months(month, 1)``
    (a ``lag`` would skip months without admissions).  A month that only
    follows an active month appears with blank admissions.
    """
    cal = calendar.select("temps_id", "annee", "mois")
    monthly = (fact.select("temps_id").join(cal, "temps_id")
               .groupBy(F.make_date("annee", "mois", F.lit(1)).alias("mois_debut"))
               .agg(F.count(F.lit(1)).alias("total_admissions")))
    prev = monthly.select(F.add_months("mois_debut", 1).alias("mois_debut"),
                          F.col("total_admissions").alias("admissions_periode_precedente"))
    j = monthly.join(prev, "mois_debut", "full")
    cur, prv = F.col("total_admissions"), F.col("admissions_periode_precedente")
    delta = F.coalesce(cur, F.lit(0)) - F.coalesce(prv, F.lit(0))
    return j.select(
        F.year("mois_debut").alias("annee"), F.month("mois_debut").alias("mois"),
        cur.alias("total_admissions"), prv.alias("admissions_periode_precedente"),
        delta.alias("delta_admissions"),
        F.round(divide(delta, prv) * 100.0, 4).alias("pct_croissance_admissions"),
    )
