"""Binning and label expressions (first matching branch wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .coerce import _c, to_int, to_number


def age_band_warehouse(age) -> Column:
    """<18 ``0-17``, <31 ``18-30``, <51 ``31-50``, <66 ``51-65``, else ``65+``;
    unparsable -> ``31-50``."""
    a = to_int(age)
    expr = None
    for upper, label in K.AGE_BAND_WAREHOUSE:
        expr = F.when(a < upper, label) if expr is None else expr.when(a < upper, label)
    return F.when(a.isNull(), K.AGE_BAND_WAREHOUSE_UNPARSABLE).otherwise(expr.otherwise(K.AGE_BAND_WAREHOUSE_ELSE))


def cut(value, edges: Sequence[float], labels: Sequence[str], right: bool = True,
        include_lowest: bool = False) -> Column:
    """``pandas.cut``: value in (edges[i], edges[i+1]] -> labels[i] (or [ , ) when
    ``right=False``); outside the edges or NULL -> NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("labels must have one element fewer than edges")
    v = to_number(value)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = float(edges[i]), float(edges[i + 1])
        if right:
            lower_ok = (v >= lo) if (include_lowest and i == 0) else (v > lo)
            cond = lower_ok & (v <= hi)
        else:
            upper_ok = (v <= hi) if (include_lowest and i == len(labels) - 1) else (v < hi)
            cond = (v >= lo) & upper_ok
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def age_band_staging(age) -> Column:
    """(0,14] ``0-14`` ... (89,120] ``90+``; 0, >120 and NULL -> NULL."""
    return cut(age, K.AGE_BAND_STAGING_EDGES, K.AGE_BAND_STAGING_LABELS, right=True)


def stay_class(days) -> Column:
    d = to_number(days)
    return (F.when(d <= 3, K.STAY_SHORT).when(d <= 7, K.STAY_MEDIUM).when(d > 7, K.STAY_LONG)
            .otherwise(K.STAY_UNKNOWN))


def occupancy_level(rate) -> Column:
    r = to_number(rate)
    return (F.when(r < K.OCC_LOW_BELOW, K.OCC_LOW).when(r < K.OCC_NORMAL_BELOW, K.OCC_NORMAL)
            .when(r >= K.OCC_NORMAL_BELOW, K.OCC_CRITICAL).otherwise(K.OCC_UNKNOWN))


def flag_label(flag, yes: str, no: str) -> Column:
    """1 -> ``yes``, 0 -> ``no``, anything else -> NULL."""
    f = to_int(flag)
    return F.when(f == 1, yes).when(f == 0, no)


def admission_mode(urgent_flag) -> Column:
    return flag_label(urgent_flag, K.MODE_URGENT, K.MODE_PLANNED)
