"""Pivot over a list of values given by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, weight: str,
                 other: str = "autres", total: str = "total") -> DataFrame:
    """One row per ``rows``, one column per value of ``values``: the sum of ``weight``.

    A row whose ``column`` is NULL or not in ``values`` counts in ``other``; a
    cell without rows is 0; ``total`` adds all up.  The list is fixed before the
    data is read, so the plan is one aggregate and the number of columns does not
    grow with the data.
    """
    names = [str(v) for v in values]
    taken = [c for c in (*rows, other, total) if c in names]
    if taken or len(set(names)) < len(names):
        raise ValueError(f"values clash with each other or with a column: {taken or names}")
    rest = other
    label = F.when(F.col(column).isin(list(values)), F.col(column).cast("string")).otherwise(F.lit(rest))
    wide = (df.select(*rows, label.alias("__label"), F.col(weight).alias("__w"))
            .groupBy(*rows).pivot("__label", [*names, rest]).agg(F.sum("__w")))
    cells = [F.coalesce(F.col(f"`{n}`"), F.lit(0)).cast("bigint") for n in (*names, rest)]
    every = cells[0]
    for c in cells[1:]:
        every = every + c
    return wide.select(*rows, *[c.alias(n) for c, n in zip(cells, (*names, rest))], every.alias(total))
