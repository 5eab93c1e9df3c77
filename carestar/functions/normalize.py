"""Cleaning expressions for staging columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .coerce import _c


def normalize_sex(c) -> Column:
    """trim + upper; HOMME/H/MALE -> M; FEMME/FEMALE/FE -> F; other values kept."""
    s = F.upper(F.trim(_c(c)))
    return (F.when(s.isin(*K.SEX_MALE_SPELLINGS), F.lit("M"))
            .when(s.isin(*K.SEX_FEMALE_SPELLINGS), F.lit("F"))
            .otherwise(s))


def postcode(c) -> Column:
    """trim, left-pad with 0 to five characters, keep the first five."""
    s = F.trim(_c(c).cast("string"))
    padded = F.when(F.length(s) >= 5, s).otherwise(F.lpad(s, 5, "0"))
    return F.substring(padded, 1, 5)


def clean_header(name: str, blank: str = " ") -> str:
    """Header normalisation applied to every source file: strip + lower; ``blank`` replaces inner blanks."""
    return name.strip().lower().replace(" ", blank)


def non_blank(c) -> Column:
    """Non-null and non-empty (Power Query key filter)."""
    col = _c(c)
    return col.isNotNull() & (col.cast("string") != F.lit(""))
