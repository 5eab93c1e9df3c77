"""Column-level expressions: coercion, bins, normalisation."""

from .bins import (admission_mode, age_band_staging, age_band_warehouse, cut, flag_label,  # noqa: F401
                   occupancy_level, stay_class)
from .coerce import (date_key, divide_or_zero, flag, int_or, iso_date, literal_like, ntz, number_or, pct,  # noqa: F401
                     safe_div, to_date, to_int, to_number, with_default)
from .normalize import clean_header, non_blank, normalize_sex, postcode  # noqa: F401
