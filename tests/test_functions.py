"""Column expressions: bins, labels, normalisation, coercion (edge rows from FIXTURES §3)."""

from pyspark.sql import functions as F

from carestar.functions import (age_band_staging, age_band_warehouse, cut, flag_label, iso_date, normalize_sex,
                                occupancy_level, postcode, stay_class, to_date)


def _one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_age_band_warehouse_edges(spark):
    # the reference test's edges: 5, 25, 45, 60, 70, 0, 120
    out = _one(spark, ["5", "25", "45", "60", "70", "0", "120", "17", "18", "30", "31", "50", "51", "65", "66"],
               age_band_warehouse)
    assert out == ["0-17", "18-30", "31-50", "51-65", "65+", "0-17", "65+", "0-17", "18-30", "18-30", "31-50",
                   "31-50", "51-65", "51-65", "65+"]


def test_age_band_warehouse_unparsable_is_31_50(spark):
    assert _one(spark, ["abc", None], age_band_warehouse) == ["31-50", "31-50"]


def test_age_band_staging_right_closed(spark):
    out = _one(spark, ["-1", "0", "14", "15", "17", "18", "29", "30", "89", "90", "120", "121", "abc", None],
               age_band_staging)
    assert out == [None, None, "0-14", "15-29", "15-29", "15-29", "15-29", "30-44", "75-89", "90+", "90+", None,
                   None, None]


def test_cut_include_lowest_and_left_closed(spark):
    out = _one(spark, [0.0, 1.0, 2.0], lambda c: cut(c, [0, 1, 2], ["a", "b"], include_lowest=True), "double")
    assert out == ["a", "a", "b"]
    out = _one(spark, [0.0, 1.0, 2.0], lambda c: cut(c, [0, 1, 2], ["a", "b"], right=False), "double")
    assert out == ["a", "b", None]


def test_normalize_sex(spark):
    out = _one(spark, [" m ", "Homme", "FE", "female", "X", None, "h", "MALE", "Femme"], normalize_sex)
    assert out == ["M", "M", "F", "F", "X", None, "M", "M", "F"]


def test_postcode(spark):
    assert _one(spark, ["1000", " 75001 ", "750011", None], postcode) == ["01000", "75001", "75001", None]


def test_iso_date_and_to_date(spark):
    out = _one(spark, ["2024-02-30", "2024-01-05T08:00:00", "", "2024-02-29", None], iso_date)
    assert out == [None, "2024-01-05", None, "2024-02-29", None]
    assert [str(x) for x in _one(spark, ["2024-01-05 10:00:00"], to_date)] == ["2024-01-05"]


def test_stay_class_boundaries(spark):
    out = _one(spark, [None, 3.0, 4.0, 7.0, 8.0], stay_class, "double")
    assert out == ["Inconnue", "Courte (<= 3j)", "Moyenne (4-7j)", "Moyenne (4-7j)", "Longue (> 7j)"]


def test_occupancy_level_boundaries(spark):
    out = _one(spark, [59.9, 60.0, 84.9, 85.0, None], occupancy_level, "double")
    assert out == ["Faible", "Normal", "Normal", "Critique", "Inconnu"]


def test_flag_label(spark):
    assert _one(spark, [1, 0, None, 2], lambda c: flag_label(c, "Oui", "Non"), "int") == ["Oui", "Non", None, None]
