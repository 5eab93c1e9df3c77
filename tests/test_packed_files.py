"""Large landed text files are packed, in files of bounded rows, and read back whole."""

import os

from pyspark.sql import functions as F

from carestar.plans import queries_io as Q
from carestar.plans.warehouse import Warehouse
from carestar.sources import files as S
from conftest import SF_SMALL, rows


def _names(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_packed_csv_keeps_every_value_and_bounds_its_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "PACKED_ROWS", 2)
    df = spark.createDataFrame([(str(i), f'a\n"{i}", é ') for i in range(5)] + [("9", "")], "id string, t string").coalesce(1)
    path = tmp_dir("packed")
    S.write_csv(df, path, compression="gzip")
    assert len(_names(path)) == 3 and all(f.endswith(".csv.gz") for f in _names(path))
    plain = tmp_dir("plain")
    S.write_csv(df, plain)
    got = rows(S.read_csv_all_string(spark, path).select("id", "t"))
    assert got == rows(S.read_csv_all_string(spark, plain).select("id", "t")) and got[:5] == rows(df)[:5]


def test_large_landings_are_packed(spark, monkeypatch):
    wh, paths = Warehouse(spark, SF_SMALL), {}
    landed = Q.landed

    def seen(w, name, write):
        paths[name] = landed(w, name, write)
        return paths[name]

    monkeypatch.setattr(Q, "landed", seen)
    docs = Q._landed_xml(wh)
    assert all(".gz" in f for f in _names(paths["comptes_rendus_xml"]))
    plain = Q.discharge_documents(wh).select("admission_id", "patient_id", "date_sortie", F.col("diagnostic_principal._VALUE"))
    assert rows(docs.select(*plain.columns[:3], F.col("diagnostic_principal._VALUE"))) == rows(plain)
    fact = Q.fact_admissions_from_csv(wh)
    for name in ("admissions_csv", "sorties_csv"):
        assert all(f.endswith(".csv.gz") for f in _names(paths[name]))
    want = wh.fact_admissions
    assert fact.count() == want.count()
    assert rows(fact.select(F.col("admission_id").cast("long"), "duree_sejour")) == rows(want.select("admission_id", "duree_sejour"))
