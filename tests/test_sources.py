"""Readers and writers: CSV, JSON envelopes, XML, staff union, incremental, reloads."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.session import local_path
from carestar.sinks import writers as K
from carestar.sources import files as S
from carestar.sources import incremental as I


def _write_text(path, name, text):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_headers_keys_and_lineage(spark, tmp_dir):
    d = tmp_dir("csv")
    _write_text(d, "patients.csv", " Patient_ID ,NOM, Age\nP1,A,45\n,B,30\nP3,,\n")
    df = S.read_csv_all_string(spark, d, keys=["patient_id"], source="patients.csv",
                               loaded_at=dt.datetime(2024, 1, 1))
    assert df.columns == ["patient_id", "nom", "age", "source_file", "loaded_at"]
    got = sorted((r["patient_id"], r["nom"], r["age"]) for r in df.collect())
    assert got == [("P1", "A", "45"), ("P3", None, None)]
    assert {r["source_file"] for r in df.collect()} == {"patients.csv"}


def test_csv_file_name_lineage(spark, tmp_dir):
    d = tmp_dir("csv2")
    _write_text(d, "a.csv", "id\n1\n")
    _write_text(d, "b.csv", "id\n2\n")
    got = sorted((r["id"], r["source_file"]) for r in S.read_csv_all_string(spark, d).collect())
    assert got == [("1", "a.csv"), ("2", "b.csv")]


REC = T.StructType([T.StructField("id", T.LongType()), T.StructField("ok", T.BooleanType())])


def test_json_envelope_and_bare_list(spark, tmp_dir):
    d = tmp_dir("json")
    _write_text(d, "env.json", '{"source": "x", "nb_records": 2, "data": [{"id": 1, "ok": true}, {"id": 2, "ok": false}]}')
    _write_text(d, "bare.json", '[{"id": 3, "ok": true}, {"id": 4}]')
    got = sorted(tuple(r) for r in S.read_json_envelope(spark, d, REC, bool_to_int=["ok"]).collect())
    assert got == [(1, 1), (2, 0), (3, 1), (4, None)]


XML = """<?xml version="1.0" encoding="UTF-8"?>
<comptes_rendus xmlns="http://example.org/cr">
  <compte_rendu id="CR1">
    <admission_id> A1 </admission_id><patient_id>P1</patient_id>
    <diagnostic_principal code_cim10="J10">Grippe</diagnostic_principal>
    <diagnostics_secondaires/>
    <actes_medicaux><acte code="X1">Radio</acte><acte code="X2">Scanner</acte></actes_medicaux>
    <observations><texte>  ok  </texte></observations>
  </compte_rendu>
  <compte_rendu id="CR2">
    <admission_id>A2</admission_id>
    <diagnostic_principal code_cim10="E11">Diabete</diagnostic_principal>
    <diagnostics_secondaires><diagnostic code_cim10="I10">HTA</diagnostic><diagnostic code_cim10="E78">Lipides</diagnostic></diagnostics_secondaires>
  </compte_rendu>
</comptes_rendus>
"""


def test_xml_self_closed_list_and_no_acts(spark, tmp_dir):
    d = tmp_dir("xml")
    _write_text(d, "cr.xml", XML)
    docs = S.read_discharge_xml(spark, d)
    flat = {r["cr_id"]: r for r in S.flatten_summaries(docs).collect()}
    assert flat["CR1"]["admission_id"] == "A1" and flat["CR1"]["code_cim10_principal"] == "J10"
    assert flat["CR1"]["diagnostics_secondaires"] == "" and flat["CR1"]["nb_actes"] == 2
    assert flat["CR2"]["diagnostics_secondaires"] == "I10:HTA|E78:Lipides" and flat["CR2"]["nb_actes"] == 0
    assert flat["CR1"]["observations"] == "ok"
    acts = sorted(tuple(r) for r in S.explode_acts(docs).collect())
    assert acts == [("CR1", "X1", "Radio"), ("CR1", "X2", "Scanner")]


def test_staff_union_allows_missing_columns(spark):
    doc = spark.createDataFrame([("M1", "Dupont", "Cardio")], "medecin_id string, nom string, specialite string")
    nur = spark.createDataFrame([("I1", "Martin", "Nuit")], "infirmier_id string, nom string, horaire string")
    got = {r["type_personnel"]: r for r in S.union_staff(doc, nur).collect()}
    assert got["Médecin"]["horaire"] is None and got["Infirmier"]["specialite"] is None


def test_incremental_mark_and_upsert(spark, tmp_dir):
    t = lambda d: dt.datetime(2024, 1, d)
    src = spark.createDataFrame([(1, "a", t(1)), (2, "b", t(2)), (1, "a2", t(3)), (3, "c", t(4))],
                                "id int, v string, updated_at timestamp")
    target = src.filter(F.col("updated_at") <= t(2))
    mark = I.high_water_mark(target)
    delta = I.extract_incremental(src, mark)
    assert sorted(r["id"] for r in delta.collect()) == [1, 3]
    merged = sorted((r["id"], r["v"]) for r in I.upsert(target, delta, ["id"]).collect())
    assert merged == [(1, "a2"), (2, "b"), (3, "c")]
    assert I.high_water_mark(None, as_of=t(10), lookback_hours=24) == t(9)


def test_reload_by_source_is_idempotent(spark, tmp_dir):
    p = tmp_dir("reload")
    df = spark.createDataFrame([(1, "a.csv"), (2, "a.csv"), (3, "b.csv")], "id int, source_file string")
    K.reload_by_source(df, p)
    K.reload_by_source(df.filter(F.col("source_file") == "a.csv"), p)   # same file landed twice
    K.reload_by_source(df.filter(F.col("source_file") == "a.csv"), p)
    assert spark.read.parquet(p).count() == 3


def test_reload_of_an_empty_source_drops_its_rows(spark, tmp_dir):
    p = tmp_dir("reload-empty")
    df = spark.createDataFrame([(1, "a b.csv"), (2, "a b.csv"), (3, "b.csv")], "id int, source_file string")
    K.reload_by_source(df, p)
    K.reload_by_source(df.limit(0), p, sources=["a b.csv"])
    assert [r["id"] for r in spark.read.parquet(p).collect()] == [3]


def test_malformed_json_is_not_lost_unseen(spark, tmp_dir):
    d = tmp_dir("json-bad")
    _write_text(d, "a.json", '{"data": [{"id": 1, "ok": true}]}\n{"data": [{"id"\n{"id": 3, "ok": true}\n{"data": null}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        S.read_json_envelope(spark, d, REC, multi_line=False).collect()
    kept = S.read_json_envelope(spark, d, REC, multi_line=False, mode="DROPMALFORMED")
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]


def test_headers_with_inner_blanks(spark, tmp_dir):
    d = tmp_dir("sheet")
    _write_text(d, "s.csv", " Medecin ID ,Nom\nM1,A\n")
    assert S.read_csv_all_string(spark, d, header_blank="_").columns[:2] == ["medecin_id", "nom"]


def test_emergencies_read_urgency_as_admissions_do(spark):
    from carestar.operators import facts
    adm = spark.createDataFrame([(1, 1, "2024-01-01", "1.0", 1), (2, 1, "2024-01-01", "0", 1)],
                                "admission_id int, patient_id int, date_admission string, urgence string, hopital_id int")
    days = spark.sql("SELECT 1 AS temps_id, DATE '2024-01-01' AS date")
    assert [r["urgence_id"] for r in facts.fact_emergency(adm, days).collect()] == ["URG-1"]


def test_table_counts_tolerates_missing(spark, tmp_dir):
    p = tmp_dir("t")
    spark.range(5).write.parquet(p)
    got = {r["table_name"]: r["n_rows"] for r in I.table_counts(spark, {"a": p, "b": p + "-absent"}).collect()}
    assert got == {"a": 5, "b": None}


def test_export_keeps_texts_whole_and_casts_bools(spark, tmp_dir):
    df = spark.createDataFrame([("x" * 40000, True)], "s string, b boolean")
    man = K.export_tables(spark, {"t": df, "empty": df.limit(0)}, tmp_dir("exp"))
    assert [(r["table_name"], r["n_rows"]) for r in man.collect()] == [("t", 1)]
    r = K.for_export(df).collect()[0]
    assert len(r["s"]) == 40000 and r["b"] == 1


def test_run_log_latest(spark, tmp_dir):
    p = tmp_dir("log")
    ev = spark.createDataFrame(
        [("r1", "d", "t", dt.datetime(2024, 1, 1, 6), "RUNNING", None, None, None),
         ("r1", "d", "t", dt.datetime(2024, 1, 1, 7), "SUCCESS", 10, None, None)],
        "run_id string, dag_name string, task_name string, event_time timestamp, status string, records bigint, "
        "error string, source string")
    K.log_events(ev, p)
    r = K.latest_runs(spark.read.parquet(p)).collect()
    assert [(x["status"], x["records"]) for x in r] == [("SUCCESS", 10)]


def test_input_reads_follow_the_files(spark, tmp_dir):
    """Driver tables are resolved once per session while unchanged; a rewritten
    input gets a fresh read."""
    from carestar.sources import binding as B
    d = tmp_dir("inputs")
    spark.range(3).withColumnRenamed("id", "r_regionkey").write.parquet(f"{d}/region.parquet")
    first = B.read(spark, d, "region")
    assert B.read(spark, d, "region") is first
    spark.range(5).withColumnRenamed("id", "r_regionkey").write.mode("overwrite").parquet(f"{d}/region.parquet")
    again = B.read(spark, d, "region")
    assert again is not first
    assert again.count() == 5


def test_build_tables_resolved_once(spark):
    from carestar.plans.build import warehouse_for
    a = warehouse_for(spark, "/root/testdata/sf0.001")
    b = warehouse_for(spark, "/root/testdata/sf0.001")
    assert a.fact_admissions is b.fact_admissions
    assert a.dim_date is b.dim_date


def test_csv_keeps_doubled_quotes_and_separators(spark, tmp_dir):
    p = tmp_dir("quoted")
    spark.createDataFrame([('id,t',), ('1,"say ""hi"", ok"',)], "value string").coalesce(1).write.text(p)
    assert [(r["id"], r["t"]) for r in S.read_csv_all_string(spark, p).collect()] == [("1", 'say "hi", ok')]
    out = tmp_dir("lines")
    S.write_csv(spark.createDataFrame([("1", 'a\nb "c", d')], "id string, t string"), out)
    assert [r["t"] for r in S.read_csv_all_string(spark, out, multi_line=True).collect()] == ['a\nb "c", d']


def test_table_counts_does_not_hide_unreadable_tables(spark, tmp_dir):
    p = tmp_dir("broken")
    spark.createDataFrame([("not parquet",)], "value string").write.text(p)
    with pytest.raises(Exception):
        I.table_counts(spark, {"a": p + "/*"}).collect()


def test_csv_line_breaks_and_header_by_name(spark, tmp_dir):
    out = tmp_dir("csv")
    S.write_csv(spark.createDataFrame([("1", "a\nb"), ("2", "c")], "id string, t string"), out)
    assert sorted((r["id"], r["t"]) for r in S.read_csv_all_string(spark, out).collect()) == [("1", "a\nb"), ("2", "c")]
    swapped = tmp_dir("swapped")
    S.write_csv(spark.createDataFrame([("x", "1")], "T string, ` Id ` string"), swapped)
    got = S.read_csv_all_string(spark, swapped, columns=["id", "t"], keys=["id"])
    assert [(r["id"], r["t"]) for r in got.collect()] == [("1", "x")]
    with pytest.raises(ValueError):
        S.read_csv_all_string(spark, swapped, columns=["id", "absent"])
    # a second file with another header fails the read instead of swapping values
    S.write_csv(spark.createDataFrame([("2", "y")], "` Id ` string, T string"), swapped, mode="append")
    with pytest.raises(Exception):
        S.read_csv_all_string(spark, swapped, columns=["id", "t"]).collect()


def test_export_counts_while_writing(spark, tmp_dir):
    from carestar.sinks.writers import export_tables
    path = tmp_dir("export")
    some, none = spark.range(5).withColumn("b", F.lit(True)), spark.range(0)
    got = export_tables(spark, {"t": some, "vide": none, "u": spark.range(2)}, path)
    assert sorted((r.table_name, r.n_rows, r.nb_tables, r.total_lignes) for r in got.collect()) == [("t", 5, 2, 7), ("u", 2, 2, 7)]
    assert spark.read.parquet(f"{path}/t").filter("b = 1").count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(f"{path}/vide").count()
    assert export_tables(spark, {"vide": none}, tmp_dir("export2")).isEmpty()
