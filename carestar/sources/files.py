"""File sources: delimited text, JSON envelopes, XML documents, staff sheets.

Every reader takes an explicit schema (no inference pass over the data) and
returns a lazily planned DataFrame; all are splittable parallel scans except
multi-line JSON (one task per file — prefer JSON Lines at scale, which the
same reader accepts with ``multi_line=False``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_header, ntz


def _lineage(df: DataFrame, source: str | None, loaded_at) -> DataFrame:
    src = F.lit(source) if source is not None else F.col("_metadata.file_name")
    ts = F.current_timestamp() if loaded_at is None else ntz(loaded_at)
    return df.withColumn("source_file", src).withColumn("loaded_at", ts)


def read_csv_all_string(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                        keys: Sequence[str] = (), source: str | None = None,
                        loaded_at: dt.datetime | None = None, sep: str = ",", multi_line: bool = True,
                        header_blank: str = " ") -> DataFrame:
    """Delimited file(s) -> all-string frame with clean headers, rows with a NULL
    key dropped, lineage stamped (``source_file``, ``loaded_at``).

    Names come from the header line (strip + lower, inner blanks to
    ``header_blank``).  ``columns`` selects and orders them by name, wherever
    they stand in the file; a name that the header lacks is an error.  A file
    whose header differs from the first one's fails the read.  Quotes inside a
    quoted field are doubled, and a quoted field may hold line breaks; a producer
    that writes none can be read with ``multi_line=False``, which splits large files.
    """
    reader = (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    # the first line only; every file's header is then checked against it
    found = reader.option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found])
    df = reader.schema(schema).option("enforceSchema", False).csv(path)
    df = df.toDF(*[clean_header(c, header_blank) for c in found])
    if columns is not None:
        wanted = [clean_header(c, header_blank) for c in columns]
        if missing := [c for c in wanted if c not in df.columns]:
            raise ValueError(f"{path}: no column {missing} in the header {df.columns}")
        df = df.select(*[f"`{c}`" for c in wanted])
    if keys:
        df = df.na.drop(subset=list(keys))
    return _lineage(df, source, loaded_at)


# Rows of one compressed file at most: it is read by one task
PACKED_ROWS = 500_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Header CSV that keeps surrounding blanks and tells NULL from empty text.

    With a ``compression`` files hold at most ``PACKED_ROWS`` rows; readers tell it by the file name.
    """
    (_packed(df, compression).mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("quote", '"').option("escape", '"').csv(path))


def _packed(df: DataFrame, compression: str) -> DataFrameWriter:
    rows = 0 if compression == "none" else PACKED_ROWS
    return df.write.option("compression", compression).option("maxRecordsPerFile", rows)


def envelope_schema(record: T.StructType) -> T.StructType:
    """An envelope ``{…, data: [record]}`` or a bare record (element of a list);
    envelope metadata (``source``, ``count``…) is not needed to read the records."""
    return T.StructType([T.StructField("data", T.ArrayType(record)), *record.fields])


def read_json_envelope(spark: SparkSession, path: str, record: T.StructType, bool_to_int: Sequence[str] = (),
                       multi_line: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """JSON documents that are either envelopes ``{…, data: [records]}`` or bare
    lists of records -> one row per record; listed boolean fields -> 0/1 int.

    A malformed document fails the read, so none is lost unseen; with ``mode``
    DROPMALFORMED it is left out.  The source is scanned once.
    """
    raw = (spark.read.schema(envelope_schema(record)).option("multiLine", multi_line).option("mode", mode)
           .json(path))
    names = [f.name for f in record.fields]
    filled = F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    out = raw.select(F.inline(F.coalesce("data", F.when(filled, F.array(F.struct(*names))))))
    for c in bool_to_int:
        out = out.withColumn(c, F.col(c).cast("int"))
    return out


def write_json_envelopes(records: DataFrame, path: str, per_envelope: int = 500, meta: dict | None = None,
                         count_field: str = "nb_records", bools: Sequence[str] = ()) -> None:
    """Land records as JSON Lines envelopes of at most ``per_envelope`` records.

    An envelope is one row, so its size must not grow with the data: records
    are bucketed by their row position inside their input partition
    (``monotonically_increasing_id``), which bounds every envelope by
    construction whatever the values (a key repeated on a third of the rows
    still spreads over many envelopes).
    """
    rec = records
    for c in bools:
        rec = rec.withColumn(c, F.col(c).cast("boolean"))
    cols = rec.columns
    bucket = F.floor(F.monotonically_increasing_id() / F.lit(per_envelope))
    env = (rec.withColumn("__b", bucket).groupBy("__b")
           .agg(F.count(F.lit(1)).alias(count_field), F.collect_list(F.struct(*cols)).alias("data")))
    extra = [F.lit(v).alias(k) for k, v in (meta or {}).items()]
    env.select(*extra, count_field, "data").write.mode("overwrite").json(path)


# --- XML discharge summaries ------------------------------------------------

CODED = T.StructType([T.StructField("_code_cim10", T.StringType()), T.StructField("_VALUE", T.StringType())])
ACT = T.StructType([T.StructField("_code", T.StringType()), T.StructField("_VALUE", T.StringType())])
DISCHARGE_XML_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("admission_id", T.StringType()),
    T.StructField("patient_id", T.StringType()),
    T.StructField("date_admission", T.StringType()),
    T.StructField("date_sortie", T.StringType()),
    T.StructField("duree_sejour", T.StringType()),
    T.StructField("diagnostic_principal", CODED),
    T.StructField("diagnostics_secondaires", T.StructType([T.StructField("diagnostic", T.ArrayType(CODED))])),
    T.StructField("actes_medicaux", T.StructType([T.StructField("acte", T.ArrayType(ACT))])),
    T.StructField("medecin_responsable", T.StringType()),
    T.StructField("mode_entree", T.StringType()),
    T.StructField("mode_sortie", T.StringType()),
    T.StructField("hopital_id", T.StringType()),
    T.StructField("observations", T.StructType([T.StructField("texte", T.StringType())])),
])


def read_discharge_xml(spark: SparkSession, path: str, row_tag: str = "compte_rendu") -> DataFrame:
    """Discharge summaries, one row per ``<compte_rendu>``; the schema is explicit
    (inference misplaces children when a sibling list is self-closed)."""
    return (spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
            .schema(DISCHARGE_XML_SCHEMA).load(path))


def _trim(c: Column) -> Column:
    return F.trim(c)


def flatten_summaries(docs: DataFrame) -> DataFrame:
    """One row per document: attributes and texts trimmed, secondary diagnoses
    as ``code:label`` joined by ``|`` (empty text when none), number of acts."""
    sec = F.col("diagnostics_secondaires.diagnostic")
    acts = F.col("actes_medicaux.acte")
    joined = F.array_join(F.transform(sec, lambda d: F.concat(F.trim(d["_code_cim10"]), F.lit(":"), F.trim(d["_VALUE"]))), "|")
    return docs.select(
        _trim(F.col("_id")).alias("cr_id"),
        _trim(F.col("admission_id")).alias("admission_id"),
        _trim(F.col("patient_id")).alias("patient_id"),
        _trim(F.col("date_admission")).alias("date_admission"),
        _trim(F.col("date_sortie")).alias("date_sortie"),
        _trim(F.col("duree_sejour")).alias("duree_sejour"),
        _trim(F.col("diagnostic_principal._code_cim10")).alias("code_cim10_principal"),
        _trim(F.col("diagnostic_principal._VALUE")).alias("diagnostic_principal"),
        F.coalesce(joined, F.lit("")).alias("diagnostics_secondaires"),
        F.when(acts.isNull(), F.lit(0)).otherwise(F.size(acts)).alias("nb_actes"),
        _trim(F.col("medecin_responsable")).alias("medecin_responsable"),
        _trim(F.col("mode_entree")).alias("mode_entree"),
        _trim(F.col("mode_sortie")).alias("mode_sortie"),
        _trim(F.col("hopital_id")).alias("hopital_id"),
        _trim(F.col("observations.texte")).alias("observations"),
    )


def explode_acts(docs: DataFrame) -> DataFrame:
    """Child table ``(cr_id, code_acte, libelle_acte)``, one row per act."""
    return (docs.select(F.trim(F.col("_id")).alias("cr_id"), F.explode("actes_medicaux.acte").alias("a"))
            .select("cr_id", F.trim(F.col("a._code")).alias("code_acte"), F.trim(F.col("a._VALUE")).alias("libelle_acte")))


def write_discharge_xml(docs: DataFrame, path: str, compression: str = "none") -> None:
    (_packed(docs, compression).mode("overwrite").format("xml").option("rowTag", "compte_rendu")
     .option("rootTag", "comptes_rendus").save(path))


# --- staff sheets ---------------------------------------------------------------

def union_staff(doctors: DataFrame, nurses: DataFrame) -> DataFrame:
    """Doctors and nurses (different columns) in one table tagged ``type_personnel``."""
    return (doctors.withColumn("type_personnel", F.lit("Médecin"))
            .unionByName(nurses.withColumn("type_personnel", F.lit("Infirmier")), allowMissingColumns=True))
