"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# White space that separates words, as a Java / RE2 character class
SPACES = r"[\x20\x09-\x0D]+"


def text_of(name: str) -> Column:
    """The text column; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    """A column name that may hold dots, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text: its maximal runs of non-space characters."""
    return F.array_remove(F.split(text, SPACES, -1), "")


def count_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor later costs a re-read of these files.
    Shuffle files of the finished write go when the driver's handles on them are
    collected, so both collectors are asked to run.  Spark's listener threads hold
    the last query they were told of, plan and shuffles included, so they are told
    of a small one first.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _collect(spark)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_at = path
    return back


def _collect(spark: SparkSession) -> None:
    spark.sql("SELECT 1").collect()
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete a table of ``written`` that later steps, written themselves, no longer need."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
