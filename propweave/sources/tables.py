"""Table scans: whole, several at once, ranges and points.  Filters and columns reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, *paths: str) -> DataFrame:
    """All rows of all tables; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def scan_list(spark: SparkSession, names: str, base: str) -> DataFrame:
    """The tables of a comma-separated list."""
    found = [n.strip() for n in names.split(",") if n.strip()]
    if not found:
        raise ValueError("no table is named")
    return scan(spark, *[f"{base}/{n}.parquet" for n in found])


def range_scan(df: DataFrame, key: str, start=None, stop=None) -> DataFrame:
    """Rows with start <= key < stop."""
    if start is not None:
        df = df.where(F.col(key) >= F.lit(start))
    return df if stop is None else df.where(F.col(key) < F.lit(stop))


def point_get(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def lookup_file(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated file of two columns: key, value."""
    return spark.read.csv(path, sep="\t", schema="key string, value string", quote="")


def upsert(spark: SparkSession, stored: DataFrame | None, new: DataFrame) -> DataFrame:
    """Properties of a table after an ingest: the union of both, each once."""
    from propweave.model import as_table

    return as_table(new if stored is None else stored.unionByName(new))


def store(spark: SparkSession, path: str, new: DataFrame) -> int:
    """Bring properties into the stored table at path (made if it isn't there) and give the number of its properties.

    The union is written beside the table and takes its place by a rename, so that a run that fails leaves the old one."""
    jvm = spark.sparkContext._jvm
    here, beside, before = (jvm.org.apache.hadoop.fs.Path(path + x) for x in ("", ".next", ".before"))
    files = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(here) and files.exists(before):  # a run ended between the two renames
        files.rename(before, here)
    stored = spark.read.parquet(path) if files.exists(here) else None
    upsert(spark, stored, new).write.mode("overwrite").parquet(path + ".next")
    files.delete(before, True)
    if stored is not None:
        files.rename(here, before)
    files.rename(beside, here)
    files.delete(before, True)
    return spark.read.parquet(path).count()
