"""Helpers that the corpus operators share: reading, words, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.plans.lineage import cut, new_path, shared_dir  # noqa: F401

#: What separates words: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of an Arrow batch sent to Python; texts may be long, so batches are small.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, and so a Python worker's memory.  The session's setting is only ever lowered,
    and to one value, so the order of calls doesn't matter to plans that run later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def words(text: Column | str) -> Column:
    """Words of a text as array<string>; null and blank texts have none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(col, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(n))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as keep it apart from df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
