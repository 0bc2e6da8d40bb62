"""Record-local programs over unbounded inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of text files as they arrive in a folder."""
    return spark.readStream.text(folder)


def apply(stream: DataFrame, program: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a program on each micro-batch; a batch that is run again gives the same output under the same number."""
    return stream.writeStream.foreachBatch(lambda batch, number: sink(program(batch), number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(stream: DataFrame, *keys: str) -> DataFrame:
    """Counts by key over all that has arrived."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A sink for apply(): each micro-batch replaces the folder of its number, so a batch that is run again leaves one copy."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
