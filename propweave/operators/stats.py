"""Counting and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propweave.functions import prefixes


def count_properties(props: DataFrame) -> DataFrame:
    """(key, name, value, n) for each name and value; key is both without a separator."""
    return props.groupBy("name", "value").agg(F.count("*").alias("n")).select(F.concat("name", "value").alias("key"), "name", "value", "n")


def count_codes(codes: DataFrame, code: str = "code") -> DataFrame:
    """(prefix, n): each code counted at every length."""
    return codes.select(F.explode(prefixes(F.col(code))).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, *keys: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def report(counts: DataFrame, n: str = "n") -> DataFrame:
    """Largest counts first."""
    return counts.orderBy(F.desc(n), *[c for c in counts.columns if c != n])


def uniform_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), drawn uniformly."""
    return df.orderBy(F.rand(seed)).limit(n)
