"""Text sinks and reports; each has a structured form first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_lines(props: DataFrame, names: bool = True) -> DataFrame:
    """(id, line): ``id \\t \\t name=value...`` for each record, or its values alone."""
    one = F.when((F.col("name") == "") | F.lit(not names), F.col("value")).otherwise(F.concat("name", F.lit("="), "value"))
    items = F.array_sort(F.collect_list(F.struct("pos", one.alias("x"))))
    return props.groupBy("id").agg(F.concat(F.col("id"), F.lit("\t\t"), F.array_join(F.transform(items, lambda p: p["x"]), "\t")).alias("line"))


def write_lines(lines: DataFrame, path: str, line: str = "line") -> None:
    lines.select(F.col(line).alias("value")).write.mode("overwrite").text(path)


def beacon_lines(counts: DataFrame, target: str, header: dict[str, str] | None = None) -> DataFrame:
    """(type, k, value): for each type the header lines of a BEACON file, then ``target|n`` lines by target."""
    fixed = {"FORMAT": "PND-BEACON", "VERSION": "0.1", "TARGET": target} | (header or {})
    head = F.posexplode(F.array(*[F.lit(f"#{k}: {v}") for k, v in fixed.items()]))
    heads = counts.select("type").distinct().select("type", head.alias("k", "value")).select("type", F.col("k").cast("long").alias("k"), F.lit("").alias("by"), "value")
    body = counts.select("type", F.lit(len(fixed)).cast("long").alias("k"), F.col("target").alias("by"), F.concat_ws("|", "target", "n").alias("value"))
    return heads.unionByName(body)


def write_beacon(counts: DataFrame, path: str, target: str = "{ID}", header: dict[str, str] | None = None) -> None:
    """A folder for each type; its files, in the order of their names, are one BEACON file: the header, then lines."""
    lines = beacon_lines(counts, target, header).repartitionByRange("type", "k", "by").sortWithinPartitions("type", "k", "by")
    lines.select("value", "type").write.mode("overwrite").partitionBy("type").text(path)


def write_report(counts: DataFrame, path: str, n: str = "n") -> None:
    counts.orderBy(F.desc(n)).write.mode("overwrite").option("header", True).csv(path)


def write_index(index: DataFrame, path: str) -> None:
    index.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode("overwrite").partitionBy("field").parquet(path)
