"""Joins by re-keying properties, anti and semi filters, conflict checks, reference counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A property of this form goes to another record: {to:ID}name.
TO = r"^\{to:([^}]+)\}(.*)$"


def apply_redirects(props: DataFrame) -> DataFrame:
    """Re-keys the properties named {to:ID}name; one projection, the shuffle is the next operator's."""
    to = F.col("name").rlike(TO)
    return props.withColumn("id", F.when(to, F.regexp_extract("name", TO, 1)).otherwise(F.col("id"))).withColumn("name", F.when(to, F.regexp_extract("name", TO, 2)).otherwise(F.col("name")))


def rekey(props: DataFrame, key_name: str) -> DataFrame:
    """Each record's properties under each value of one of its properties; records without it go."""
    keys = props.where(F.col("name") == key_name).select("id", F.col("value").alias("key")).distinct()
    return props.join(keys, "id").select(F.col("key").alias("id"), *[c for c in props.columns if c != "id"])


def rekey_join(props: DataFrame, program_a: Callable[[DataFrame], DataFrame], program_b: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Program A, then properties to their new records, then program B over what met there."""
    moved = apply_redirects(program_a(props))
    return program_b(moved) if program_b else moved


def conflicts(props: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, name, values): properties with more than one value among the records of a key; keys is (id, key).

    Different values are gathered before the one shuffle by key and name, so a hot key is a few short sets."""
    rows = props.select("id", "name", "value").join(keys.select("id", "key").distinct(), "id")
    return rows.groupBy("key", "name").agg(F.array_sort(F.collect_set("value")).alias("values")).where(F.size("values") > 1)


def reference_counts(references: DataFrame, valid: DataFrame, all_name: str = "all") -> DataFrame:
    """(target, type, n): references to valid targets by type, and their sum under all_name."""
    counted = references.select("target", "type").join(valid.select("target").distinct(), "target", "left_semi").groupBy("target", "type").agg(F.count("*").alias("n"))
    return counted.rollup("target", "type").agg(F.sum("n").alias("n"), F.grouping_id().alias("g")).where("g < 3").select("target", F.when(F.col("g") == 1, all_name).otherwise(F.col("type")).alias("type"), "n")


def subtotals(rows: DataFrame, key: str, all_name: str = "ALL") -> DataFrame:
    """(key, name, n): counts by key, and over all keys under all_name."""
    out = rows.groupBy(key, "name").agg(F.count("*").alias("n"))
    return out.unionByName(out.groupBy("name").agg(F.sum("n").alias("n")).select(F.lit(all_name).alias(key), "name", "n"))


def parent_to_child(records: DataFrame, part_of: Column, value: Column, record_id: Column) -> DataFrame:
    """(id, parent, value): a parent's value for each of its children."""
    parents = records.select(record_id.alias("parent"), value.alias("value"))
    return records.select(record_id.alias("id"), part_of.alias("parent")).where("parent is not null").join(parents, "parent").select("id", "parent", "value")


def without(records: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    return records.join(others, on, "left_anti")


def only_with(records: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    return records.join(others, on, "left_semi")


#: Rows of a lookup table that is broadcast at most; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def lookup_join(props: DataFrame, table: DataFrame, default: str | None = None) -> DataFrame:
    """Values replaced by those of a table (key, value; a key's smallest value counts); others get the default, or go
    where there is none."""
    one = table.where("key is not null").groupBy("key").agg(F.min("value").alias("found"))
    if one.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        one = F.broadcast(one)
    found = props.join(one, F.col("value") == F.col("key"), "left").withColumn("value", F.coalesce("found", F.lit(default)))
    return found.where("value is not null").select(*props.columns)


def transfer(props: DataFrame, members: DataFrame, names: list[str], least: int = 2) -> DataFrame:
    """(id, name, value): classifications brought together over bundles.  Records with at least `least` of the names give
    their values, as ``record:value``, to their bundle; members is (bundle_id, id)."""
    own = props.where(F.col("name").isin(names)).select("id", "name", "value").distinct()
    rich = own.groupBy("id").agg(F.count_distinct("name").alias("k")).where(F.col("k") >= least).select("id")
    given = own.join(rich, "id", "left_semi").join(members.select("bundle_id", "id"), "id")
    return given.select(F.col("bundle_id").alias("id"), "name", F.concat_ws(":", "id", "value").alias("value"))


def inherit(props: DataFrame, members: DataFrame, name: str, separator: str = ";") -> DataFrame:
    """(id, value): for each member of a bundle without the property, what the bundle's other members have, as
    ``record:value`` in order.  Three steps: properties to their bundles, once for each bundle; members that lack
    them; both joined on the bundle."""
    data = props.where(F.col("name") == name).select("id", "value").distinct()
    placed = members.select("bundle_id", "id").distinct().join(data, "id", "left")
    given = placed.where("value is not null").groupBy("bundle_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "id", "value"))), separator).alias("all"))
    return placed.where("value is null").join(given, "bundle_id").select("id", F.col("all").alias("value"))


def invalid(props: DataFrame, name: str, check: Callable[[Column], Column], error: str) -> DataFrame:
    """Properties ``exception`` for the values of a property that a check gives nothing for."""
    bad = props.where((F.col("name") == name) & F.col("value").isNotNull() & check(F.col("value")).isNull())
    return bad.withColumn("name", F.lit("exception")).withColumn("value", F.concat(F.lit(error + ": "), "value"))
