"""Line formats: properties and raw records in tab-separated text, and MediaWiki pages in XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path)


def parse_props(df: DataFrame, line: str = "value") -> DataFrame:
    """``id \\t name=value \\t ...`` to properties; pieces without a name and a value are skipped."""
    parts = df.select(F.split(line, "\t").alias("p")).select(F.element_at("p", 1).alias("id"), F.posexplode(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0)))).alias("pos", "x"))
    at = F.instr("x", "=")
    ok = parts.where((at > 1) & (at < F.length("x")))
    return ok.select("id", "pos", F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.expr("substring(x, 1, instr(x, '=') - 1)").alias("name"), F.expr("substring(x, instr(x, '=') + 1)").alias("value"))


def parse_raw(df: DataFrame, line: str = "value") -> DataFrame:
    """``id \\t type \\t text`` to (id, raw map<string,string>, kind); the type is also a property of the record."""
    p = F.split(line, "\t", 3)
    return df.where(F.size(p) == 3).select(p[0].alias("id"), F.create_map(p[1], p[2]).alias("raw"), p[1].alias("kind"))


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, text) of each <page> of a MediaWiki dump, compressed or not."""
    schema = "id long, title string, revision struct<text:string>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    return pages.select(F.col("id").cast("string").alias("id"), "title", F.col("revision.text").alias("text"))


def wiki_props(pages: DataFrame) -> DataFrame:
    """Properties title, link and category of wiki pages."""
    from propweave.functions import wiki_links

    links = pages.select("id", F.posexplode(wiki_links(F.col("text"))).alias("k", "value"))
    named = links.withColumn("name", F.when(F.col("value").rlike(r"^(Category|Kategorie):"), "category").otherwise("link"))
    out = named.select("id", (F.col("k") + 1).alias("pos"), "name", F.regexp_replace("value", r"^(Category|Kategorie):", "").alias("value"))
    out = pages.select("id", F.lit(0).alias("pos"), F.lit("title").alias("name"), F.col("title").alias("value")).unionByName(out)
    return out.select("id", "pos", F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), "name", "value")


def template_fields(text: Column, template: str) -> Column:
    """map<string,string> of the fields ``|name=value`` of the first ``{{template ...}}`` in wiki text."""
    body = F.regexp_extract(text, r"(?s)\{\{\s*" + template + r"\s*\|([^{}]*)\}\}", 1)
    pairs = F.filter(F.split(body, r"\|"), lambda x: x.rlike(r"^\s*[^=\s][^=]*=\s*\S"))
    named = F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("name"), F.trim(F.regexp_replace(x, r"(?s)^[^=]*=\s*|\s+$", "")).alias("value")))
    return F.map_from_entries(F.array_distinct(F.filter(named, lambda x: x["value"] != "")))


def template_props(pages: DataFrame, template: str, prefix: str) -> DataFrame:
    """Properties ``prefix.name`` from a template's fields; ``Personendaten`` has metadata, ``Normdaten`` authority data."""
    rows = pages.select("id", F.explode(template_fields(F.col("text"), template)).alias("name", "value"))
    return rows.select("id", F.lit(0).alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.concat(F.lit(prefix + "."), F.lower("name")).alias("name"), "value")
