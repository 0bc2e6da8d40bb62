"""The record model: a record is a set of (name, value) properties, some of them in named groups.

Canonical form is the long table ``id, pos, ent_no, ent, name, value``: ``pos`` orders a record's
properties, ``ent``/``ent_no`` name and number the group a property belongs to (null outside groups).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COLUMNS = ["id", "pos", "ent_no", "ent", "name", "value"]
PROPS_SCHEMA = "id string, pos int, ent_no int, ent string, name string, value string"


def to_props(df: DataFrame, record_id: Column, columns: list[str]) -> DataFrame:
    """Columns of df as properties; null values are no properties.  One narrow pass, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    out = df.select(record_id.alias("id"), F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))
    return out.select("id", "pos", F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), "name", "value")


def to_entity_props(df: DataFrame, record_id: Column, entity: str, number: Column, columns: list[str]) -> DataFrame:
    """Columns of df as properties of one group instance of the record."""
    pairs = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    out = df.select(record_id.alias("id"), number.cast("int").alias("ent_no"), F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))
    return out.select("id", (F.col("ent_no") * len(columns) + F.col("k")).cast("int").alias("pos"), "ent_no", F.lit(entity).alias("ent"), "name", "value")


def path(marker: str = ".") -> Column:
    """A property's full name: group, marker, name."""
    return F.when(F.col("ent").isNotNull(), F.concat_ws(marker, "ent", "name")).otherwise(F.col("name"))


def record_arrays(props: DataFrame) -> DataFrame:
    """One row for each record: id, props array<struct<pos, ent_no, ent, name, value>> in order."""
    item = F.struct("pos", "ent_no", "ent", "name", "value")
    return props.groupBy("id").agg(F.array_sort(F.collect_list(item)).alias("props"))


def from_record_arrays(records: DataFrame) -> DataFrame:
    return records.select("id", F.inline("props")).select(*COLUMNS)


def as_table(props: DataFrame) -> DataFrame:
    """Set semantics of a stored table: equal properties of a record collapse, order is by name and value."""
    return props.groupBy("id", "ent_no", "ent", "name", "value").agg(F.min("pos").alias("pos")).select(*COLUMNS)


def qualifier_order(props: DataFrame) -> DataFrame:
    """pos as a stored table delivers it: grouped properties first, then by name and value."""
    w = Window.partitionBy("id").orderBy(F.col("ent").isNull(), "ent", "ent_no", "name", "value")
    return props.withColumn("pos", (F.row_number().over(w) - 1).cast("int")).select(*COLUMNS)


def multimap(props: DataFrame) -> DataFrame:
    """One row for each record: id, map from name to its values in order."""
    lists = props.groupBy("id", "name").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("values"))
    return lists.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "values")))).alias("props"))


def value_set(props: DataFrame) -> DataFrame:
    """id and the sorted set of all values of the record, names ignored."""
    return props.groupBy("id").agg(F.array_sort(F.collect_set("value")).alias("values"))


# Encoded records: fields end with U+001E, a name is parted from its value by U+001F, a literal starts with "-",
# a group is "<name" ... ">".
FIELD, SUB, LITERAL, OPEN, CLOSE = "\x1e", "\x1f", "-", "<", ">"


def encode_records(props: DataFrame) -> DataFrame:
    """id, line: each record in the encoded text form."""
    literal = lambda p: F.concat(F.lit(LITERAL), p["name"], F.lit(SUB), p["value"], F.lit(FIELD))
    flat = F.array_join(F.transform(F.filter("props", lambda p: p["ent"].isNull()), literal), "")
    inner = props.where("ent is not null").groupBy("id", "ent", "ent_no").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "value"))).alias("own"))
    text = F.concat(F.lit(OPEN), "ent", F.lit(FIELD), F.array_join(F.transform("own", literal), ""), F.lit(CLOSE + FIELD))
    groups = inner.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ent_no", text.alias("text")))), lambda x: x["text"]), "").alias("groups"))
    return record_arrays(props).join(groups, "id", "left").select("id", F.concat("id", F.lit(FIELD), F.coalesce("groups", F.lit("")), flat).alias("line"))


def decode_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """The long form of encoded records."""
    parts = lines.select(F.split(line, FIELD).alias("f")).select(F.element_at("f", 1).alias("id"), F.slice("f", 2, F.greatest(F.size("f") - 2, F.lit(0))).alias("f"))
    # a fold over the fields that carries the group open at each
    start = F.struct(F.lit(None).cast("string").alias("ent"), F.lit(0).alias("n"), F.array().cast("array<struct<ent:string,ent_no:int,name:string,value:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first, rest = F.substring(x, 1, 1), F.substring(x, 2, 1 << 30)
        item = F.struct(acc["ent"].alias("ent"), F.when(acc["ent"].isNotNull(), acc["n"]).alias("ent_no"), F.substring_index(rest, SUB, 1).alias("name"), F.expr("''").alias("value"))
        value = F.substring(rest, F.length(F.substring_index(rest, SUB, 1)) + 2, F.lit(1 << 30))
        item = F.struct(item["ent"].alias("ent"), item["ent_no"].alias("ent_no"), item["name"].alias("name"), value.alias("value"))
        opened = F.struct(rest.alias("ent"), (acc["n"] + 1).alias("n"), acc["out"].alias("out"))
        closed = F.struct(F.lit(None).cast("string").alias("ent"), acc["n"].alias("n"), acc["out"].alias("out"))
        more = F.struct(acc["ent"].alias("ent"), acc["n"].alias("n"), F.concat(acc["out"], F.array(item)).alias("out"))
        return F.when(first == OPEN, opened).when(first == CLOSE, closed).when(first == LITERAL, more).otherwise(acc)

    folded = parts.select("id", F.posexplode(F.aggregate("f", start, step)["out"]).alias("pos", "x"))
    return folded.select("id", "pos", "x.ent_no", "x.ent", "x.name", "x.value")
