"""Library exchange formats to properties and back: PICA+, MARC21 (ISO 2709 and XML) and MAB2.

PICA+ and MAB2 are split by Spark's own functions.  MARC21 has a directory of byte offsets and is decoded in an
Arrow-batched function.  A line that can't be decoded, or has no record id, becomes a record with a property
``error``, whose id is ``error:`` and the line's SHA-1; ingest() keeps and counts them.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

FIELD, SUB, RECORD = "\x1e", "\x1f", "\x1d"
_PROPERTY = StructType([StructField("pos", IntegerType()), StructField("ent_no", IntegerType()), *[StructField(c, StringType()) for c in ("ent", "name", "value")]])


def _subfields(rows: DataFrame) -> DataFrame:
    """(id, ent_no, ent, body) with subfields in body to properties."""
    parts = rows.select("id", "ent_no", "ent", F.posexplode(F.split("body", SUB)).alias("k", "x")).where("k > 0 and length(x) > 1")
    return parts.select("id", (F.col("ent_no") * 1000 + F.col("k")).cast("int").alias("pos"), "ent_no", "ent", F.substring("x", 1, 1).alias("name"), F.expr("substring(x, 2)").alias("value"))


def _error_id(line: Column) -> Column:
    return F.concat(F.lit("error:"), F.sha1(line))


def _no_id(df: DataFrame, record: Column, line: str) -> DataFrame:
    """An error property for each line without a record id."""
    bad = df.where(F.coalesce(F.length(F.trim(line)), F.lit(0)) > 0).where(record.isNull())
    return bad.select(_error_id(F.col(line)).alias("id"), F.lit(-2).alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.lit("error").alias("name"), F.lit("no record id").alias("value"))


def pica_id(line: str = "value") -> Column:
    return F.nullif(F.regexp_extract(line, f"(?:^|{FIELD})003@ [^{FIELD}]*?{SUB}0([^{SUB}{FIELD}]*)", 1), F.lit(""))


def decode_pica(df: DataFrame, line: str = "value") -> DataFrame:
    """Fields end with U+001E, subfields start with U+001F and a code; the id is 003@ $0."""
    fields = df.select(F.split(line, FIELD).alias("f"), F.coalesce(pica_id(line), _error_id(F.col(line))).alias("id"))
    rows = fields.select("id", F.posexplode("f").alias("ent_no", "x")).where("length(x) > 0")
    own = _subfields(rows.select("id", "ent_no", F.trim(F.substring_index("x", SUB, 1)).alias("ent"), F.col("x").alias("body")))
    return own.unionByName(_no_id(df, pica_id(line), line))


def mab2_id(line: str = "value") -> Column:
    body = F.expr(f"substring(regexp_replace({line}, '{RECORD}', ''), 25)")
    found = F.filter(F.split(body, FIELD), lambda x: F.trim(F.substring(x, 1, 4)) == "001")
    return F.when(F.length(line) > 24, F.substring(F.try_element_at(found, F.lit(1)), 5, 1 << 30))


def decode_mab2(df: DataFrame, line: str = "value") -> DataFrame:
    """A leader of 24 characters, then fields of a tag, an indicator and text; the id is field 001."""
    body = F.expr(f"substring(regexp_replace({line}, '{RECORD}', ''), 25)")
    head = F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.lit("leader").alias("name"), F.substring(F.col(line), 1, 24).alias("value"))
    fields = F.filter(F.split(body, FIELD), lambda x: F.length(x) > 4)
    items = F.transform(fields, lambda x, i: F.struct(i.cast("int").alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.trim(F.substring(x, 1, 4)).alias("name"), F.substring(x, 5, 1 << 30).alias("value")))
    record = F.coalesce(mab2_id(line), _error_id(F.col(line)))
    own = df.where(F.length(line) > 24).select(record.alias("id"), F.inline(F.concat(F.array(head), items)))
    return own.unionByName(_no_id(df, mab2_id(line), line))


def _marc(data: str) -> tuple[str | None, list]:
    raw = data.rstrip("\r\n").encode()
    try:
        base = int(raw[12:17])
        out, record = [(-1, None, None, "leader", raw[:24].decode())], None
        for n, s in enumerate(range(24, base - 1, 12)):
            tag, size, start = raw[s : s + 3].decode(), int(raw[s + 3 : s + 7]), int(raw[s + 7 : s + 12])
            field = raw[base + start : base + start + size].decode().rstrip(FIELD)
            if tag < "010":
                out.append((n * 1000, None, None, tag, field))
                record = field if tag == "001" else record
            else:
                head, *subs = field.split(SUB)
                out += [(n * 1000 + k + 1, n, tag + head, x[:1], x[1:]) for k, x in enumerate(subs) if len(x) > 1]
        if record is None:
            return _made_up(data), [*out, (-2, None, None, "error", "no record id")]
        return record, out
    except (ValueError, IndexError) as e:
        return _made_up(data), [(-2, None, None, "error", f"{type(e).__name__}: {e}")]


def _made_up(line: str) -> str:
    return "error:" + hashlib.sha1(line.encode()).hexdigest()


@F.pandas_udf(StructType([StructField("id", StringType()), StructField("props", ArrayType(_PROPERTY))]))
def _decode_marc(v: pd.Series) -> pd.DataFrame:
    rows = [_marc(x or "") for x in v]
    names = ("pos", "ent_no", "ent", "name", "value")
    return pd.DataFrame({"id": [r for r, _ in rows], "props": [[dict(zip(names, p)) for p in ps] for _, ps in rows]})


def decode_marc21(df: DataFrame, line: str = "value") -> DataFrame:
    """ISO 2709; groups are tag and indicators, the id is field 001."""
    return df.where(F.length(F.trim(line)) > 0).select(_decode_marc(F.col(line)).alias("r")).select("r.id", F.inline("r.props"))


def marc_xml(spark: SparkSession, path: str) -> DataFrame:
    """Properties of the <record> elements of a MARC21 XML file, compressed or not; the same shape as decode_marc21."""
    schema = "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, datafield array<struct<_ind1:string,_ind2:string,_tag:string,subfield:array<struct<_VALUE:string,_code:string>>>>"
    rows = spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", True).option("ignoreSurroundingSpaces", False).schema(schema).load(path)
    rows = rows.withColumn("id", F.try_element_at(F.filter("controlfield", lambda x: x["_tag"] == "001"), F.lit(1))["_VALUE"])
    none, item = F.lit(None).cast("int"), lambda pos, no, ent, name, value: F.struct(pos.cast("int").alias("pos"), no.cast("int").alias("ent_no"), ent.cast("string").alias("ent"), name.alias("name"), value.alias("value"))
    head = F.array(item(F.lit(-1), none, F.lit(None), F.lit("leader"), F.col("leader")))
    control = F.transform(F.coalesce("controlfield", F.array()), lambda x, i: item(i * 1000, none, F.lit(None), x["_tag"], x["_VALUE"]))
    first = F.size(F.coalesce("controlfield", F.array()))
    data = F.transform(F.coalesce("datafield", F.array()), lambda x, i: F.transform(x["subfield"], lambda y, k: item((first + i) * 1000 + k + 1, first + i, F.concat(x["_tag"], x["_ind1"], x["_ind2"]), y["_code"], y["_VALUE"])))
    every = F.concat(head, control, F.flatten(data))
    return rows.where("id is not null").select("id", F.inline(F.filter(every, lambda p: p["value"].isNotNull() & (p["value"] != ""))))


def csv_props(spark: SparkSession, path: str, key: str, separator: str = ",") -> DataFrame:
    """Properties of the rows of a CSV file with a header; the column `key` is the record id."""
    from propweave.model import to_props

    rows = spark.read.csv(path, header=True, sep=separator)
    return to_props(rows.where(F.col(key).isNotNull()), F.col(key), [c for c in rows.columns if c != key])


def _fields(df: DataFrame, record: Column, columns: dict[str, str], one) -> DataFrame:
    """(id, fields): the text of each column's field that isn't null."""
    made = F.array(*[F.when(F.col(c).isNotNull(), one(tag, F.col(c).cast("string"))) for tag, c in columns.items()])
    return df.select(record.cast("string").alias("id"), F.filter(made, lambda x: x.isNotNull()).alias("fields"))


def encode_pica(df: DataFrame, record: Column, columns: dict[str, str]) -> DataFrame:
    """(value): PICA+ lines; columns maps ``tag$code`` to a column."""
    one = lambda tag, v: F.concat(F.lit(tag.split("$")[0] + " " + SUB + tag.split("$")[1]), v)
    rows = _fields(df, record, columns, one)
    return rows.select(F.concat(F.lit(f"003@ {SUB}0"), "id", F.lit(FIELD), F.array_join("fields", FIELD), F.lit(FIELD)).alias("value"))


def encode_mab2(df: DataFrame, record: Column, columns: dict[str, str], leader: str = "00000nM2.01000024      h") -> DataFrame:
    """(value): MAB2 lines; columns maps tags of three characters to columns."""
    rows = _fields(df, record, columns, lambda tag, v: F.concat(F.lit(f"{tag} "), v))
    return rows.select(F.concat(F.lit(leader.ljust(24)[:24] + "001 "), "id", F.lit(FIELD), F.array_join("fields", FIELD), F.lit(FIELD + RECORD)).alias("value"))


def encode_marc21(df: DataFrame, record: Column, columns: dict[str, str]) -> DataFrame:
    """(value): ISO 2709 lines; columns maps ``tag$code`` to a column.  Offsets are bytes of UTF-8."""
    one = lambda tag, v: F.concat(F.lit("  " + SUB + tag.split("$")[1]), v)
    made = F.array(F.struct(F.lit("001").alias("tag"), record.cast("string").alias("body")), *[F.struct(F.lit(t.split("$")[0]).alias("tag"), one(t, F.col(c).cast("string")).alias("body")) for t, c in columns.items()])
    rows = df.select(F.filter(made, lambda x: x["body"].isNotNull()).alias("f"))
    size = lambda x: F.octet_length(x["body"]) + 1
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    entry = lambda acc, x: F.concat(acc["text"], x["tag"], F.lpad(size(x).cast("string"), 4, "0"), F.lpad(acc["at"].cast("string"), 5, "0"))
    rows = rows.select("f", F.aggregate("f", start, lambda acc, x: F.struct((acc["at"] + size(x)).alias("at"), entry(acc, x).alias("text"))).alias("d"))
    base = F.lit(25) + F.octet_length("d.text")
    total = base + F.col("d.at") + 1
    body = F.concat(F.array_join(F.transform("f", lambda x: x["body"]), FIELD), F.lit(FIELD + RECORD))
    return rows.select(F.concat(F.lpad(total.cast("string"), 5, "0"), F.lit("nam a22"), F.lpad(base.cast("string"), 5, "0"), F.lit(" a 4500"), "d.text", F.lit(FIELD), body).alias("value"))


IDS = {"pica": pica_id, "mab2": mab2_id}
DECODERS = {"pica": decode_pica, "marc21": decode_marc21, "mab2": decode_mab2}


def register_format(kind: str, decode) -> None:
    """A format of one's own: decode(df, line) gives properties, with an ``error`` property where a line can't be read."""
    if kind in DECODERS:
        raise ValueError(f"{kind} is taken")
    DECODERS[kind] = decode


def ingest(df: DataFrame, kind: str, program=None, prefix: str = "", line: str = "value") -> DataFrame:
    """Lines of a format to properties: decode, apply a program, prefix the ids.  Error records pass by the program."""
    if kind not in DECODERS:
        raise ValueError(f"unknown format {kind}; known: {', '.join(sorted(DECODERS))}")
    props = DECODERS[kind](df, line)
    if program:
        props = program(props.where("name <> 'error'")).unionByName(props.where("name = 'error'"))
    return props.withColumn("id", F.when(F.col("id").startswith("error:"), F.col("id")).otherwise(F.concat(F.lit(prefix), "id")))


def raw_records(df: DataFrame, kind: str, prefix: str = "", line: str = "value") -> DataFrame:
    """(id, kind, raw): the lines as they came, under the ids that ingest() gives them."""
    if kind == "marc21":
        key = _decode_marc(F.col(line))["id"]
    elif kind in IDS:
        key = F.coalesce(IDS[kind](line), _error_id(F.col(line)))
    else:
        raise ValueError(f"no record id is known for {kind}")
    rows = df.where(F.length(F.trim(line)) > 0).select(key.alias("key"), F.lit(kind).alias("kind"), F.col(line).alias("raw"))
    return rows.select(F.when(F.col("key").startswith("error:"), F.col("key")).otherwise(F.concat(F.lit(prefix), "key")).alias("id"), "kind", "raw")


def counted(props: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """props, and counters that are ready after its first action: properties, records with errors."""
    seen = Observation(name)
    return props.observe(seen, F.count(F.lit(1)).alias("properties"), F.count_if(F.col("name") == "error").alias("errors")), seen


def file_props(spark: SparkSession, path: str, kind: str, program=None, prefix: str = "") -> DataFrame:
    """Properties of the lines of files of a format (or ``xml`` for MARC21 XML), through a program."""
    if kind == "xml":
        props = marc_xml(spark, path)
        return program(props) if program else props
    return ingest(spark.read.text(path), kind, program, prefix)


def file_count(spark: SparkSession, path: str, kind: str, program) -> DataFrame:
    """(key, name, value, n): how often a program emits each property over files."""
    from propweave.operators.stats import count_properties

    return count_properties(file_props(spark, path, kind, program).where("name <> 'error'"))


def file_morph(spark: SparkSession, path: str, kind: str, program, names: bool = True) -> DataFrame:
    """(id, line): the output of a program over files as text lines (sources.sinks.write_lines writes them)."""
    from propweave.sources.sinks import grouped_lines

    return grouped_lines(file_props(spark, path, kind, program).where("name <> 'error'"), names)
