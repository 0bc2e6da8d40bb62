"""Declarative rule programs over properties, compiled to DataFrame expressions.

A program is a list of rules.  A rule has sources (names with alternatives ``a|b`` and wildcards ``?`` ``*``,
``_id`` for the record's id, ``_else`` for what no other rule takes, or a group's name, which gives an empty value
where the group starts), a chain of steps on the value, and a name for the output (the source's own if left out).
An output named ``@x`` feeds other rules; a rule that feeds itself is applied to its own output until nothing is
left.  ``_id`` re-keys the whole record; ``{to:ID}name`` re-keys one property.  Outputs are flat, but for those of
entity collectors, which make groups.

All rules that only project share one scan: each is a struct in an array that is exploded once.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave import functions as fn
from propweave.model import COLUMNS, path
from propweave.operators import collectors

Step = Callable[[Column], Column]

#: Steps by the name of their XML element: attributes, then child entries, to a function of a value.
STEPS: dict[str, Callable[[dict, dict], Step]] = {
    "trim": lambda a, _: fn.trim,
    "case": lambda a, _: lambda v: fn.casefold(v, a.get("to", "lower")),
    "substring": lambda a, _: lambda v: fn.slice_text(v, int(a.get("start", 0)), int(a["end"]) if "end" in a else None),
    "replace": lambda a, _: lambda v: fn.replace(v, a["pattern"], a.get("with", "")),
    "regexp": lambda a, _: lambda v: fn.match(v, a["match"], a.get("format")),
    "compose": lambda a, _: lambda v: fn.compose(v, a.get("prefix", ""), a.get("postfix", "")),
    "constant": lambda a, _: lambda v: fn.constant(v, a["value"]),
    "equals": lambda a, _: lambda v: F.when(v == a["string"], v),
    "not-equals": lambda a, _: lambda v: F.when(v != a["string"], v),
    "whitelist": lambda a, e: lambda v: fn.one_of(v, list(e)),
    "lookup": lambda a, e: lambda v: fn.lookup(v, e, a.get("default")),
    "setreplace": lambda a, e: lambda v: fn.set_replace(v, e),
    "normalize-utf8": lambda a, _: fn.nfc,
    "isbn": lambda a, _: fn.isbn13,
    "htmlanchor": lambda a, _: lambda v: fn.html_anchor(v, a.get("prefix", "")),
}


def register_step(name: str, make: Callable[[dict, dict], Step]) -> None:
    """A step of one's own under the name of an XML element: make(attributes, entries) gives a function of a value."""
    if name in STEPS or name in ("data", "entry", *MARKS, *COLLECTORS):
        raise ValueError(f"{name} is taken")
    STEPS[name] = make


@dataclass
class Rule:
    source: str
    name: str | None = None
    steps: list[Step] = field(default_factory=list)
    nth: int | None = None
    more: bool = False
    unique: bool = False
    swap: bool = False
    count: bool = False
    after: list[Step] = field(default_factory=list)  # steps on the running count


@dataclass
class Collector:
    """A collector over rules: combine, choose, concat, tuples, square, group or entity."""

    kind: str
    children: list[Rule | Collector]
    name: str
    value: str = ""
    options: dict = field(default_factory=dict)
    steps: list[Step] = field(default_factory=list)
    buffered: list[bool] = field(default_factory=list)


def glob(source: str) -> str:
    """A regular expression for alternatives and wildcards."""
    parts = ["".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in s) for s in source.split("|")]
    return "^(?:" + "|".join(parts) + ")$"


def matches(name: Column, source: str) -> Column:
    if "*" in source or "?" in source:
        return name.rlike(glob(source))
    return name.isin(source.split("|"))


class Program:
    def __init__(self, name: str, rules: list[Rule | Collector], marker: str = "."):
        self.name, self.rules, self.marker = name, rules, marker

    def __call__(self, props: DataFrame) -> DataFrame:
        """The properties that the program emits, long form.  A ``_id`` output re-keys its record's others."""
        props = props.withColumn("path", path(self.marker))
        outputs: list[DataFrame] = []
        plain = [r for r in self.rules if isinstance(r, Rule) and not self._stateful(r)]
        taken = [x for r in self._all(self.rules) for x in r.source.split("|") if x not in ("_else", "_id") and not x.startswith("@")]
        props = self._with_starts(props, taken)
        if plain:
            outputs.append(self._project(props, plain, taken))
        for k, r in self._ordered([(k, r) for k, r in enumerate(self.rules) if r not in plain]):
            if isinstance(r, Collector):
                outputs.append(self._collect(props, r, outputs, taken, k))
            else:
                outputs.append(self._one(props, r, outputs, taken).withColumn("name", F.lit(r.source if r.name is None else r.name)))
        full = reduce(DataFrame.unionByName, [self._long(o) for o in outputs]).where("value is not null and name not like '@%'")
        if not any(r.name == "_id" for r in self.rules):
            return full
        ids = full.where("name = '_id'").groupBy("id").agg(F.max_by("value", "pos").alias("new_id"))
        rest = full.where("name <> '_id'").join(ids, "id", "left")
        return rest.select(F.coalesce("new_id", "id").alias("id"), *COLUMNS[1:])

    def _with_starts(self, props: DataFrame, taken: list[str]) -> DataFrame:
        """props, and an empty value under a group's name where a group that is a source starts."""
        named = reduce(Column.__or__, [matches(F.col("ent"), s) for s in taken], F.lit(False))
        starts = props.where(F.col("ent").isNotNull() & named).groupBy("id", "ent_no", "ent").agg(F.min("pos").alias("pos"))
        starts = starts.select("id", "pos", "ent_no", F.lit(None).cast("string").alias("ent"), F.col("ent").alias("name"), F.lit("").alias("value"), F.col("ent").alias("path"))
        return props.withColumn("start", F.lit(False)).unionByName(starts.withColumn("start", F.lit(True)))

    def _ordered(self, rules: list[tuple[int, Rule | Collector]]) -> list[tuple[int, Rule | Collector]]:
        """Rules after those that feed them; a circle of several rules is an error."""
        feeds = lambda r: {x for one in self._all([r]) for x in one.source.split("|") if x.startswith("@")} - {r.name}
        out, left = [], list(rules)
        while left:
            made = {r.name for _, r in left}
            ready = [x for x in left if not feeds(x[1]) & made]
            if not ready:
                raise ValueError(f"rules feed each other: {', '.join(sorted(filter(None, made)))}")
            out += ready
            left = [x for x in left if x not in ready]
        return out

    @staticmethod
    def _long(df: DataFrame) -> DataFrame:
        more = [F.lit(None).cast(t).alias(c) for c, t in (("pos", "int"), ("ent_no", "int"), ("ent", "string")) if c not in df.columns]
        return df.select("*", *more).select(*COLUMNS)

    @staticmethod
    def _stateful(r: Rule) -> bool:
        return r.nth is not None or r.unique or r.count or any(x == "_id" or x.startswith("@") for x in r.source.split("|"))

    def _all(self, rules) -> list[Rule]:
        return [x for r in rules for x in (self._all(r.children) if isinstance(r, Collector) else [r])]

    def _value(self, r: Rule, value: Column) -> Column:
        return reduce(lambda v, step: step(v), r.steps, value)

    def _hit(self, source: str, taken: list[str]) -> Column:
        if source == "_else":
            return ~reduce(Column.__or__, [matches(F.col("path"), s) for s in taken], F.col("start"))
        return matches(F.col("path"), source)

    def _project(self, props: DataFrame, rules: list[Rule], taken: list[str]) -> DataFrame:
        made = []
        for r in rules:
            value = self._value(r, F.col("name") if r.swap else F.col("value"))
            name = F.col("value") if r.swap else F.lit(r.name) if r.name is not None else F.col("path")
            made.append(F.when(self._hit(r.source, taken), F.struct(name.alias("name"), value.alias("value"))))
        hit = F.explode(F.filter(F.array(*made), lambda x: x.isNotNull()))
        return props.select("id", "pos", hit.alias("x")).select("id", "pos", "x.name", "x.value")

    def _one(self, props: DataFrame, r: Rule | Collector, outputs: list[DataFrame], taken: list[str]) -> DataFrame:
        if isinstance(r, Collector):
            return self._collect(props, r, outputs, taken)
        named = [x for x in r.source.split("|") if x != "_id" and not x.startswith("@")]
        parts = []
        if named:
            parts.append(props.where(self._hit("|".join(named), taken)).select("id", "pos", "ent_no", F.col("name" if r.swap else "value").alias("value")))
        if "_id" in r.source.split("|"):
            parts.append(props.select("id", F.lit(-1).alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.col("id").alias("value")).distinct())
        for x in r.source.split("|"):
            if x.startswith("@") and x != r.name:
                fed = [self._long(o).where(F.col("name") == x) for o in outputs]
                if fed:
                    parts.append(reduce(DataFrame.unionByName, fed).select("id", "pos", "ent_no", "value"))
        if not parts:
            raise ValueError(f"nothing feeds {r.source}")
        out = reduce(DataFrame.unionByName, parts)
        if r.name is not None and r.name in r.source.split("|"):
            out = self._repeated(out, r)
        else:
            out = out.withColumn("value", self._value(r, F.col("value")))
        out = out.where("value is not null")
        if r.unique:
            out = collectors.unique(out).withColumn("ent_no", F.lit(None).cast("int"))
        if r.nth is not None:
            out = collectors.nth(out, r.nth, r.more)
        if r.count:
            out = collectors.running_count(out)
            out = out.withColumn("value", reduce(lambda v, step: step(v), r.after, F.col("value"))).where("value is not null")
        return out

    def _repeated(self, df: DataFrame, r: Rule) -> DataFrame:
        """All values of a rule that feeds itself.  Its steps must shorten a value, or end with none, in time: after as
        many rounds as the value has characters, and one, more is an error."""
        text = F.col("value")
        start = F.struct(text.alias("now"), F.array().cast("array<string>").alias("out"))

        def step(acc: Column, _: Column) -> Column:
            new = self._value(r, acc["now"])
            return F.struct(new.alias("now"), F.when(new.isNotNull(), F.concat(acc["out"], F.array(new))).otherwise(acc["out"]).alias("out"))

        end = F.aggregate(F.sequence(F.lit(0), F.length(text)), start, step)
        over = F.raise_error(F.concat(F.lit(f"{r.name} doesn't end for "), text)).cast("array<string>")
        made = df.where("value is not null").select("id", "pos", "ent_no", "value", end.alias("end"))
        return made.select("id", "pos", "ent_no", F.explode(F.when(F.col("end.now").isNull(), F.col("end.out")).otherwise(over)).alias("value"))

    def _collect(self, props: DataFrame, c: Collector, outputs: list[DataFrame], taken: list[str], number: int = 0) -> DataFrame:
        children = c.children
        if c.kind == "entity" and c.options.get("entity"):  # a group's own choices are made for each group
            own = {"choose": {"entity": True}, "combine": {"flush": "entity"}}
            children = [replace(r, options=own.get(r.kind, {}) | r.options) if isinstance(r, Collector) else r for r in children]
        parts = [self._one(props, r, outputs, taken) for r in children]
        names = [r.name or (r.source if isinstance(r, Rule) else "") for r in c.children]
        o = c.options
        if c.kind == "entity":
            named = [p if "name" in p.columns and not n else p.withColumn("name", F.lit(n)) for n, p in zip(names, parts)]
            return collectors.entity(named, c.name, bool(o.get("entity")), number)
        if c.kind == "group":
            out = collectors.group(parts, c.name)
        elif c.kind == "choose":
            out = collectors.choose(parts, bool(o.get("entity")), None if c.name else names)
        elif c.kind == "concat":
            whole = reduce(DataFrame.unionByName, [p.select("id", "pos", "value") for p in parts])
            out = collectors.concat(whole, o.get("delimiter", ""), o.get("prefix", ""), o.get("postfix", ""))
        elif c.kind == "square":
            out = collectors.square(reduce(DataFrame.unionByName, [p.select("id", "pos", "value") for p in parts]), o.get("delimiter", ""))
        elif c.kind == "tuples":
            by_name: dict[str, DataFrame] = {}
            for n, p in zip(names, parts):
                by_name[n] = by_name[n].unionByName(p.select("id", "pos", "value")) if n in by_name else p.select("id", "pos", "value")
            out = collectors.tuples(by_name, o.get("separator", ""), o.get("min"))
        elif c.kind == "combine":
            children = dict(zip(names, parts))
            if any(c.buffered):
                out = collectors.combine_buffered(children, names[c.buffered.index(True)], c.value)
            elif o.get("reset"):
                out = collectors.combine_reset(children, c.value)
            elif o.get("flush"):
                out = collectors.combine_flush(children, c.value, o["flush"] == "entity")
            else:
                out = collectors.combine_latest(children, c.value, bool(o.get("same_entity")))
        else:
            raise ValueError(f"unknown collector {c.kind}")
        value = reduce(lambda v, step: step(v), c.steps, F.col("value"))
        out = out.withColumn("value", value).where("value is not null")
        more = [F.lit(None).cast("int").alias(k) for k in ("pos", "ent_no") if k not in out.columns]
        if o.get("nth") is not None:
            out = collectors.nth(out.select("*", *more), o["nth"], bool(o.get("more")))
            more = []
        name = collectors.template(c.name, {x: F.col(x) for x in names}) if "${" in c.name and set(names) <= set(out.columns) else F.lit(c.name)
        if "name" in out.columns and not c.name:
            name = F.col("name")
        return out.select("*", *more).select("id", "pos", "ent_no", name.alias("name"), "value")


COLLECTORS = ("combine", "choose", "concat", "tuples", "square", "group", "entity")
#: Elements of a rule besides steps, and of a program besides rules.
MARKS = ("occurrence", "unique", "switch-name-value", "buffer", "count", "postprocess")
#: Entries of a map in a file at most; larger tables are joined (operators.enrich.lookup_join).
MAP_ENTRIES = 10_000


def _expanded(e: ET.Element, macros: dict[str, ET.Element], given: dict[str, str]) -> list[ET.Element]:
    """Copies of e's children with macro calls replaced and ``$[x]`` filled."""
    def fill(text: str) -> str:
        def one(m: re.Match) -> str:
            if m[1] not in given:
                raise ValueError(f"no value for $[{m[1]}]")
            return given[m[1]]

        return re.sub(r"\$\[(\w+)\]", one, text)

    out = []
    for child in e:
        attributes = {k: fill(v) for k, v in child.attrib.items()}
        if child.tag == "call-macro":
            name = attributes.pop("name")
            if name not in macros:
                raise ValueError(f"unknown macro {name}")
            out += _expanded(macros[name], {k: v for k, v in macros.items() if k != name}, given | attributes)
        else:
            new = ET.Element(child.tag, attributes)
            new.text = child.text
            new.extend(_expanded(child, macros, given))
            out.append(new)
    return out


def read_map(spark: SparkSession, files: str) -> dict[str, str]:
    """A map from tab-separated files of two columns; more than MAP_ENTRIES entries are an error."""
    paths = [x.strip() for x in files.split(",") if x.strip()]
    rows = spark.read.csv(paths, sep="\t", schema="key string, value string", quote="").where("key is not null").limit(MAP_ENTRIES + 1).collect()
    if len(rows) > MAP_ENTRIES:
        raise ValueError(f"{files} has more than {MAP_ENTRIES} entries: join it as a table")
    return {r.key: r.value or "" for r in rows}


def parse(text: str, spark: SparkSession | None = None, **variables: str) -> Program:
    """A program from XML: rules under <rules>, maps under <maps>, macros under <macros>, ``$[x]`` filled from variables
    and <vars>.  A <filemap> is read through spark.  Unknown elements are an error."""
    root = ET.fromstring(text)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2]
    given = {v.get("name"): v.get("value") for v in root.iter("var")} | variables
    macros = {m.get("name"): m for m in root.iter("macro")}
    maps = {m.get("name"): ({e.get("name"): e.get("value", "") for e in m}, m.get("default")) for m in root.iter("map")}
    for m in root.iter("filemap"):
        if spark is None:
            raise ValueError("a program with a filemap needs a session to read it")
        maps[m.get("name")] = (read_map(spark, m.get("files", "")), m.get("default"))

    def steps(elements: list[ET.Element]) -> list[Step]:
        out = []
        for s in elements:
            if s.tag in STEPS:
                attributes = dict(s.attrib)
                entries = {x.get("name"): x.get("value", "") for x in s}
                ref = attributes.get("map") or attributes.get("in")
                if ref:
                    if ref not in maps:
                        raise ValueError(f"unknown map {ref}")
                    entries, default = maps[ref]
                    if default is not None:
                        attributes.setdefault("default", default)
                out.append(STEPS[s.tag](attributes, entries))
            elif s.tag not in MARKS and s.tag != "data" and s.tag not in COLLECTORS:
                raise ValueError(f"unknown element <{s.tag}>")
        return out

    def occurrence(e: ET.Element) -> tuple[int | None, bool]:
        only = next((s.get("only") for s in e if s.tag == "occurrence"), None)
        number = re.search(r"\d+", only) if only else None
        return int(number[0]) if number else None, bool(only and not only.strip().isdigit())

    def build(e: ET.Element) -> tuple[Rule | Collector, bool]:
        buffered = any(s.tag == "buffer" for s in e)
        name = e.get("name") or None
        if e.tag == "data":
            if any(s.tag == "data" or s.tag in COLLECTORS for s in e):
                raise ValueError("<data> holds steps only")
            tags = [s.tag for s in e]
            cut = tags.index("count") if "count" in tags else len(tags)
            nth, more = occurrence(e)
            return Rule(e.get("source"), e.get("name"), steps(list(e)[:cut]), nth, more, "unique" in tags, "switch-name-value" in tags, "count" in tags, steps(list(e)[cut:])), buffered
        if e.tag not in COLLECTORS:
            raise ValueError(f"unknown element <{e.tag}>")
        steps([s for s in e])  # names unknown elements
        children = [build(s) for s in e if s.tag == "data" or s.tag in COLLECTORS]
        flush, options = e.get("flushWith"), {}
        options |= {"reset": True} if e.get("reset") == "true" else {}
        options |= {"same_entity": True} if e.get("sameEntity") == "true" else {}
        options |= {"flush": "record" if flush == "record" else "entity"} if flush and e.tag == "combine" else {}
        options |= {"entity": True} if flush and flush != "record" and e.tag in ("choose", "entity") else {}
        options |= {k: e.get(k) for k in ("delimiter", "prefix", "postfix", "separator") if e.get(k) is not None}
        options |= {"min": int(e.get("minN"))} if e.get("minN") else {}
        post = [s for p in e if p.tag == "postprocess" for s in steps(list(p))]
        nth, more = next((occurrence(p) for p in e if p.tag == "postprocess"), (None, False))
        options |= {"nth": nth, "more": more} if nth is not None else {}
        return Collector(e.tag, [c for c, _ in children], name or "", e.get("value", ""), options, post, [b for _, b in children]), buffered

    rules = [build(e)[0] for r in root.iter("rules") for e in _expanded(r, macros, given)]
    name = next((m.text for m in root.iter("name") if m.text), root.get("name") or "")
    return Program(name, rules, root.get("entityMarker", "."))


def keep_records(props: DataFrame, program: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The whole records for which the program emits anything."""
    return props.join(program(props).select("id").distinct(), "id", "left_semi")
