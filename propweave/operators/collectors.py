"""Collectors: operators that bring several properties of one record together.

Each child is a long-form DataFrame (id, pos, value[, ent_no]) under a name.  Buffered forms need one
aggregate for each record; the unbuffered ones are windows over the record's own order.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def template(text: str, columns: dict[str, Column]) -> Column:
    """``${x}`` places in text filled from columns."""
    parts = re.split(r"\$\{(\w+)\}", text)
    return F.concat(*[F.lit(p) if i % 2 == 0 else columns[p] for i, p in enumerate(parts)])


def _tagged(children: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    tagged = [df.select(*keys, "pos", F.lit(name).alias("child"), "value") for name, df in children.items()]
    return reduce(DataFrame.unionByName, tagged)


def combine_latest(children: dict[str, DataFrame], value: str, same_entity: bool = False) -> DataFrame:
    """Emits for each arriving value once all children have one, with the latest of each (state is kept)."""
    keys = ["id", "ent_no"] if same_entity else ["id"]
    w = Window.partitionBy(*keys).orderBy("pos", "child").rowsBetween(Window.unboundedPreceding, 0)
    rows = _tagged(children, keys)
    last = {c: F.last(F.when(F.col("child") == c, F.col("value")), ignorenulls=True).over(w).alias(c) for c in children}
    full = rows.select(*keys, "pos", *last.values()).where(reduce(Column.__and__, [F.col(c).isNotNull() for c in children]))
    return full.select(*keys, "pos", template(value, {c: F.col(c) for c in children}).alias("value"))


def combine_buffered(children: dict[str, DataFrame], buffered: str, value: str) -> DataFrame:
    """One value for each value of the buffered child, with the last of each other child."""
    others = [c for c in children if c != buffered]
    rows = _tagged(children, ["id"])
    last = [F.max_by(F.when(F.col("child") == c, F.col("value")), F.when(F.col("child") == c, F.col("pos"))).alias(c) for c in others]
    one = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.when(F.col("child") == buffered, F.struct("pos", "value")))).alias("all"), *last)
    out = one.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in others], F.lit(True))).select("id", *others, F.explode("all").alias("b"))
    return out.select("id", F.col("b.pos").alias("pos"), template(value, {**{c: F.col(c) for c in others}, buffered: F.col("b.value")}).alias("value"))


def combine_reset(children: dict[str, DataFrame], value: str) -> DataFrame:
    """Emits when all children have a value, the latest of each, and starts anew: a fold over the record's values in order."""
    names = list(children)
    items = F.array_sort(F.collect_list(F.struct("pos", "child", "value")))
    rows = _tagged(children, ["id"]).groupBy("id").agg(items.alias("items"))
    empty = F.lit(None).cast("string")
    kind = f"array<struct<pos:int,{','.join(f'v{k}:string' for k in range(len(names)))}>>"
    start = F.struct(*[empty.alias(f"v{k}") for k in range(len(names))], F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        now = [F.when(x["child"] == c, x["value"]).otherwise(acc[f"v{k}"]) for k, c in enumerate(names)]
        full = reduce(Column.__and__, [v.isNotNull() for v in now])
        out = F.concat(acc["out"], F.array(F.struct(x["pos"].cast("int").alias("pos"), *[v.alias(f"v{k}") for k, v in enumerate(now)])))
        return F.struct(*[F.when(~full, v).alias(f"v{k}") for k, v in enumerate(now)], F.when(full, out).otherwise(acc["out"]).alias("out"))

    made = rows.select("id", F.explode(F.aggregate("items", start, step)["out"]).alias("x"))
    return made.select("id", F.col("x.pos").alias("pos"), template(value, {c: F.col(f"x.v{k}") for k, c in enumerate(names)}).alias("value"))


def combine_flush(children: dict[str, DataFrame], value: str, entity: bool = False) -> DataFrame:
    """One value for each record (or group) with any child; absent children are empty."""
    keys = ["id", "ent_no"] if entity else ["id"]
    rows = _tagged(children, keys)
    last = [F.coalesce(F.max_by(F.when(F.col("child") == c, F.col("value")), F.when(F.col("child") == c, F.col("pos"))), F.lit("")).alias(c) for c in children]
    return rows.groupBy(*keys).agg(F.max("pos").alias("pos"), *last).select(*keys, "pos", template(value, {c: F.col(c) for c in children}).alias("value"))


def choose(children: list[DataFrame], entity: bool = False, names: list[str] | None = None) -> DataFrame:
    """The first child in the list that has a value wins; of its values, the last.  With names, the winner's goes along."""
    keys = ["id", "ent_no"] if entity else ["id"]
    named = [df if names is None or "name" in df.columns and not n else df.withColumn("name", F.lit(n)) for df, n in zip(children, names or [""] * len(children))]
    columns = ["pos", "value", *(["name"] if names is not None else [])]
    ranked = reduce(DataFrame.unionByName, [df.select(*keys, F.lit(i).alias("rank"), *columns) for i, df in enumerate(named)])
    best = ranked.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(-F.col("rank"), "pos")).alias("b"))
    return best.select(*keys, *[f"b.{c}" for c in columns])


def concat(child: DataFrame, delimiter: str = "", prefix: str = "", postfix: str = "", keys: list[str] | None = None) -> DataFrame:
    """All values of a record in order, joined."""
    keys = keys or ["id"]
    items = F.array_sort(F.collect_list(F.struct("pos", "value")))
    joined = F.concat(F.lit(prefix), F.array_join(F.transform(items, lambda x: x["value"]), delimiter), F.lit(postfix))
    return child.groupBy(*keys).agg(F.max("pos").alias("last"), joined.alias("value")).select(*keys, F.col("last").alias("pos"), "value")


def tuples(children: dict[str, DataFrame], separator: str = "", minimum: int | None = None) -> DataFrame:
    """The cartesian product of the children's values within each record, children by name.

    Equi-joins on the record id; with a minimum, records need so many children and absent ones are left out."""
    names = sorted(children)
    parts = [children[c].select("id", F.col("value").alias(c)) for c in names]
    out = reduce(lambda a, b: a.join(b, "id", "inner" if minimum is None else "full"), parts)
    if minimum is not None:
        out = out.where(sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0)) >= minimum)
    return out.select("id", F.concat_ws(separator, *names).alias("value"))


def square(child: DataFrame, delimiter: str = "") -> DataFrame:
    """All unordered pairs of different values of a record, the smaller first."""
    one = child.select("id", "value").distinct()
    a, b = one.select("id", F.col("value").alias("x")), one.select("id", F.col("value").alias("y"))
    return a.join(b, "id").where("x < y").select("id", F.concat("x", F.lit(delimiter), "y").alias("value"))


def group(children: list[DataFrame], name: str) -> DataFrame:
    """Several children under one name."""
    return reduce(DataFrame.unionByName, [df.select("id", "pos", "value") for df in children]).select("id", "pos", F.lit(name).alias("name"), "value")


def entity(children: list[DataFrame], name: str, each: bool = False, number: int = 0) -> DataFrame:
    """A new group of the children's properties (id, pos, ent_no, name, value) for each record, numbered `number`, or with
    `each` for each group that they come from."""
    rows = reduce(DataFrame.unionByName, [df.select("id", "pos", F.col("ent_no").cast("int").alias("ent_no") if "ent_no" in df.columns else F.lit(None).cast("int").alias("ent_no"), "name", "value") for df in children])
    own = F.coalesce("ent_no", F.lit(number)) if each else F.lit(number)
    return rows.where("value is not null").select("id", "pos", own.alias("ent_no"), F.lit(name).alias("ent"), "name", "value")


def nth(child: DataFrame, n: int, more: bool = False) -> DataFrame:
    """The n-th occurrence within each record, or those after it."""
    w = Window.partitionBy("id").orderBy("pos")
    k = child.withColumn("k", F.row_number().over(w))
    return k.where(F.col("k") > n if more else F.col("k") == n).drop("k")


def running_count(child: DataFrame) -> DataFrame:
    w = Window.partitionBy("id").orderBy("pos")
    return child.withColumn("value", F.row_number().over(w).cast("string"))


def unique(child: DataFrame) -> DataFrame:
    """The first of equal values of a record."""
    return child.groupBy("id", "value").agg(F.min("pos").alias("pos")).select("id", "pos", "value")


def absent(records: DataFrame, child: DataFrame, value: str) -> DataFrame:
    """A constant for each record that has no value in child."""
    return records.select("id").distinct().join(child.select("id").distinct(), "id", "left_anti").select("id", F.lit(0).alias("pos"), F.lit(value).alias("value"))
