"""Record linkage: match keys, bundles, match lists, overlaps, redirects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propweave.operators.components import connected_components


def preferred(keys: DataFrame) -> DataFrame:
    """(id, key) to (id, pref, others): the smallest key and the sorted set of the rest."""
    one = keys.where("id is not null and key is not null").groupBy("id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return one.select("id", F.element_at("keys", 1).alias("pref"), F.slice("keys", 2, F.greatest(F.size("keys") - 1, F.lit(1))).alias("others"))


def memberships(keys: DataFrame, algorithm: str) -> DataFrame:
    """(bundle_id, id): each record in the bundle of its smallest key.  No lists are made."""
    best = keys.where("id is not null and key is not null").groupBy("id").agg(F.min("key").alias("pref"))
    return best.select(F.concat(F.lit(algorithm + "$"), "pref").alias("bundle_id"), "id")


def match(keys: DataFrame, algorithm: str) -> DataFrame:
    """Bundles: bundle_id, key, contains (sorted member ids), eq (the members' other keys, prefixed)."""
    rows = preferred(keys).select("pref", "id", F.explode_outer("others").alias("other"))
    out = rows.groupBy("pref").agg(F.array_sort(F.collect_set("id")).alias("contains"), F.array_sort(F.collect_set(F.concat(F.lit(algorithm + "$"), "other"))).alias("eq"))
    return out.select(F.concat(F.lit(algorithm + "$"), "pref").alias("bundle_id"), F.col("pref").alias("key"), "contains", "eq")


def match_list(members: DataFrame) -> DataFrame:
    """All ordered pairs of different members of a bundle: (id1, id2).  The output is this operator's own size."""
    a, b = members.select("bundle_id", F.col("id").alias("id1")), members.select("bundle_id", F.col("id").alias("id2"))
    return a.join(b, "bundle_id").where("id1 <> id2").select("id1", "id2").distinct()


def match_overlap(members: DataFrame, marker: str = "-") -> DataFrame:
    """(alg, i, j, overlap): co-occurrence of institutions, the prefixes of member ids, in bundles.

    Members are counted by bundle and institution before the self-join, so a large bundle is as many rows as
    it has institutions.  The diagonal adds count - 1, other places the count of j."""
    counts = members.where(F.instr("id", marker) > 0).groupBy("bundle_id", F.substring_index("id", marker, 1).alias("inst")).agg(F.count("*").alias("n"))
    a = counts.select("bundle_id", F.col("inst").alias("i"))
    b = counts.select("bundle_id", F.col("inst").alias("j"), "n")
    value = F.when(F.col("i") == F.col("j"), F.col("n") - 1).otherwise(F.col("n"))
    return a.join(b, "bundle_id").groupBy(F.substring_index("bundle_id", "$", 1).alias("alg"), "i", "j").agg(F.sum(value).alias("overlap"))


def bundle_stats(members: DataFrame, marker: str = "-") -> DataFrame:
    """(alg, measure, n): groups, groups by size, members by institution, total members."""
    alg = F.substring_index("bundle_id", "$", 1)
    sizes = members.groupBy("bundle_id").agg(F.count("*").alias("size")).select(alg.alias("alg"), "size")
    by_size = sizes.groupBy("alg", F.concat(F.lit("size:"), F.col("size").cast("string")).alias("measure")).agg(F.count("*").alias("n"))
    by_inst = members.groupBy(alg.alias("alg"), F.concat(F.lit("inst:"), F.substring_index("id", marker, 1)).alias("measure")).agg(F.count("*").alias("n"))
    total = members.groupBy(alg.alias("alg")).agg(F.count("*").alias("total"), F.count_distinct("bundle_id").alias("groups"))
    both = total.select("alg", F.inline(F.array(F.struct(F.lit("total").alias("measure"), F.col("total").alias("n")), F.struct(F.lit("groups").alias("measure"), F.col("groups").alias("n")))))
    return by_size.unionByName(by_inst).unionByName(both)


def bundle_edges(bundles: DataFrame) -> DataFrame:
    """(src, dst) between a bundle's own id and the ids it is equivalent to."""
    return bundles.select(F.col("bundle_id").alias("src"), F.explode("eq").alias("dst"))


def redirects(edges: DataFrame) -> DataFrame:
    """(node, redirect) for each node that isn't the smallest of its component."""
    return connected_components(edges).where("node <> component").select("node", F.col("component").alias("redirect"))


def move_members(members: DataFrame, redirected: DataFrame) -> DataFrame:
    """Members of redirected bundles under the target's id."""
    to = redirected.select(F.col("node").alias("bundle_id"), "redirect")
    return members.join(to, "bundle_id", "left").select(F.coalesce("redirect", "bundle_id").alias("bundle_id"), "id").distinct()


def dedupe(keys: DataFrame) -> DataFrame:
    """(id, rep): the transitive closure of sharing any key; rep is the smallest id.

    Keys and records are the nodes of one graph, so a key with very many records makes as many edges."""
    rows = keys.where("id is not null and key is not null").distinct()
    edges = rows.select(F.concat(F.lit("r"), "id").alias("src"), F.concat(F.lit("k"), "key").alias("dst"))
    found = connected_components(edges).where("node like 'r%'").select(F.substring("node", 2, 1 << 30).alias("id"), "component")
    rep = found.groupBy("component").agg(F.min("id").alias("rep"))
    return found.join(rep, "component").select("id", "rep")
