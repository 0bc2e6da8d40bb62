"""Quality rules with host-level verdicts (operator 9), in DataFrame and SQL functions only.

Each document's counts give its own rule failures.  Failures are summed by host (the source column),
each host's rate is shrunk towards a beta prior fitted to all hosts' rates by their mean and variance,
and hosts whose shrunken rate is above a bound fail as a whole; that verdict is joined back.

Defined results: null, empty and blank texts have no words and so fail; a null host has no verdict
(only the document's own rules count); repeated rows are counted and returned as often as they
occur; very long texts are measured whole; a host whose rate is just the bound passes; an empty table gives an
empty table; columns other than doc_id, text and the host's are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave.llm import common

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: A host fails if its shrunken failure rate is above this.
MAX_HOST_RATE = 0.5
#: Hosts whose verdicts are broadcast at most; more are joined by a shuffle.
VERDICTS = 100_000

#: Words of an array w that lie in three-word windows found twice or more.  A window is a 64-bit hash
#: of its words' hashes; its low 64 - k bits, with its place in the other k bits, are sorted, and
#: equal neighbours are repeats.  Their words are compared: where any differ, the text's windows are sorted as
#: words instead.
_SAME = "shiftrightunsigned(s[{0}], k) = shiftrightunsigned(s[{1}], k)"
_AT = "CAST(s[{0}] & (shiftleft(1L, k) - 1L) AS INT)"
_UNLIKE = " OR ".join(f"w[{_AT.format('j')} + {i}] <> w[{_AT.format('j - 1')} + {i}]" for i in range(3))
_COVERED = "CAST(size(array_distinct(concat(p, transform(p, x -> x + 1L), transform(p, x -> x + 2L)))) AS BIGINT)"
_BY_WORDS = f"""
 transform(array(sort_array(transform(sequence(0, size(w) - 3), i ->
     named_struct('g', concat_ws('\n', w[i], w[i + 1], w[i + 2]), 'i', CAST(i AS BIGINT))))), s ->
  transform(array(transform(filter(sequence(0, size(s) - 1), j ->
      (j > 0 AND s[j].g = s[greatest(j - 1, 0)].g) OR (j < size(s) - 1 AND s[j].g = s[least(j + 1, size(s) - 1)].g)), j -> s[j].i)), p -> {_COVERED})[0])[0]
"""
#: Bits of a hash that are compared, at most; a parameter for tests.
HASH_BITS = 64


def repeated(bits: int = HASH_BITS) -> str:
    window = "xxhash64(hs[i], hs[i + 1], hs[i + 2])" + (f" & {(1 << bits) - 1}L" if bits < 63 else "")
    return f"""
CASE WHEN size(w) < 4 THEN 0L ELSE
transform(array(transform(w, x -> xxhash64(x))), hs ->
 transform(array(CAST(ceil(log2(size(hs))) AS INT)), k ->
  transform(array(sort_array(transform(sequence(0, size(hs) - 3), i ->
      shiftleft({window}, k) | CAST(i AS BIGINT)))), s ->
   CASE WHEN exists(sequence(1, size(s) - 1), j -> {_SAME.format('j', 'j - 1')} AND ({_UNLIKE})) THEN {_BY_WORDS} ELSE
   transform(array(transform(filter(sequence(0, size(s) - 1), j ->
       (j > 0 AND {_SAME.format('j', 'j - 1')}) OR (j < size(s) - 1 AND {_SAME.format('j', 'j + 1')})),
     j -> s[j] & (shiftleft(1L, k) - 1L))), p -> {_COVERED})[0] END)[0])[0])[0] END
"""


def measures(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = docs.select("doc_id", F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.select("doc_id", "host", "t", common.words("t").alias("w"), F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    without = lambda chars: F.length(F.translate("t", chars, ""))
    out = t.select(
        "doc_id", "host", F.size("w").cast("long").alias("n_words"), without(BLANKS).cast("long").alias("word_chars"),
        (F.length("t") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.expr(repeated(HASH_BITS)).alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_failed).  Sums are partial before the shuffle, so a
    host with a third of all rows is a few rows for each task."""
    hosts = measured.where("host is not null").groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    mean, var = hosts.agg(F.avg(rate), F.coalesce(F.var_pop(rate), F.lit(0.0))).first()
    mean, var = mean or 0.0, var or 0.0
    # moments of a beta distribution: var = mean (1 - mean) / (strength + 1)
    strength = min(1e6, max(1.0, mean * (1 - mean) / var - 1 if var > 0 else 1e6))
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") > max_rate)


def judged(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """measures() with host_rate, host_failed and kept."""
    measured = common.cut(measures(docs, text, host), "measures")
    # a hot host's rows are split by adaptive execution where the verdicts are too many to be broadcast
    verdicts = common.cut(host_verdicts(measured, max_rate).select("host", "host_rate", "host_failed"), "verdicts")
    if verdicts.limit(VERDICTS + 1).count() <= VERDICTS:
        verdicts = F.broadcast(verdicts)
    return measured.join(verdicts, "host", "left").withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False)))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(common.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL = r"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] as g
      from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
p as (select r, i from (select r, i, count(*) over (partition by r, g) as n from g) where n > 1),
q as (select r, count(distinct k) as n from (select r, unnest([i, i + 1, i + 2]) as k from p) group by r),
m as (select d.doc_id, d.source, cast(len(w.ws) as bigint) as n_words,
             cast(length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
             cast(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(w.ls) - len(list_distinct(w.ls)) as bigint) as n_dup_lines,
             cast(coalesce(q.n, 0) as bigint) as n_repeat_words
      from d join w using (r) left join q using (r)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
h as (select source, count(*) as n, sum(case when base_failed then 1 else 0 end) as b from f where source is not null group by source),
s as (select avg(b / n) as mean, var_pop(b / n) as v from h),
t as (select mean, case when v > 0 then least(1e6, greatest(1.0, mean * (1 - mean) / v - 1)) else 1e6 end as strength from s),
v as (select h.source, (h.b + t.mean * t.strength) / (h.n + t.strength) > 0.5 as bad from h, t)
select f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
       not f.base_failed and not coalesce(v.bad, false) as kept
from f left join v on f.source = v.source
"""
