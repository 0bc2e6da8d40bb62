"""Named queries over the driver's tables, with DuckDB SQL for each that SQL can express.

Each query applies an operator of the library to whole tables.  Lists are rendered as joined text, so that
values compare as scalars; amounts become DECIMAL before they become text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propweave import functions as fn
from propweave import model
from propweave.operators import collectors, enrich, matching, stats, text
from propweave.plans import lineage, shipped
from propweave.plans.program import Program, Rule, keep_records, parse
from propweave.sources import library, sinks, tables
from propweave.sources import text as text_source

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return tables.scan(spark, f"{d}/{name}.parquet")


def _money(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def order_props(spark: SparkSession, d: str) -> DataFrame:
    df = _t(spark, d, "orders").withColumn("o_totalprice", _money("o_totalprice"))
    return model.to_props(df, F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")), ORDER_COLUMNS)


ORDERS_SQL = """orders_p as (select 'ORD-' || o_orderkey as id, unnest([
  {'pos': 0, 'name': 'o_custkey', 'value': cast(o_custkey as varchar)}, {'pos': 1, 'name': 'o_orderstatus', 'value': o_orderstatus},
  {'pos': 2, 'name': 'o_totalprice', 'value': cast(cast(o_totalprice as decimal(18,2)) as varchar)}, {'pos': 3, 'name': 'o_orderpriority', 'value': o_orderpriority}], recursive := true) from orders)"""


def user_events(spark: SparkSession, d: str) -> DataFrame:
    """The events of each user, in order, as a record."""
    e = _t(spark, d, "events")
    return e.select(F.concat(F.lit("USR-"), F.col("user_id").cast("string")).alias("id"), F.col("event_id").cast("int").alias("pos"), F.col("event_type").alias("name"), F.col("event_id").cast("string").alias("value"))


EVENTS_SQL = "e as (select 'USR-' || user_id as id, cast(event_id as int) as pos, event_type as name, cast(event_id as varchar) as value from events)"


# sources and the record model


@query(f"with {ORDERS_SQL} select id, cast(pos as int) as pos, name, value from orders_p where value is not null")
def props_long(spark, d):
    return order_props(spark, d).select("id", "pos", "name", "value")


@query(f"with {ORDERS_SQL} select id, string_agg(name || '=' || value, ';' order by pos) as props from orders_p where value is not null group by id")
def props_array(spark, d):
    records = model.record_arrays(order_props(spark, d))
    return records.select("id", F.array_join(F.transform("props", lambda p: F.concat(p["name"], F.lit("="), p["value"])), ";").alias("props"))


@query("select 'USR-' || user_id as id, event_type as name, string_agg(cast(event_id as varchar), ',' order by event_id) as \"values\" from events group by all")
def multimap(spark, d):
    maps = model.multimap(user_events(spark, d)).select("id", F.explode("props").alias("name", "v"))
    return maps.select("id", "name", F.array_join("v", ",").alias("values"))


@query("select 'USR-' || user_id as id, string_agg(distinct event_type, ',' order by event_type) as \"values\" from events group by user_id")
def value_set(spark, d):
    rows = user_events(spark, d).select("id", F.col("name").alias("value"))
    return model.value_set(rows).select("id", F.array_join("values", ",").alias("values"))


@query("select 'EVT-' || event_id as id, unnest(['user', 'type']) as name, unnest([cast(user_id as varchar), event_type]) as value from events")
def file_prop_ingest(spark, d):
    e = _t(spark, d, "events")
    lines = e.select(F.concat(F.lit("EVT-"), F.col("event_id").cast("string"), F.lit("\tuser="), F.col("user_id").cast("string"), F.lit("\ttype="), "event_type", F.lit("\tbad\t=worse\tempty=")).alias("value"))
    return text_source.parse_props(lines).select("id", "name", "value")


@query("select cast(doc_id as varchar) as id, source as kind, cast(length(text) as bigint) as n from documents")
def raw_ingest(spark, d):
    docs = _t(spark, d, "documents")
    lines = docs.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "source", "text").alias("value"))
    raw = text_source.parse_raw(lines)
    return raw.select("id", "kind", F.length(F.element_at(F.map_values("raw"), 1)).cast("long").alias("n"))


@query("""select 'C-' || c_custkey as id, unnest(['name', 'nation']) as name, unnest([c_name, cast(c_nationkey as varchar)]) as value from customer
union all select 'S-' || s_suppkey, unnest(['name', 'nation']), unnest([s_name, cast(s_nationkey as varchar)]) from supplier""")
def multi_table_scan(spark, d):
    both = tables.scan_list(spark, "customer, supplier", d)
    key = F.coalesce(F.concat(F.lit("C-"), F.col("c_custkey").cast("string")), F.concat(F.lit("S-"), F.col("s_suppkey").cast("string")))
    named = both.select(key.alias("id"), F.coalesce("c_name", "s_name").alias("name"), F.coalesce("c_nationkey", "s_nationkey").alias("nation"))
    return model.to_props(named, F.col("id"), ["name", "nation"]).select("id", "name", "value")


@query("select o_orderkey, o_orderstatus from orders where o_orderkey >= 100 and o_orderkey < 900")
def range_scan(spark, d):
    return tables.range_scan(_t(spark, d, "orders"), "o_orderkey", 100, 900).select("o_orderkey", "o_orderstatus")


@query("select o_orderkey, o_orderstatus from orders where o_orderkey = 77")
def point_get(spark, d):
    return tables.point_get(_t(spark, d, "orders"), "o_orderkey", 77).select("o_orderkey", "o_orderstatus")


@query("select 'N-' || n_nationkey as id, unnest(['n_name', 'n_regionkey']) as name, unnest([n_name, cast(n_regionkey as varchar)]) as value from nation")
def cge_roundtrip(spark, d):
    props = model.to_props(_t(spark, d, "nation"), F.concat(F.lit("N-"), F.col("n_nationkey").cast("string")), ["n_name", "n_regionkey"])
    return model.decode_records(model.encode_records(props)).select("id", "name", "value")


@query("select 'CONV-' || conv_id as id, cast(turn as int) as ent_no, unnest(['role', 'text']) as name, unnest([role, text]) as value from conversations")
def cge_entities(spark, d):
    """Groups through the encoded form; the turn's number is carried by the order of the groups."""
    c = _t(spark, d, "conversations")
    props = model.to_entity_props(c, F.concat(F.lit("CONV-"), F.col("conv_id").cast("string")), "turn", F.col("turn"), ["role", "text"])
    first = c.groupBy(F.concat(F.lit("CONV-"), F.col("conv_id").cast("string")).alias("id")).agg(F.array_sort(F.collect_set(F.col("turn").cast("int"))).alias("turns"))
    back = model.decode_records(model.encode_records(props)).join(first, "id")
    return back.select("id", F.element_at("turns", F.col("ent_no")).alias("ent_no"), "name", "value")


@query("select 'USR-' || user_id as id, event_type as name, count(*) as n from events group by all")
def upsert_union(spark, d):
    """Ingesting the same properties twice stores them once."""
    e = user_events(spark, d).select("id", "pos", F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), "name", "value")
    return tables.upsert(spark, e, e).groupBy("id", "name").agg(F.count("*").alias("n"))


@query(f"with {ORDERS_SQL} select id || chr(9) || chr(9) || string_agg(name || '=' || value, chr(9) order by pos) as line from orders_p where value is not null group by id")
def text_print(spark, d):
    return sinks.grouped_lines(order_props(spark, d)).select("line")


# projections, filters, scalars


@query("select 'P-' || p_partkey as id, 'label' as name, p_brand as value from part union all select 'P-' || p_partkey, 'label', p_type from part")
def rename_alternatives(spark, d):
    props = model.to_props(_t(spark, d, "part"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")), ["p_name", "p_brand", "p_type"])
    return Program("rename", [Rule("p_brand|p_type", "label")])(props).select("id", "name", "value")


@query("select 'P-' || p_partkey as id, unnest(['p_name', 'p_type', 'rest']) as name, unnest([p_name, p_type, p_brand]) as value from part")
def wildcard_and_else(spark, d):
    props = model.to_props(_t(spark, d, "part"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")), ["p_name", "p_brand", "p_type"])
    return Program("wild", [Rule("p_n*"), Rule("p_?ype"), Rule("_else", "rest")])(props).select("id", "name", "value")


@query("""select l_orderkey, l_linenumber, l_returnflag from lineitem where l_returnflag = 'R' and l_linestatus <> 'O' and l_linenumber in (1, 2, 3)""")
def filter_chain(spark, d):
    li = _t(spark, d, "lineitem")
    keep = fn.one_of(F.col("l_linenumber").cast("string"), ["1", "2", "3"])
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "O") & keep.isNotNull()).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("""select p_partkey, regexp_extract(p_brand, '(\\d)(\\d)', 1) || '/' || regexp_extract(p_brand, '(\\d)(\\d)', 2) as code from part where regexp_matches(p_brand, '(\\d)(\\d)')""")
def regexp_format(spark, d):
    return _t(spark, d, "part").select("p_partkey", fn.match(F.col("p_brand"), r"(\d)(\d)", "${1}/${2}").alias("code")).where("code is not null")


STATUS = {"O": "open", "F": "finished"}


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' else 'finished' end as label from orders where o_orderstatus in ('O', 'F')")
def lookup_inner(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", fn.lookup(F.col("o_orderstatus"), STATUS).alias("label")).where("label is not null")


@query("select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'finished' else 'other' end as label from orders where o_orderstatus is not null")
def lookup_default(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", fn.lookup(F.col("o_orderstatus"), STATUS, "other").alias("label")).where("label is not null")


@query("""select c_custkey, substr(c_name, 3, 5) as piece, regexp_replace(c_name, '\\d', 'N', 'g') as mask, upper(trim(c_mktsegment)) as seg, '<' || c_mktsegment || '>' as wrapped from customer where length(c_name) > 2""")
def scalar_functions(spark, d):
    c = _t(spark, d, "customer")
    out = c.select("c_custkey", fn.slice_text(F.col("c_name"), 2, 7).alias("piece"), fn.mask_digits(F.col("c_name")).alias("mask"), fn.casefold(fn.trim(F.col("c_mktsegment")), "upper").alias("seg"), fn.compose(F.col("c_mktsegment"), "<", ">").alias("wrapped"))
    return out.where("piece is not null")


@query("""with t as (select doc_id, array_to_string(list_filter(list_sort(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\d]+'))), lambda x: length(x) >= 2), '') as k from documents)
select doc_id, k from t where length(k) >= 4""")
def magic_normalize(spark, d):
    return _t(spark, d, "documents").select("doc_id", fn.token_sort_key(F.col("text")).alias("k")).where("k is not null")


@query("""with b as (select p_partkey, '978' || lpad(cast(p_partkey as varchar), 9, '0') as s from part),
c as (select *, (10 - (list_sum([cast(substr(s, i, 1) as int) * (case when i % 2 = 0 then 3 else 1 end) for i in range(1, 13)])) % 10) % 10 as k from b)
select p_partkey, s || cast(cast(k as int) as varchar) as isbn from c""")
def isbn13_check(spark, d):
    """Part keys as ISBN-13 with each possible check digit: only the right one is kept."""
    p = _t(spark, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"))
    raw = F.concat(F.lit("978-"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.col("k").cast("string"))
    return p.select("p_partkey", fn.isbn13(raw).alias("isbn")).where("isbn is not null")


@query("select substr(cast(p_partkey as varchar), 1, n) as prefix, count(*) as n from (select p_partkey, unnest(range(1, length(cast(p_partkey as varchar)) + 1)) as n from part) group by 1")
def hierarchy_counts(spark, d):
    return stats.count_codes(_t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code")))


@query("select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as target from pages")
def html_links(spark, d):
    return _t(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("target"))


@query("select n_nationkey, unnest([n_name, 'R' || n_regionkey]) as target from nation")
def wiki_links(spark, d):
    markup = F.concat(F.lit("see [["), "n_name", F.lit("|a label]] and [[ R"), F.col("n_regionkey").cast("string"), F.lit("#top]] [[#x]] [[]]"))
    return _t(spark, d, "nation").select("n_nationkey", F.explode(fn.wiki_links(markup)).alias("target"))


@query("select n_nationkey, replace(replace(lower(nfc_normalize(n_name || 'u' || chr(776) || 'E' || chr(769))), 'a', 'ae'), 'i', 'y') as t, '<a href=\"x/' || n_name || '\">' || n_name || '</a>' as a from nation")
def set_replace_anchor(spark, d):
    n = _t(spark, d, "nation")
    return n.select("n_nationkey", fn.set_replace(F.lower(fn.nfc(F.concat("n_name", F.lit("u\u0308E\u0301")))), {"a": "ae", "i": "y"}).alias("t"), fn.html_anchor(F.col("n_name"), "x/").alias("a"))


# aggregations


@query(f"with {ORDERS_SQL} select name || value as key, name, value, count(*) as n from orders_p where name in ('o_orderstatus', 'o_orderpriority') group by all")
def prop_count(spark, d):
    props = Program("status", [Rule("o_orderstatus|o_orderpriority")])(order_props(spark, d))
    return stats.count_properties(props)


@query("""select event_type as name, 'U' || (user_id % 7) as "grp", count(*) as n from events group by all union all select event_type, 'ALL', count(*) from events group by event_type""")
def subtotal_all(spark, d):
    e = _t(spark, d, "events").select(F.concat(F.lit("U"), (F.col("user_id") % 7).cast("string")).alias("grp"), F.col("event_type").alias("name"))
    return enrich.subtotals(e, "grp")


@query("""with v as (select cast(c_custkey as varchar) as target from customer where c_mktsegment = 'BUILDING'),
r as (select cast(o_custkey as varchar) as target, o_orderstatus as type from orders semi join v on cast(o_custkey as varchar) = v.target)
select target, type, count(*) as n from r group by all union all select target, 'all', count(*) from r group by target""")
def beacon_counts(spark, d):
    valid = _t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("target"))
    refs = _t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("target"), F.col("o_orderstatus").alias("type"))
    return enrich.reference_counts(refs, valid)


@query("""select l_orderkey as "key", 'flag' as name, string_agg(distinct l_returnflag, ',' order by l_returnflag) as "values" from lineitem group by l_orderkey having count(distinct l_returnflag) > 1
union all select l_orderkey, 'status', string_agg(distinct l_linestatus, ',' order by l_linestatus) from lineitem group by l_orderkey having count(distinct l_linestatus) > 1""")
def bundle_check(spark, d):
    li = _t(spark, d, "lineitem")
    record = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    props = model.to_props(li.select(record.alias("id"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")), F.col("id"), ["flag", "status"])
    keys = li.select(record.alias("id"), F.col("l_orderkey").alias("key"))
    return enrich.conflicts(props, keys).select("key", "name", F.array_join("values", ",").alias("values"))


@query("select token, count(*) as n from (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\d]+')) as token from documents) group by token")
def token_count(spark, d):
    return text.count_tokens(_t(spark, d, "documents"))


@query()
def token_count_stemmed(spark, d):
    return text.count_tokens(_t(spark, d, "documents").where("lang = 'de'"), tokenizer="german")


@query("select distinct 'text' as field, token as term, doc_id as id from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\d]+')) as token from documents)")
def inverted_index(spark, d):
    return text.inverted_index(_t(spark, d, "documents"), "doc_id", {"text": "words"})


@query("select regexp_replace(cast(cast(o_orderdate as date) as varchar), '\\d', 'N', 'g') as mask, o_orderstatus as status, count(*) as n from orders group by all")
def pattern_histogram(spark, d):
    o = _t(spark, d, "orders")
    return stats.histogram(o, fn.mask_digits(F.col("o_orderdate").cast("date").cast("string")).alias("mask"), F.col("o_orderstatus").alias("status"))


@query("select least(400, count(*)) as n, least(400, count(*)) as found, cast(400 as bigint) as wanted from documents")
def uniform_sample(spark, d):
    """How many rows are drawn, and how many different ones of them are rows of the table."""
    docs = _t(spark, d, "documents").select("doc_id")
    drawn = stats.uniform_sample(docs, 400)
    marked = drawn.withColumn("drawn", F.lit(1)).join(docs.distinct().withColumn("there", F.lit(1)), "doc_id", "left")
    return marked.agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("there") == 1, F.col("doc_id"))).alias("found")).select("n", "found", F.lit(400).cast("long").alias("wanted"))


# collectors


@query(f"with {EVENTS_SQL}, k as (select *, row_number() over (partition by id order by pos) as k from e) select id, pos, name from k where k = 3")
def nth_occurrence(spark, d):
    return collectors.nth(user_events(spark, d), 3).select("id", "pos", "name")


@query(f"with {EVENTS_SQL} select id, pos, cast(row_number() over (partition by id order by pos) as varchar) as value from e")
def running_count(spark, d):
    return collectors.running_count(user_events(spark, d)).select("id", "pos", "value")


@query(f"with {EVENTS_SQL} select id, name as value, min(pos) as pos from e group by id, name")
def unique_in_record(spark, d):
    return collectors.unique(user_events(spark, d).select("id", "pos", F.col("name").alias("value"))).select("id", "value", "pos")


def _kinds(e: DataFrame, *names: str) -> dict[str, DataFrame]:
    return {n: e.where(F.col("name") == n).select("id", "pos", "value") for n in names}


@query(f"""with {EVENTS_SQL}, s as (select *, last_value(case when name = 'view' then value end ignore nulls) over w as v, last_value(case when name = 'click' then value end ignore nulls) over w as c
from e where name in ('view', 'click') window w as (partition by id order by pos rows between unbounded preceding and current row))
select id, pos, v || '-' || c as value from s where v is not null and c is not null""")
def combine_latest(spark, d):
    return collectors.combine_latest(_kinds(user_events(spark, d), "view", "click"), "${view}-${click}").select("id", "pos", "value")


@query(f"""with {EVENTS_SQL}, l as (select id, max_by(value, pos) as v from e where name = 'view' group by id) select e.id, e.pos, e.value || ':' || l.v as value from e join l using (id) where e.name = 'click'""")
def combine_buffered(spark, d):
    return collectors.combine_buffered(_kinds(user_events(spark, d), "view", "click"), "click", "${click}:${view}").select("id", "pos", "value")


@query(f"""with recursive {EVENTS_SQL}, r as (select id, value, name, row_number() over (partition by id order by pos) as k from e where name in ('view', 'click')),
f(id, k, v, c, value) as (select distinct id, cast(0 as bigint), cast(null as varchar), cast(null as varchar), cast(null as varchar) from r
  union all select id, k, case when nv is null or nc is null then nv end, case when nv is null or nc is null then nc end, nv || '+' || nc
  from (select f.id, r.k, case when r.name = 'view' then r.value else f.v end as nv, case when r.name = 'click' then r.value else f.c end as nc from f join r on r.id = f.id and r.k = f.k + 1))
select id, value from f where value is not null""")
def combine_reset(spark, d):
    return collectors.combine_reset(_kinds(user_events(spark, d), "view", "click"), "${view}+${click}").select("id", "value")


@query(f"""with {EVENTS_SQL} select id, coalesce(max_by(value, pos) filter (where name = 'purchase'), '') || '/' || coalesce(max_by(value, pos) filter (where name = 'view'), '') as value
from e where name in ('purchase', 'view') group by id""")
def combine_flush(spark, d):
    return collectors.combine_flush(_kinds(user_events(spark, d), "purchase", "view"), "${purchase}/${view}").select("id", "value")


@query(f"""with {EVENTS_SQL} select id, coalesce(max_by(value, pos) filter (where name = 'purchase'), max_by(value, pos) filter (where name = 'click')) as value from e where name in ('purchase', 'click') group by id""")
def choose_fallback(spark, d):
    k = _kinds(user_events(spark, d), "purchase", "click")
    return collectors.choose([k["purchase"], k["click"]]).select("id", "value")


@query("select 'CUST-' || c_custkey as id, 'none' as value from customer anti join (select * from orders where o_orderstatus = 'P' and o_totalprice > 100000) on c_custkey = o_custkey")
def not_exists_flag(spark, d):
    records = _t(spark, d, "customer").select(F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("id"))
    orders = _t(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 100000").select(F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("id"))
    return collectors.absent(records, orders, "none").select("id", "value")


@query("select 'ORD-' || l_orderkey as id, '[' || string_agg(cast(l_partkey as varchar), ',' order by l_linenumber, cast(l_partkey as varchar)) || ']' as value from lineitem group by l_orderkey")
def concat_ordered(spark, d):
    li = _t(spark, d, "lineitem").select(F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").cast("string").alias("value"))
    return collectors.concat(li, ",", "[", "]").select("id", "value")


def _line_flags(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    li = _t(spark, d, "lineitem")
    rid = F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("id")
    return {n: li.select(rid, F.col("l_linenumber").alias("pos"), F.col(c).alias("value")).dropDuplicates(["id", "value"]) for n, c in (("flag", "l_returnflag"), ("status", "l_linestatus"))}


@query("select distinct 'ORD-' || a.l_orderkey as id, a.l_returnflag || '~' || b.l_linestatus as value from lineitem a join lineitem b using (l_orderkey)")
def tuples_pairs(spark, d):
    return collectors.tuples(_line_flags(spark, d), "~").select("id", "value")


@query("select distinct 'ORD-' || a.l_orderkey as id, a.l_returnflag || '&' || b.l_returnflag as value from lineitem a join lineitem b using (l_orderkey) where a.l_returnflag < b.l_returnflag")
def square_pairs(spark, d):
    return collectors.square(_line_flags(spark, d)["flag"], "&").select("id", "value")


@query("select 'CONV-' || conv_id as id, cast(turn as int) as ent_no, role || ': ' || length(text) as value from conversations")
def entity_flush(spark, d):
    c = _t(spark, d, "conversations").withColumn("size", F.length("text"))
    props = model.to_entity_props(c, F.concat(F.lit("CONV-"), F.col("conv_id").cast("string")), "turn", F.col("turn"), ["role", "size"])
    part = {n: props.where(F.col("name") == n).select("id", "ent_no", "pos", "value") for n in ("role", "size")}
    return collectors.combine_flush(part, "${role}: ${size}", entity=True).select("id", "ent_no", "value")


PROGRAM = """<metamorph><meta><name>orders</name></meta>
<rules>
  <data source="o_orderstatus" name="status"><lookup in="states"/></data>
  <data source="o_orderpriority" name="@urgent"><regexp match="^[12]" /></data>
  <combine name="key" value="${c}/${u}"><data source="o_custkey" name="c"/><data source="@urgent" name="u"/></combine>
  <choose name="rank"><data source="@urgent" /><data source="_id" name="x"><constant value="9"/></data></choose>
</rules>
<maps><map name="states" default="other"><entry name="O" value="open"/><entry name="F" value="finished"/></map></maps></metamorph>"""


@query(f"""with {ORDERS_SQL}, o as (select 'ORD-' || o_orderkey as id, * from orders)
select id, 'status' as name, case o_orderstatus when 'O' then 'open' when 'F' then 'finished' else 'other' end as value from o where o_orderstatus is not null
union all select id, 'key', o_custkey || '/' || substr(o_orderpriority, 1, 1) from o where regexp_matches(o_orderpriority, '^[12]')
union all select id, 'rank', case when regexp_matches(o_orderpriority, '^[12]') then substr(o_orderpriority, 1, 1) else '9' end from o""")
def rule_program(spark, d):
    return parse(PROGRAM)(order_props(spark, d)).select("id", "name", "value")


@query(f"with {ORDERS_SQL} select id, count(*) as n, string_agg(name || '=' || value, ';' order by pos) as props from orders_p where value is not null and id in (select id from orders_p where name = 'o_orderstatus' and value = 'P') group by id")
def record_filter(spark, d):
    """Whole records for which a program emits something."""
    only = Program("p", [Rule("o_orderstatus", steps=[lambda v: F.when(v == "P", v)])])
    kept = keep_records(order_props(spark, d), only)
    one = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws("=", "name", "value").alias("x"))))
    return kept.groupBy("id").agg(F.count("*").alias("n"), F.array_join(F.transform(one, lambda p: p["x"]), ";").alias("props"))


# matching


def document_keys(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents")
    record = F.concat_ws("-", "source", F.col("doc_id").cast("string"))
    start = F.concat(F.lit("T-"), F.substring(F.lower(F.regexp_replace("text", r"\W", "")), 1, 50))
    size = F.concat(F.lit("L-"), "lang", F.lit("-"), F.col("n_chars").cast("string"))
    return docs.select(record.alias("id"), F.explode(F.array(start, size)).alias("key"))


KEYS_SQL = """k as (select source || '-' || doc_id as id, unnest(['T-' || left(lower(regexp_replace(text, '\\W', '', 'g')), 50), 'L-' || lang || '-' || n_chars]) as key from documents),
p as (select id, min(key) as mk from k group by id), m as (select 'doc$' || mk as bundle_id, id from p)"""


@query(f"with {KEYS_SQL}, o as (select p.mk, k.key from k join p using (id) where k.key <> p.mk) select 'doc$' || mk as bundle_id, count(distinct id) as n, string_agg(distinct id, ',' order by id) as members, (select string_agg(distinct 'doc$' || o.key, ',' order by 'doc$' || o.key) from o where o.mk = p.mk) as eq from p group by mk")
def match_bundles(spark, d):
    b = matching.match(document_keys(spark, d), "doc")
    eq = F.nullif(F.array_join("eq", ","), F.lit(""))
    return b.select("bundle_id", F.size("contains").cast("long").alias("n"), F.array_join("contains", ",").alias("members"), eq.alias("eq"))


@query(f"with {KEYS_SQL} select distinct a.id as id1, b.id as id2 from m a join m b using (bundle_id) where a.id <> b.id")
def match_list(spark, d):
    return matching.match_list(matching.memberships(document_keys(spark, d), "doc"))


@query(f"""with {KEYS_SQL}, h as (select bundle_id, split_part(id, '-', 1) as inst, count(*) as n from m group by all)
select 'doc' as alg, a.inst as i, b.inst as j, cast(sum(case when a.inst = b.inst then a.n - 1 else b.n end) as bigint) as overlap from h a join h b using (bundle_id) group by all""")
def match_overlap(spark, d):
    return matching.match_overlap(matching.memberships(document_keys(spark, d), "doc"))


@query(f"""with {KEYS_SQL}, s as (select bundle_id, count(*) as size from m group by all)
select 'doc' as alg, 'size:' || size as measure, count(*) as n from s group by all union all select 'doc', 'inst:' || split_part(id, '-', 1), count(*) from m group by all
union all select 'doc', 'groups', count(*) from s union all select 'doc', 'total', count(*) from m""")
def bundle_stats(spark, d):
    return matching.bundle_stats(matching.memberships(document_keys(spark, d), "doc"))


REDIRECTS_SQL = f"""{KEYS_SQL}, ed as (select distinct 'doc$' || p.mk as a, 'doc$' || k.key as b from k join p using (id) where k.key <> p.mk),
e2 as (select a, b from ed union select b, a from ed), cc(n, l) as (select a, a from e2 union select e2.b, cc.l from cc join e2 on e2.a = cc.n),
rd as (select n as node, min(l) as redirect from cc group by n having min(l) <> n)"""


@query(f"with recursive {REDIRECTS_SQL} select node, redirect from rd")
def union_redirects(spark, d):
    return matching.redirects(matching.bundle_edges(matching.match(document_keys(spark, d), "doc")))


@query(f"with recursive {REDIRECTS_SQL} select distinct coalesce(redirect, bundle_id) as bundle_id, id from m left join rd on rd.node = m.bundle_id")
def bundle_move(spark, d):
    keys = document_keys(spark, d)
    moved = matching.redirects(matching.bundle_edges(matching.match(keys, "doc")))
    return matching.move_members(matching.memberships(keys, "doc"), moved)


@query(f"""with recursive {KEYS_SQL}, e as (select distinct a.id as s, b.id as t from k a join k b on a.key = b.key and a.id <> b.id),
cc(n, l) as (select id, id from (select distinct id from k) union select e.t, cc.l from cc join e on e.s = cc.n) select n as id, min(l) as rep from cc group by n""")
def dedupe(spark, d):
    return matching.dedupe(document_keys(spark, d))


# joins


@query("select 'CUST-' || o_custkey as id, 'order' as name, 'ORD-' || o_orderkey as value from orders union all select 'CUST-' || c_custkey, 'segment', c_mktsegment from customer where c_mktsegment is not null")
def rekey_join(spark, d):
    """Orders send a property to their customers, where it meets the customers' own."""
    sent = order_props(spark, d).where("name = 'o_custkey'").withColumn("name", F.concat(F.lit("{to:CUST-"), "value", F.lit("}order"))).withColumn("value", F.col("id"))
    own = model.to_props(_t(spark, d, "customer"), F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")), ["c_mktsegment"]).withColumn("name", F.lit("segment"))
    return enrich.rekey_join(sent.unionByName(own), lambda p: p).select("id", "name", "value")


@query("select 'N-' || n_nationkey as id, 'R-' || n_regionkey as parent, r_name as value from nation join region on n_regionkey = r_regionkey")
def parent_child(spark, d):
    n = _t(spark, d, "nation").select(F.concat(F.lit("N-"), F.col("n_nationkey").cast("string")).alias("rid"), F.concat(F.lit("R-"), F.col("n_regionkey").cast("string")).alias("part_of"), F.lit(None).cast("string").alias("title"))
    r = _t(spark, d, "region").select(F.concat(F.lit("R-"), F.col("r_regionkey").cast("string")).alias("rid"), F.lit(None).cast("string").alias("part_of"), F.col("r_name").alias("title"))
    return enrich.parent_to_child(n.unionByName(r), F.col("part_of"), F.col("title"), F.col("rid"))


@query("select o_custkey as \"key\", o_orderstatus as value, count(*) as n from orders group by all")
def rekey_by_value(spark, d):
    props = order_props(spark, d)
    moved = enrich.rekey(props, "o_custkey").where("name = 'o_orderstatus'")
    return moved.groupBy(F.col("id").cast("long").alias("key"), "value").agg(F.count("*").alias("n"))


@query("select c_custkey from customer anti join (select * from orders where o_orderpriority like '1%') on c_custkey = o_custkey")
def unused_ids(spark, d):
    return enrich.without(_t(spark, d, "customer"), _t(spark, d, "orders").where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@query("select c_custkey, coalesce(n, 0) as n from customer left join (select o_custkey, count(*) as n from orders group by 1) on c_custkey = o_custkey")
def left_with_default(spark, d):
    n = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return _t(spark, d, "customer").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


# elements of programs


def _rules(rules: str, more: str = "") -> str:
    return f"<metamorph>{more}<rules>{rules}</rules></metamorph>"


@query("""select 'ORD-' || o_orderkey as id, 'buyer' as ent, unnest(['number', 'rank']) as name, unnest([cast(o_custkey as varchar), substr(o_orderpriority, 1, 1)]) as value from orders""")
def entity_group(spark, d):
    program = _rules('<entity name="buyer" flushWith="record"><data source="o_custkey" name="number"/><data source="o_orderpriority" name="rank"><substring start="0" end="1"/></data></entity>')
    return parse(program)(order_props(spark, d)).select("id", "ent", "name", "value")


@query("""select 'ORD-' || o_orderkey as id, unnest(['state', 'urgency']) as name, unnest(['state:' || lower(o_orderstatus), 'urgency:' || lower(o_orderpriority)]) as value from orders""")
def macro_program(spark, d):
    macros = '<macros><macro name="tag"><data source="$[field]" name="$[out]"><case to="lower"/><compose prefix="$[out]$[mark]"/></data></macro></macros><vars><var name="mark" value=":"/></vars>'
    calls = '<call-macro name="tag" field="o_orderstatus" out="state"/><call-macro name="tag" field="o_orderpriority" out="urgency"/>'
    return parse(_rules(calls, macros))(order_props(spark, d)).select("id", "name", "value")


@query("select 'USR-' || user_id as id, cast(count(*) as varchar) as value from events where event_type in ('view', 'click') group by user_id having count(*) >= 10")
def count_program(spark, d):
    """The number of a record's values, where it has two digits or more."""
    e = user_events(spark, d).select("*", F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"))
    rules = '<choose name="size"><data source="view|click"><count/></data><postprocess><regexp match="^\\d\\d+$"/></postprocess></choose>'
    return parse(_rules(rules))(e).select("id", "value")


@query("select 'C-' || c_custkey as id, coalesce(n_name, 'nowhere') as value from customer left join nation on c_nationkey = n_nationkey and n_regionkey < 3")
def filemap_program(spark, d):
    """A map that a program reads from a file."""
    path = lineage.new_path(spark, "map")
    _t(spark, d, "nation").where("n_regionkey < 3").select(F.concat_ws("\t", F.col("n_nationkey").cast("string"), "n_name").alias("value")).write.text(path)
    program = parse(_rules('<data source="c_nationkey" name="nation"><lookup in="nations" default="nowhere"/></data>', f'<maps><filemap name="nations" files="{path}"/></maps>'), spark)
    c = _t(spark, d, "customer")
    return program(model.to_props(c, F.concat(F.lit("C-"), F.col("c_custkey").cast("string")), ["c_nationkey"])).select("id", "value")


@query("select 'C-' || c_custkey as id, coalesce(n_name, 'nowhere') as value from customer left join nation on c_nationkey = n_nationkey and n_regionkey < 3")
def lookup_table_join(spark, d):
    table = _t(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"))
    c = model.to_props(_t(spark, d, "customer"), F.concat(F.lit("C-"), F.col("c_custkey").cast("string")), ["c_nationkey"])
    return enrich.lookup_join(c, table, "nowhere").select("id", "value")


@query("select 'CONV-' || conv_id as id, case when length(text) > 200 then cast(length(text) as varchar) else 'missing' end as value from conversations")
def entity_source(spark, d):
    """A value for each group: one of its properties, or a constant where the group has none of that name."""
    c = _t(spark, d, "conversations").withColumn("long", F.when(F.length("text") > 200, F.length("text").cast("string")))
    props = model.to_entity_props(c, F.concat(F.lit("CONV-"), F.col("conv_id").cast("string")), "turn", F.col("turn"), ["role", "long"])
    rules = '<choose name="size" flushWith="turn"><data source="turn.long"/><data source="turn"><constant value="missing"/></data></choose>'
    return parse(_rules(rules))(props).select("id", "value")


@query("select id, 't' || substr(c, 1, n) as value from (select 'ORD-' || o_orderkey as id, cast(o_custkey as varchar) as c, unnest(range(0, length(cast(o_custkey as varchar)))) as n from orders)")
def recursive_feedback(spark, d):
    """A rule that feeds itself: a code, cut at its end until nothing is left."""
    rules = '<data source="o_custkey" name="@start"><compose prefix="t"/></data><data source="@code|@start" name="@code"><regexp match="^(t\\d*)\\d$" format="${1}"/></data><data source="@code" name="code"/>'
    return parse(_rules(rules))(order_props(spark, d)).select("id", "value")


# programs that come with the library


def library_props(spark: SparkSession, d: str) -> DataFrame:
    """Parts and orders as bibliographic records."""
    p = _t(spark, d, "part")
    number = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    p = p.select(F.concat(F.lit("P"), (F.col("p_partkey") % 3).cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias("key"), (F.col("p_partkey") % 50).cast("string").alias("number"), F.col("p_name").alias("title"), F.concat(F.lit("c"), (1900 + F.col("p_size")).cast("string"), F.lit(".")).alias("year"), F.col("p_brand").alias("person"), F.col("p_type").alias("publisher"), F.when(F.col("p_partkey") % 2 == 0, F.concat_ws(" ", F.lit("vol."), (F.col("p_partkey") % 4).cast("string"))).alias("volume"), F.when(F.col("p_partkey") % 3 == 0, F.concat((F.col("p_partkey") % 5).cast("string"), F.lit(". ed."))).alias("edition"), F.substring("p_type", 1, 3).alias("kind"), F.concat(F.lit("978"), number, F.lit("0")).alias("isbn"), F.col("p_brand").alias("subject"), F.substring("p_type", 1, 2).alias("class"))
    return model.to_props(p, F.col("key"), ["number", "title", "year", "person", "publisher", "volume", "edition", "kind", "isbn", "subject", "class"])


LIBRARY_SQL = """p as (select 'P' || (p_partkey % 3) || '-' || p_partkey as id, 'P' || (p_partkey % 3) as inst, cast(p_partkey % 50 as varchar) as number, left(lower(regexp_replace(p_name, '[^\\p{L}\\d]', '', 'g')), 40) as title,
  cast(1900 + p_size as varchar) as year, left(lower(regexp_replace(p_brand, '[^\\p{L}\\d]', '', 'g')), 40) as person, left(lower(regexp_replace(p_type, '[^\\p{L}\\d]', '', 'g')), 40) as publisher,
  case when p_partkey % 2 = 0 then cast(p_partkey % 4 as varchar) end as volume, case when p_partkey % 3 = 0 then cast(p_partkey % 5 as varchar) end as edition, left(p_type, 3) as kind, p_brand as subject, left(p_type, 2) as class,
  '978' || lpad(cast(p_partkey as varchar), 9, '0') || '0' as isbn0 from part),
q as (select *, case when list_sum([cast(substr(isbn0, i, 1) as int) * (case when i % 2 = 0 then 3 else 1 end) for i in range(1, 14)]) % 10 = 0 then isbn0 end as isbn from p)"""


@query(f"""with {LIBRARY_SQL}, k as (select unnest(['number', 'number-inst', 'isbn', 'isbn-year', 'isbn-volume', 'isbn-edition', 'title-year', 'title-person', 'title-person-year', 'title-publisher-year', 'title-edition', 'title-volume', 'kind-title-year', 'person-year', 'work']) as algorithm,
 unnest([number, inst || ':' || number, isbn, isbn || '-' || year, isbn || '-' || coalesce(volume, '0'), isbn || '-' || coalesce(edition, '1'), title || '-' || year, title || '-' || person, title || '-' || person || '-' || year, title || '-' || publisher || '-' || year,
 title || '-' || edition, title || '-' || volume, upper(kind) || '-' || title || '-' || year, person || '-' || year, person || '-' || title]) as key from q)
select algorithm, key, count(*) as n from k where key is not null group by all""")
def match_algorithms(spark, d):
    """The keys of all match algorithms that come with the library, counted."""
    props = library_props(spark, d)
    keys = [shipped.program(name)(props).select(F.lit(name).alias("algorithm"), F.col("value").alias("key")) for name in shipped.MATCHING]
    whole = keys[0]
    for k in keys[1:]:
        whole = whole.unionByName(k)
    return whole.groupBy("algorithm", "key").agg(F.count("*").alias("n"))


@query(f"with {LIBRARY_SQL} select id, edition || '. ed./vol. ' || volume as value from q where edition is not null and volume is not null")
def check_program(spark, d):
    return shipped.program("check-edition-volume")(library_props(spark, d)).select("id", "value")


@query(f"with {LIBRARY_SQL} select year || '-' || kind as value, count(*) as n from q group by all")
def statistics_program(spark, d):
    return stats.count_properties(shipped.program("year-kind")(library_props(spark, d))).select("value", "n")


@query(f"with {LIBRARY_SQL} select class || '=' || subject as value, count(*) as n from q group by all")
def cross_walk_program(spark, d):
    return stats.count_properties(shipped.program("cross-walk")(library_props(spark, d))).select("value", "n")


@query(f"with {LIBRARY_SQL} select id, unnest(['t', 'n', 'n', 'y']) as name, unnest([lower(p_name), subject, p_type, year]) as value from q join (select 'P' || (p_partkey % 3) || '-' || p_partkey as id, p_name, p_type from part) using (id)")
def index_program(spark, d):
    return shipped.program("index")(library_props(spark, d)).select("id", "name", "value")


# library exchange formats

_SUPPLIER_ROWS = "select s_suppkey, s_name, s_nationkey from supplier"
_BAD_SQL = "select 'error:' || sha1('broken ' || s_suppkey) as id, 'error' as name, '{0}' as value from supplier"


def _with_bad(spark: SparkSession, d: str, lines: DataFrame) -> DataFrame:
    return lines.unionByName(_t(spark, d, "supplier").select(F.concat(F.lit("broken "), F.col("s_suppkey").cast("string")).alias("value")))


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "supplier").withColumn("year", F.concat(F.lit("[ca. "), (1900 + F.col("s_nationkey")).cast("string"), F.lit("]")))


_SUPPLIER_SQL = "select 'X-' || s_suppkey as id, unnest(['number', 'title', 'year']) as name, unnest([cast(s_suppkey as varchar), s_name || ' ü', cast(1900 + s_nationkey as varchar)]) as value from supplier"


@query(_SUPPLIER_SQL + " union all " + _BAD_SQL.format("no record id"))
def pica_ingest(spark, d):
    s = _suppliers(spark, d).withColumn("title", F.concat("s_name", F.lit(" ü")))
    lines = _with_bad(spark, d, library.encode_pica(s, F.col("s_suppkey"), {"021A$a": "title", "011@$a": "year"}))
    return library.ingest(lines, "pica", shipped.program("map-pica"), "X-").select("id", "name", "value")


@query(_SUPPLIER_SQL + " union all " + "select 'error:' || sha1('broken ' || s_suppkey), 'error', 'ValueError' from supplier")
def marc21_ingest(spark, d):
    s = _suppliers(spark, d).withColumn("title", F.concat("s_name", F.lit(" ü")))
    lines = _with_bad(spark, d, library.encode_marc21(s, F.col("s_suppkey"), {"245$a": "title", "260$c": "year"}))
    props = library.ingest(lines, "marc21", shipped.program("map-marc21"), "X-")
    return props.select("id", "name", F.when(F.col("name") == "error", F.substring_index("value", ":", 1)).otherwise(F.col("value")).alias("value"))


@query(_SUPPLIER_SQL)
def mab2_ingest(spark, d):
    s = _suppliers(spark, d).withColumn("title", F.concat("s_name", F.lit(" ü")))
    lines = library.encode_mab2(s, F.col("s_suppkey"), {"331": "title", "425": "year"})
    return library.ingest(lines, "mab2", shipped.program("map-mab2"), "X-").select("id", "name", "value")


@query("select 'X-' || s_suppkey as id, 'mab2' as kind, cast(24 + 4 + length(cast(s_suppkey as varchar)) + 1 + 4 + length(s_name) + 2 as bigint) as n from supplier union all select 'error:' || sha1('broken ' || s_suppkey), 'mab2', length('broken ' || s_suppkey) from supplier")
def raw_copies(spark, d):
    lines = _with_bad(spark, d, library.encode_mab2(_suppliers(spark, d), F.col("s_suppkey"), {"331": "s_name"}))
    return library.raw_records(lines, "mab2", "X-").select("id", "kind", F.length("raw").cast("long").alias("n"))


@query("select cast(1900 + s_nationkey as varchar) as value, count(*) as n from supplier group by all")
def file_count(spark, d):
    """Lines of a format in files, through a program, counted."""
    path = lineage.new_path(spark, "lines")
    library.encode_mab2(_suppliers(spark, d), F.col("s_suppkey"), {"331": "s_name", "425": "year"}).write.text(path)
    return library.file_count(spark, path, "mab2", shipped.program("map-mab2")).where("name = 'year'").select("value", "n")


@query("select cast(s_suppkey as varchar) as id, s_suppkey || chr(9) || chr(9) || 'number=' || s_suppkey || chr(9) || 'title=' || s_name || chr(9) || 'year=' || (1900 + s_nationkey) as line from supplier")
def file_morph(spark, d):
    path = lineage.new_path(spark, "lines")
    library.encode_pica(_suppliers(spark, d), F.col("s_suppkey"), {"021A$a": "s_name", "011@$a": "year"}).write.text(path)
    return library.file_morph(spark, path, "pica", shipped.program("map-pica"))


@query("select 'X' || s_suppkey as id, unnest(['title', 'person']) as name, unnest([s_name, cast(s_nationkey as varchar)]) as value from supplier")
def csv_file(spark, d):
    path = lineage.new_path(spark, "csv")
    _t(spark, d, "supplier").select(F.concat(F.lit("X"), F.col("s_suppkey").cast("string")).alias("key"), F.col("s_name").alias("title"), F.col("s_nationkey").alias("person")).write.option("header", True).csv(path)
    return library.csv_props(spark, path, "key").select("id", "name", "value")


@query("select cast(s_suppkey as varchar) as id, unnest(['authority.typ', 'authority.gnd', 'metadata.name']) as name, unnest(['p', '10' || s_suppkey, s_name]) as value from supplier")
def wiki_templates(spark, d):
    """Authority and metadata templates of wiki pages."""
    page = F.concat(F.lit("Text [[a|b]] {{Normdaten|TYP=p|GND=10"), F.col("s_suppkey").cast("string"), F.lit("|LCCN=|}} more {{Personendaten\n|NAME="), "s_name", F.lit("\n|ORT= }} end"))
    pages = _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), page.alias("text"))
    both = text_source.template_props(pages, "Normdaten", "authority").unionByName(text_source.template_props(pages, "Personendaten", "metadata"))
    return both.select("id", "name", "value")


# enrichment over bundles


def _classified(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, d, "orders")
    key = F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    made = o.withColumn("ddc", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))).withColumn("rvk", F.when(F.substring("o_orderpriority", 1, 1) < "4", F.substring("o_orderpriority", 1, 1)))
    return model.to_props(made, key, ["ddc", "rvk"]), o.select(F.concat(F.lit("B-"), F.col("o_custkey").cast("string")).alias("bundle_id"), key.alias("id"))


_CLASSES_SQL = "c as (select 'ORD-' || o_orderkey as id, 'B-' || o_custkey as bundle, nullif(o_orderstatus, 'P') as ddc, case when substr(o_orderpriority, 1, 1) < '4' then substr(o_orderpriority, 1, 1) end as rvk from orders)"


@query(f"with {_CLASSES_SQL} select bundle as id, unnest(['ddc', 'rvk']) as name, unnest([id || ':' || ddc, id || ':' || rvk]) as value from c where ddc is not null and rvk is not null")
def bundle_transfer(spark, d):
    props, members = _classified(spark, d)
    return enrich.transfer(props, members, ["ddc", "rvk"])


@query(f"with {_CLASSES_SQL}, g as (select bundle, string_agg(id || ':' || rvk, ';' order by id || ':' || rvk) as value from c where rvk is not null group by bundle) select c.id, g.value from c join g using (bundle) where c.rvk is null")
def bundle_inherit(spark, d):
    """Extract, combine by bundle, enrich: what members lack, from the bundle's others."""
    props, members = _classified(spark, d)
    return enrich.inherit(props, members, "rvk")


@query("""with n as (select o_custkey as target, o_orderstatus as type, count(*) as n from orders group by all)
select type, unnest(['#FORMAT: PND-BEACON', '#VERSION: 0.1', '#TARGET: http://example.org/{ID}', '#DESCRIPTION: orders']) as value from (select distinct type from n) union all select type, target || '|' || n from n""")
def beacon_file(spark, d):
    counts = _t(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("target"), F.col("o_orderstatus").alias("type")).agg(F.count("*").alias("n"))
    return sinks.beacon_lines(counts, "http://example.org/{ID}", {"DESCRIPTION": "orders"}).select("type", "value")


@query("select 'all' as name, cast(count(*) as bigint) as n from (select unnest([1, 2]) from orders where o_orderpriority is not null and o_orderstatus is not null) union all select 'errors', cast(0 as bigint)")
def job_counters(spark, d):
    """Counters of a pass over properties, as observed metrics of the job itself."""
    props, seen = library.counted(model.to_props(_t(spark, d, "orders"), F.col("o_orderkey").cast("string"), ["o_orderstatus", "o_orderpriority"]))
    lineage.cut(props, "counted")
    return spark.createDataFrame([("all", seen.get["properties"]), ("errors", seen.get["errors"])], "name string, n long")


@query("select 'P-' || p_partkey as id, 'InvalidISBN: ' || isbn as value from (select p_partkey, '978' || lpad(cast(p_partkey as varchar), 9, '0') || '0' as isbn from part) where list_sum([cast(substr(isbn, i, 1) as int) * (case when i % 2 = 0 then 3 else 1 end) for i in range(1, 14)]) % 10 <> 0")
def invalid_values(spark, d):
    """Error properties for values that fail a check."""
    p = _t(spark, d, "part").withColumn("isbn", F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit("0")))
    props = model.to_props(p, F.concat(F.lit("P-"), F.col("p_partkey").cast("string")), ["isbn"])
    return enrich.invalid(props, "isbn", fn.isbn13, "InvalidISBN").select("id", "value")


@query("select 'C-' || o_custkey as id, 'ordered' as name, o_orderpriority as value, count(*) as n from (select distinct o_custkey, o_orderpriority from orders) group by all union all select 'C-' || c_custkey, 'name', c_name, 1 from customer")
def stored_table(spark, d):
    """Properties moved to other records by one program, and stored; then others into the same table, one of them again."""
    path = lineage.new_path(spark, "table")
    o = _t(spark, d, "orders").select(F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("id"), F.lit(0).alias("pos"), F.lit(None).cast("int").alias("ent_no"), F.lit(None).cast("string").alias("ent"), F.concat(F.lit("{to:C-"), F.col("o_custkey").cast("string"), F.lit("}ordered")).alias("name"), F.col("o_orderpriority").alias("value"))
    tables.store(spark, path, enrich.apply_redirects(o))
    c = _t(spark, d, "customer").withColumnRenamed("c_name", "name")
    tables.store(spark, path, model.to_props(c, F.concat(F.lit("C-"), F.col("c_custkey").cast("string")), ["name"]).unionByName(enrich.apply_redirects(o.limit(5))))
    return spark.read.parquet(path).groupBy("id", "name", "value").agg(F.count("*").alias("n"))
