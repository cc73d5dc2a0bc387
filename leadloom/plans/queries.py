"""The library's operators applied to the driver's tables, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadloom.functions import geo, pages, people, text
from leadloom.operators import cascade, cover, delta, graph, joins, merge, ranking, registry, reports, rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query by its function's name."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f
    return add


# --- merges -----------------------------------------------------------------------------------------------------------

@query("""
select user_id, coalesce(arg_min(v, event_id) filter (where v <> ''), '') as first_value,
  (select string_agg(event_type, '|' order by o) from (select event_type, min(event_id) as o from events e2 where e2.user_id = e.user_id group by event_type)) as tags
from (select *, case when value < 5 then '' else cast(event_type as varchar) || '#' || cast(event_id as varchar) end as v from events) e group by user_id
""")
def first_nonempty_merge(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.withColumn("first_value", F.when(F.col("value") < 5, "").otherwise(F.concat_ws("#", "event_type", F.col("event_id").cast("string"))))
    return merge.merge_by_key(e, ["user_id"], F.col("event_id"), fields=["first_value"], tags=["event_type"]).select(
        "user_id", "first_value", F.array_join("event_type", "|").alias("tags"))


@query("""
select l_partkey, max(l_quantity) as best_score, count(*) as rows_merged, arg_min(l_shipmode, (-l_quantity, o)) as mode
from (select l_partkey, l_quantity, l_returnflag || l_linestatus as l_shipmode, l_orderkey * 10 + l_linenumber as o from lineitem) group by l_partkey
""")
def shard_merge_best_base(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").withColumns({"mode": F.concat("l_returnflag", "l_linestatus"), "o": F.col("l_orderkey") * 10 + F.col("l_linenumber")})
    return merge.merge_onto_best(l, ["l_partkey"], F.col("l_quantity"), F.col("o"), ["mode"])


@query("""
select * exclude rn from (select c_nationkey, c_custkey, c_acctbal, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as rn from customer) where rn = 1
""")
def best_per_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return merge.best_per_key(c, ["c_nationkey"], F.col("c_acctbal").desc(), F.col("c_custkey"))


@query("""
with p as (select page_id, length(html) as n, regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/?#:]+\\.[^/?#:]+)', 1) as host from pages),
r as (select *, case when len(string_split(host, '.')) >= 2 then array_to_string(string_split(host, '.')[-2:], '.') else host end as root_domain from p)
select page_id, root_domain, count(*) over w as group_size, count(*) over w > 1 as is_multi,
  first_value(page_id) over (partition by root_domain order by n desc, page_id rows between unbounded preceding and unbounded following) as rep
from r window w as (partition by root_domain)
""")
def collapse_domains(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("n"), text.root_domain(text.host_of(F.col("url"))).alias("root_domain"))
    return merge.collapse_groups(p, "root_domain", "page_id", [F.col("n").desc(), F.col("page_id")]).drop("n")


@query("""
with u as (select c_custkey as k, 0 as source_rank from customer where c_acctbal > 5000 union all select o_custkey, 1 from orders)
select k, min(source_rank) as source_rank from u group by k
""")
def union_distinct_first_source(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"))
    return merge.union_first_source([a, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))], ["k"])


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
def except_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 300000)")
def intersect_key(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return table(spark, sf_dir, "customer").select("c_custkey").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


# --- rules and gates ----------------------------------------------------------------------------------------------------

@query("""
select p_partkey, case when not p_size >= 5 then 'too_small' when not (contains(lower(p_type), 'steel') or contains(lower(p_type), 'brass')) then 'allow:p_type'
  when contains(lower(p_brand), '#1') then 'deny:p_brand' when not p_retailprice < 1500 then 'price' when not (p_name is not null and trim(p_name) <> '') then 'exists:p_name' end as drop_reason
from part
""")
def qualify_rules(spark, sf_dir):
    R = rules.Rule
    listed = [R("p_size", ">=", 5, "too_small"), R("p_type", "allow", ["STEEL", "brass"]), R("p_brand", "deny", ["#1"]), R("p_retailprice", "<", 1500, "price"),
              R("p_name", "exists"), R("nowhere", "exists"), R("p_size", "==", 999, "later", stage="enrichment")]
    return rules.qualify(table(spark, sf_dir, "part"), listed).select("p_partkey", "drop_reason")


_HUBS = [(f"hub{k}", -60.0 + 5 * k, -150.0 + 12 * k) for k in range(25)]
_HUB_SQL = "(select 'hub' || k as hub, -60.0 + 5 * k as hlat, -150.0 + 12 * k as hlng, k from range(25) t(k))"
_POINT_SQL = "(select c_custkey, (c_custkey * 7919 % 1200) / 10.0 - 60 as lat, (c_custkey * 104729 % 3000) / 10.0 - 150 as lng from customer)"
_KM = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(hlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(hlat)) * pow(sin(radians(hlng - lng) / 2), 2))))"


def _points(spark, sf_dir):
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(c, ((c * 7919 % 1200) / 10.0 - 60).alias("latitude"), ((c * 104729 % 3000) / 10.0 - 150).alias("longitude"))


@query(f"select c_custkey, arg_min(hub, (km, k)) as hub, round(min(km), 6) as km from (select *, {_KM} as km from {_POINT_SQL}, {_HUB_SQL}) group by c_custkey")
def nearest_hub(spark, sf_dir):
    near = geo.nearest_point(_points(spark, sf_dir), _HUBS)
    return near.select("c_custkey", F.col("nearest.name").alias("hub"), F.round("nearest.distance", 6).alias("km"))


@query(f"select c_custkey, case when min(km) > 15 * 111 then 'far_from_hubs' end as drop_reason from (select *, {_KM} as km from {_POINT_SQL}, {_HUB_SQL}) group by c_custkey")
def footprint_gate(spark, sf_dir):
    return geo.footprint_gate(_points(spark, sf_dir), _HUBS, radius_degrees=15).select("c_custkey", "drop_reason")


@query("""
with c as (select c_custkey, cast(c_nationkey as varchar) as n, cast(cast(floor(c_acctbal / 10) as bigint) as varchar) as b from customer),
s as (select cast(s_suppkey as varchar) as id, cast(cast(floor(s_acctbal / 10) as bigint) as varchar) as b, cast(s_nationkey as varchar) as n from supplier where s_acctbal > 0)
select c_custkey, case when cast(c_custkey as varchar) in (select id from s) then 'id' when b in (select b from s) then 'bucket' when n in (select n from s where b < '2') then 'nation' end as drop_reason from c
""")
def anti_join_3key(spark, sf_dir):
    bucket = lambda c: F.floor(F.col(c) / 10).cast("long").cast("string")
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("id"), bucket("s_acctbal").alias("b"), F.col("s_nationkey").cast("string").alias("n"))
    c = table(spark, sf_dir, "customer")
    found = joins.known_reason(c, [("id", F.col("c_custkey"), s.select("id")), ("bucket", bucket("c_acctbal"), s.select("b")), ("nation", F.col("c_nationkey"), s.where("b < '2'").select("n"))])
    return found.select("c_custkey", "drop_reason")


@query("""
with best as (select user_id, event_type, cast(floor(extract(hour from ts) / 6) as bigint) as tile, count(*) as n from events group by all)
select event_type, tile, sum(n)::bigint as n from best group by event_type, tile having sum(n) < (select max(s) from (select sum(n) as s from best b2 where b2.event_type = best.event_type group by tile))
""")
def tiles_below_best(spark, sf_dir):
    tiles = table(spark, sf_dir, "events").groupBy("event_type", F.floor(F.hour("ts") / 6).alias("tile")).agg(F.count("*").alias("n"))
    top = tiles.groupBy("event_type").agg(F.max("n").alias("top"))
    return tiles.join(top, "event_type").where("n < top").select("event_type", "tile", "n")


@query("""
with grid as (select n_nationkey as k, s as segment from nation, (select distinct c_mktsegment as s from customer))
select k, segment from grid where not exists (select 1 from customer where c_nationkey = k and c_mktsegment = segment and c_acctbal > 8000)
""")
def coverage_gaps(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    segments = c.agg(F.collect_set("segment").alias("s"))  # five values
    grid = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.explode(F.lit([r for r in segments.first()["s"]])).alias("segment"))
    return delta.coverage_gaps(grid, c.where("c_acctbal > 8000"), ["k", "segment"])


# --- text ---------------------------------------------------------------------------------------------------------------

@query("""
select page_id, h as host, array_to_string(string_split(h, '.')[-2:], '.') as root_domain, h = 'example.org' or suffix(h, '.example.org') as shared,
  regexp_replace(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://(www\\.)?', ''), '/+$', '') as normal_url
from (select page_id, url, regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*://)?(?:www\\.)?([^/?#:]+\\.[^/?#:]+)', 1) as h from pages)
""")
def host_root_domain(spark, sf_dir):
    host = text.host_of(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), text.root_domain(host).alias("root_domain"), text.on_shared_host(host, ["example.org"]).alias("shared"), text.normal_url(F.col("url")).alias("normal_url"))


@query("select page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*\"([^\"]*)\"', 1)) as link from pages")
def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.page_links(F.col("html"))).alias("link"))


@query(r"""
with a as (select page_id, regexp_replace(html, '<(script)\b.*?</script\s*>|<(style)\b.*?</style\s*>|<(noscript)\b.*?</noscript\s*>|<!--.*?-->', ' ', 'gis') as t from pages),
b as (select page_id, regexp_replace(t, '</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav)\b[^>]*>', chr(10), 'gi') as t from a),
c as (select page_id, regexp_replace(t, '<[^>]*>', ' ', 'g') as t from b),
d as (select page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') as t from c)
select page_id, trim(regexp_replace(regexp_replace(t, '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ') as text from d
""")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query("""
select page_id, case when not regexp_matches(html, '<form|<input', 'i') and not contains(html, 'track(') then 'no_pixel' when regexp_matches(lower(html), 'worthless|trash|scum') then 'toxic_words' else 'pass' end as gate,
  contains(html, 'track(') as has_tracker from pages
""")
def signal_gate(spark, sf_dir):
    html = F.col("html")
    tracker = html.contains("track(")
    gate = F.when(~html.rlike("(?i)<form|<input") & ~tracker, "no_pixel").when(F.lower(html).rlike("worthless|trash|scum"), "toxic_words").otherwise("pass")
    return table(spark, sf_dir, "pages").select("page_id", gate.alias("gate"), tracker.alias("has_tracker"))


@query(r"""
select doc_id, email, case when regexp_matches(local, '^(info|office|hello|contact|sales|admin|enquiries|support|mail|team|service)$') then 'generic' when regexp_matches(local, '^[a-z]+[._-][a-z]+$|^[a-z]{2,}[._-]?$') then 'person' else 'other' end as kind
from (select *, regexp_replace(split_part(email, '@', 1), '[0-9]+$', '') as local from (select doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9._%+\-]+@[a-z0-9\-]+(?:\.[a-z0-9\-]+)*\.[a-z]{2,}'))) as email from documents))
""")
def email_extract(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(text.emails_in(F.col("text"))).alias("email"))
    return found.select("doc_id", "email", text.email_kind(F.col("email")).alias("kind"))


@query("select part_id, name, trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(name), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '\\b(?:inc|llc|ltd|limited|corp|corporation|gmbh|plc)\\b', ' ', 'g'), ' +', ' ', 'g')) as company_key from (select p_partkey as part_id, p_name || ' & Sons Ltd.' as name from part)")
def company_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"), F.concat("p_name", F.lit(" & Sons Ltd.")).alias("name"))
    return p.select("*", text.company_key(F.col("name")).alias("company_key"))


@query("""
with d as (select doc_id, n_chars, list_filter([case when contains(lower(text), 'license') then 'license' end, case when contains(text, '@') then 'mail' end, case when contains(text, 'token') then 'secret' end], lambda x: x is not null) as tags from documents),
t as (select unnest(case when len(tags) = 0 then ['(untagged)'] else tags end) as tag, n_chars from d)
select tag, count(*) as n, sum(n_chars)::bigint as total_weight from t group by tag
""")
def taxonomy_longevity(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("tags", text.tags_by_pattern(F.col("text"), {"license": "(?i)license", "mail": "@", "secret": "token"}))
    return reports.tag_totals(d, "tags", F.col("n_chars"))


@query("""
select lang, source, substr(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 1, 160) as body, count(*) as n, max(n_chars) as longest, min(doc_id) as first_id
from documents group by all having count(*) > 1
""")
def near_dup_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("body", F.substring(text.squash(F.col("text")), 1, 160))
    return d.groupBy("lang", "source", "body").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""
select doc_id, case when strong > 0 or core >= 2 then 'A' when adj > 0 then 'B' when core = 1 then 'C' else 'D' end as tier from (select doc_id,
  cast(contains(lower(text), 'license') as int) as strong, cast(contains(text, '@') as int) + cast(contains(text, 'token') as int) + cast(regexp_matches(text, '[0-9]{4}') as int) as core, cast(contains(text, '|') as int) as adj from documents)
""")
def tier_classify(spark, sf_dir):
    t = F.col("text")
    core = text.hits(t, ["@", "token", "[0-9]{4}"])
    tier = F.when(text.hits(t, ["(?i)license"]).__gt__(0) | (core >= 2), "A").when(text.hits(t, [r"\|"]) > 0, "B").when(core == 1, "C").otherwise("D")
    return table(spark, sf_dir, "documents").select("doc_id", tier.alias("tier"))


# --- matching and graphs --------------------------------------------------------------------------------------------------

@query("""
with a as (select p_partkey as l, list_distinct(string_split(lower(p_name), ' ')) as lt from part where p_partkey % 2 = 0),
b as (select p_partkey as r, list_distinct(string_split(lower(p_name), ' ')) as rt from part where p_partkey % 2 = 1),
s as (select l, r, round(len(list_intersect(lt, rt)) / greatest(len(lt), len(rt)), 6) as overlap from a, b)
select l as left_id, arg_max(r, (overlap, -r)) as right_id, max(overlap) as overlap from s where overlap >= 0.6 group by l
""")
def token_overlap_match(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.split(F.lower("p_name"), " ").alias("tokens"))
    left, right = p.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "left_id"), p.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "right_id")
    return joins.token_matches(left, right, "left_id", "right_id", "tokens")


def _edges(lineitem):
    return lineitem.select(F.col("l_partkey").alias("a"), (1000000000 + F.col("l_suppkey") * 1000 + F.col("l_orderkey") % 97).alias("b"))


_EDGE_SQL = "select l_partkey as a, 1000000000 + l_suppkey * 1000 + l_orderkey % 97 as b from lineitem where l_quantity < 2"


@query(f"""
with recursive e as ({_EDGE_SQL}), both_ways as (select a, b from e union select b, a from e),
reach as (select a as node, a as label from both_ways union select b.b, r.label from reach r join both_ways b on b.a = r.node where r.label < b.b)
select node, min(label) as component from reach group by node
""")
def connected_components(spark, sf_dir):
    return graph.connected_components(_edges(table(spark, sf_dir, "lineitem").where("l_quantity < 2")), "a", "b")


@query()
def connected_components_all(spark, sf_dir):
    """Over all edges, for which the recursive SQL is too slow."""
    return graph.connected_components(_edges(table(spark, sf_dir, "lineitem")), "a", "b")


@query("""
with m as (select c_custkey, c_nationkey as g, case when c_acctbal > 9900 then 'yes' when c_acctbal > 5000 then 'unclear' else 'no' end as v from customer),
b as (select g, min((case v when 'yes' then 0 when 'unclear' then 1 else 2 end, c_custkey)) as m from m group by g)
select c_custkey, m.g, v, case b.m[1] when 0 then 'yes' when 1 then 'unclear' else 'no' end as group_verdict, b.m[2] as donor from m join b on m.g = b.g
""".replace("b.m[1]", "struct_extract_at(b.m, 1)").replace("b.m[2]", "struct_extract_at(b.m, 2)"))
def group_reconcile(spark, sf_dir):
    v = F.when(F.col("c_acctbal") > 9900, "yes").when(F.col("c_acctbal") > 5000, "unclear").otherwise("no")
    m = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("g"), v.alias("v"))
    return graph.reconcile(m, "g", "c_custkey", "v", ["yes", "unclear", "no"])


@query("""
with c as (select c_custkey as l, cast(c_custkey % 200 as varchar) as k1, cast(c_nationkey as varchar) as k2 from customer), s as (select s_suppkey as r, cast(s_suppkey % 37 as varchar) as k1, cast(s_nationkey as varchar) as k2 from supplier),
cand as (select l, r, 0 as basis from c join s using (k1) union all select l, r, 1 from c join s using (k2)),
f as (select l, min((basis, r)) as m from cand group by l), g as (select struct_extract_at(m, 2) as r, min((l, struct_extract_at(m, 1))) as w from f group by 1)
select struct_extract_at(w, 1) as c_custkey, r as s_suppkey, struct_extract_at(w, 2) as basis from g
""")
def claim_once(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 200).alias("k1"), F.col("c_nationkey").alias("k2"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("o"), (F.col("s_suppkey") % 37).alias("k1"), F.col("s_nationkey").alias("k2"))
    return joins.claim_once(c, s, [("k1", "k1"), ("k2", "k2")], "c_custkey", "s_suppkey", "o")


@query()
def greedy_dedupe(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("name"), F.floor(F.col("c_acctbal")).cast("long").alias("phone"), F.concat_ws("/", "c_mktsegment", F.floor(F.col("c_acctbal") * 10 % 400)).alias("street"))
    both = lambda a: F.when(~text.is_blank(F.col(a)) & ~text.is_blank(F.col("street")), F.concat_ws("|", F.col(a).cast("string"), "street"))
    keyed = c.withColumns({"phone_street": both("phone"), "name_street": both("name")})
    return cascade.greedy_distinct(keyed, [F.col("c_acctbal").desc(), F.col("c_custkey")], ["phone_street", "name_street"]).drop("phone_street", "name_street")


# --- snapshots and memory -------------------------------------------------------------------------------------------------

@query("""
with days as (select user_id, extract(day from ts) as d from events), lo as (select min(d) as m from days),
cur as (select user_id, count(distinct d % 3) as pass_hits from days where d > 20 group by user_id),
mem as (select user_id, min('d' || d) as first_seen, max(hits) as hits, bool_or(del) as del from (select user_id, d, count(*) as hits, count(*) > 3 as del from days where d <= 20 group by user_id, d) group by user_id)
select c.user_id, pass_hits, coalesce(first_seen, 'now') as first_seen, (coalesce(hits, 0) + pass_hits)::bigint as cumulative_hits, coalesce(del, false) as delivered,
  case when coalesce(del, false) then 'delivered' when pass_hits >= 2 or coalesce(hits, 0) + pass_hits >= 2 then 'confirmed' else 'pending' end as status
from cur c left join mem m on m.user_id = c.user_id
""")
def pass_union_delta(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("d"))
    current = delta.pass_hits(e.where("d > 20").withColumn("p", F.col("d") % 3), "user_id", "p").drop("first_pass")
    prior = e.where("d <= 20").groupBy("user_id", "d").agg(F.count("*").alias("hits")).select("user_id", F.concat(F.lit("d"), "d").alias("first_seen"), "hits", (F.col("hits") > 3).alias("delivered"))
    return delta.union_with_memory(current, prior, "user_id", cycle="now", min_hits=2)


@query("""
with a as (select user_id, arg_min(event_type, event_id) as t0, arg_max(event_type, event_id) as t1, arg_min(value, event_id) as v0, arg_max(value, event_id) as v1 from events group by user_id)
select user_id, array_to_string(list_filter([case when t0 <> t1 then 'renamed' end, case when abs(v1 - v0) > 50 then 'relocated' end], lambda x: x is not null), '|') as change_flags from a
""")
def change_flags(spark, sf_dir):
    at = F.col("event_id")
    a = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", at).alias("t0"), F.max_by("event_type", at).alias("t1"), F.min_by("value", at).alias("v0"), F.max_by("value", at).alias("v1"))
    return delta.change_flags(a, {"renamed": delta.changed("t0", "t1"), "relocated": F.abs(F.col("v1") - F.col("v0")) > 50}).select("user_id", "change_flags")


@query("""
with o as (select user_id, min(ts) as first_seen, max(value) as v from events where event_id % 2 = 0 group by user_id), n as (select user_id, arg_max(ts, event_id) as first_seen, arg_max(value, event_id) as v from events where event_id % 3 = 0 group by user_id)
select coalesce(o.user_id, n.user_id) as user_id, coalesce(o.first_seen, n.first_seen) as first_seen, case when n.user_id is not null then n.v else o.v end as v,
  case when o.user_id is null then 'inserted' when n.user_id is not null then 'updated' else 'unchanged' end as action from o full join n on o.user_id = n.user_id
""")
def upsert_preserve_first_seen(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    old = e.where("event_id % 2 = 0").groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("value").alias("v"))
    new = e.where("event_id % 3 = 0").select("user_id", "event_id", F.col("ts").alias("first_seen"), F.col("value").alias("v"))
    return delta.upsert(old, new, ["user_id"], "event_id", keep=["first_seen"])


@query("select event_id, user_id from events where ts >= (select date_trunc('day', max(ts)) from events) - interval 7 days")
def ttl_read(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return delta.fresh(e, "ts", str(e.agg(F.date_trunc("day", F.max("ts"))).first()[0]), 7).select("event_id", "user_id")


# --- cascades --------------------------------------------------------------------------------------------------------------

@query("""
with s as (select event_id, case event_type when 'click' then 'ok' when 'view' then 'invalid' when 'purchase' then 'disposable' else case when value > 50 then 'catch_all' end end as mv, case when value > 70 then 'deliverable' when value > 30 then 'risky' end as bb from events)
select event_id, case when mv is null and bb is null then 'unverified' when mv = 'ok' then 'sendable' when mv = 'disposable' then 'dropped' when mv = 'invalid' then case when bb = 'deliverable' then 'sendable' else 'dropped' end
  when bb is null then 'unverified' when bb = 'deliverable' then 'sendable' else 'risky' end as verdict from s
""")
def verify_state_machine(spark, sf_dir):
    mv = F.when(F.col("event_type") == "click", "ok").when(F.col("event_type") == "view", "invalid").when(F.col("event_type") == "purchase", "disposable").when(F.col("value") > 50, "catch_all")
    bb = F.when(F.col("value") > 70, "deliverable").when(F.col("value") > 30, "risky")
    return table(spark, sf_dir, "events").select("event_id", cascade.verification_state(mv, bb, ("invalid",)).alias("verdict"))


_WATERFALL_SQL = """
with c as (select user_id, event_id, (event_id % 5)::int as rung, event_id as cand, event_id % 5 = 3 as guessed, case when value > 90 then 'sendable' when value > 80 then 'risky' else 'dropped' end as v from events),
s as (select user_id, min((rung, cand)) filter (where v = 'sendable') as good, min((rung, cand)) filter (where v = 'risky' and not guessed) as risky, min((rung, cand)) filter (where v = 'risky' and guessed) as halt from c group by user_id),
r as (select *, good is not null and (halt is null or good < halt) and (risky is null or struct_extract_at(good, 1) <= struct_extract_at(risky, 1)) as reached, risky is not null and (halt is null or risky < halt) as kept from s)
select user_id, case when reached then 'sendable' when kept then 'risky' else 'none' end as outcome, struct_extract_at(case when reached then good when kept then risky end, 1) as rung, struct_extract_at(case when reached then good when kept then risky end, 2) as cand from r
"""


@query(_WATERFALL_SQL)
def waterfall_first_success(spark, sf_dir):
    v = F.when(F.col("value") > 90, "sendable").when(F.col("value") > 80, "risky").otherwise("dropped")
    c = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 5).cast("int").alias("rung"), F.col("event_id").alias("cand"), (F.col("event_id") % 5 == 3).alias("guessed"), v.alias("verdict"))
    return cascade.waterfall(c, "user_id")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by case event_type when 'purchase' then 0 when 'click' then 1 else 2 end, event_id) as rn from events where value > 20) where rn = 1")
def one_per_lead(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("rank", F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2))
    return cascade.first_source(e, "user_id", "rank", F.col("value") > 20, "event_id").select("user_id", "event_id", "event_type")


@query("select o_orderkey, (1 + (row_number() over (order by o_orderdate, o_orderkey) - 1 + 120) // 500)::int as tranche from orders")
def tranche_assign(spark, sf_dir):
    return ranking.tranches(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 500, already=120).select("o_orderkey", "tranche")


@query("select c_custkey, ((row_number() over (order by c_custkey) - 1) // 64)::int as batch_id from customer")
def batching(spark, sf_dir):
    return ranking.batches(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], 64)


@query("select c_custkey, ((row_number() over (order by c_custkey) - 1) % 8)::int as shard from customer")
def round_robin_shards(spark, sf_dir):
    return ranking.round_robin(table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"], 8)


_PERSON_SQL = "select c_custkey, 'ann' || chr(97 + (c_custkey % 26)::int) as f, 'bell' || chr(97 + (c_custkey % 7)::int) as l, 'd' || c_nationkey || '.com' as domain from customer"


@query(f"""
with p as ({_PERSON_SQL}), s as (select distinct domain, case c_custkey % 3 when 0 then 'flast' when 1 then 'first.last' else 'last' end as form,
  case c_custkey % 3 when 0 then f[1] || l when 1 then f || '.' || l else l end || '@' || domain as email from p where c_custkey % 50 = 0)
select distinct c_custkey, form, case form when 'flast' then f[1] || l when 'first.last' then f || '.' || l else l end || '@' || p.domain as email from p join (select distinct domain, form from s) s on p.domain = s.domain
where case form when 'flast' then f[1] || l when 'first.last' then f || '.' || l else l end || '@' || p.domain not in (select email from s)
""")
def seeded_rung(spark, sf_dir):
    c = F.col("c_custkey")
    p = table(spark, sf_dir, "customer").select(c, F.concat(F.lit("ann"), F.char(97 + c % 26)).alias("first_name"), F.concat(F.lit("bell"), F.char(97 + c % 7)).alias("last_name"), F.concat(F.lit("d"), "c_nationkey", F.lit(".com")).alias("domain"))
    forms = people.local_forms(F.col("first_name"), F.col("last_name"))
    form = F.when(c % 3 == 0, "flast").when(c % 3 == 1, "first.last").otherwise("last")
    seeds = p.where(c % 50 == 0).select("domain", "first_name", "last_name", F.concat_ws("@", forms[form], "domain").alias("email"))
    return cascade.seeded_candidates(p, seeds, "c_custkey")


@query("""
with c as (select c_custkey, case c_nationkey % 5 when 0 then 'A' when 1 then 'B' when 2 then 'D' when 3 then 'D' else 'Z' end as tier,
  case c_custkey % 4 when 0 then 'yes' when 1 then 'no' when 2 then 'unclear' else '' end as v, lower(c_mktsegment) as b, case when c_custkey % 3 = 0 then 'brand' else '' end as brand from customer),
d as (select avg((v = 'yes')::int) as r from c where tier = 'D' and v <> ''),
x as (select *, case when tier = 'Z' then 'unknown_tier:Z' when v = 'no' and b = 'building' then null when v = 'no' then 'adjudicated_no:' || b
  when tier = 'D' and v = '' then case when r >= 0.05 then 'tier_d_unadjudicated' else 'tier_d_unsampled' end || ':sample_yes_rate=' || printf('%.1f', 100 * r) || '%' end as reason from c, d)
select c_custkey, case when v = 'unclear' and brand <> '' then null else reason end as drop_reason, v = 'no' and b = 'building' and tier <> 'Z' as aside from x
""")
def adjudicate_rules(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_nationkey") % 5
    tier = F.when(n == 0, "A").when(n == 1, "B").when(n.isin(2, 3), "D").otherwise("Z")
    verdict = F.when(k % 4 == 0, "yes").when(k % 4 == 1, "no").when(k % 4 == 2, "unclear").otherwise("")
    c = table(spark, sf_dir, "customer").select(k, tier.alias("tier"), verdict.alias("verdict"), F.lower("c_mktsegment").alias("bucket"), F.when(k % 3 == 0, "brand").otherwise("").alias("brand_family"))
    return cascade.adjudicate(c, side_bucket="building").select("c_custkey", "drop_reason", "aside")


@query()
def min_separation(spark, sf_dir):
    return cover.minimum_separation(_points(spark, sf_dir), "c_custkey", 600.0)


@query()
def registry_best_match(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    lead, cand = p.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "lead"), p.where("p_partkey % 2 = 1")
    # only names are compared here: equal names are compared once, and the first candidate of a name is its best
    names = lead.select("name").distinct().withColumn("tokens", registry.name_tokens(F.col("name")))
    cand = cand.groupBy(F.col("name").alias("title")).agg(F.min("p_partkey").alias("cand")).withColumn("tokens", registry.name_tokens(F.col("title")))
    pairs = joins.candidate_pairs(names, cand, "name", "cand", "tokens", least=0.6).join(cand.select("cand", "title"), "cand")
    blank = {c: F.lit("") for c in ("full_address", "city", "address_snippet", "office_town")}
    best = registry.best_registry_match(pairs.withColumns(blank).withColumn("company_status", F.lit("active")), "name", "cand", "cand", least=0.6)
    best = lead.join(best, "name")
    return best.select("lead", "cand", F.col("evidence.overlap").alias("overlap"), registry.registry_basis(F.col("evidence"))["basis"].alias("basis"))


@query()
def social_profiles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(pages.social_profiles(F.col("html"))).alias("network", "urls"))


# --- reports ---------------------------------------------------------------------------------------------------------------

@query("select o_orderstatus, count(*) as n, round(count(*) / (select count(*) from orders), 6) as share from orders group by o_orderstatus")
def funnel_report(spark, sf_dir):
    return reports.funnel(table(spark, sf_dir, "orders"), "o_orderstatus")


@query("""
select 'c_name' as column_name, count(*) filter (where trim(c_name) <> '') as filled, round(count(*) filter (where trim(c_name) <> '') / count(*), 6) as rate from customer
union all select 'vip', count(*) filter (where c_acctbal > 9000), round(count(*) filter (where c_acctbal > 9000) / count(*), 6) from customer
""")
def fill_rates(spark, sf_dir):
    return reports.fill_rates(table(spark, sf_dir, "customer").withColumn("vip", F.when(F.col("c_acctbal") > 9000, "y").otherwise(" ")), ["c_name", "vip"])


@query("""
select n_name, count(*) filter (where c_mktsegment = 'BUILDING') as building, count(*) filter (where c_mktsegment = 'MACHINERY') as machinery, count(*) as total
from customer join nation on n_nationkey = c_nationkey group by n_name
""")
def by_state_pivot(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    return c.groupBy("n_name").agg(F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"), F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("machinery"), F.count("*").alias("total"))


@query("""
with s as (select o_orderpriority, count(distinct o_custkey) as n_keys from orders group by 1), a as (select p as o_orderpriority, count(*) as added from (select o_custkey, min(o_orderpriority) as p from orders group by 1) group by 1)
select s.o_orderpriority, n_keys, coalesce(added, 0) as added, sum(coalesce(added, 0)) over (order by s.o_orderpriority)::bigint as running from s left join a using (o_orderpriority)
""")
def marginal_contribution(spark, sf_dir):
    return reports.marginal_contribution(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("select cast(t as double) as threshold, (select count(*) from part where p_size >= t) as kept from (values (10), (20), (30), (50)) v(t)")
def threshold_sensitivity(spark, sf_dir):
    return reports.threshold_sensitivity(table(spark, sf_dir, "part"), F.col("p_size"), [10, 20, 30, 50])


@query("""
with t as (select l_suppkey as centre, l_returnflag as tile, case when l_returnflag = 'R' and l_suppkey % 7 = 0 then 0 else count(*) end as n, bool_or(l_discount > 0.01) as ok from lineitem group by 1, 2)
select t.centre, tile, n as best, ok as any_ok, centre_best from t join (select centre, max(n) as centre_best from t group by 1) c on c.centre = t.centre where ok and n = 0 and centre_best > 10
""")
def zero_row_suspects(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("centre"), F.col("l_returnflag").alias("tile")).agg(F.count("*").alias("c"), F.bool_or(F.col("l_discount") > 0.01).alias("ok"))
    l = l.withColumn("n", F.when((F.col("tile") == "R") & (F.col("centre") % 7 == 0), 0).otherwise(F.col("c")).cast("long"))
    return reports.zero_suspects(l, "centre", "tile", "n", "ok", 10)


from leadloom.plans import contact_queries, memory_queries, page_queries, report_queries, stage_queries  # noqa: E402,F401  register their queries
