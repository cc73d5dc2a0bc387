"""Queries of keys, exports, profiles and steps between stages, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.functions import slices, text
from leadloom.operators import stages
from leadloom.plans.queries import query, table
from leadloom.sources import exports

def key():
    return F.col("c_custkey")


@query("""
select s_suppkey, 'n' || s_nationkey || '.shop.com:8080' as lenient, case when s_suppkey % 2 = 0 then 'n' || s_nationkey || '.shop.com:8080' else '' end as strict, 'n' || s_nationkey || '.shop.com:8080' as bare,
  'supplier' || split_part(s_name, '#', 2) as board, 'supplier' || split_part(s_name, '#', 2) || 'andsons' as delivered, 'supplier' || split_part(s_name, '#', 2) || '|' || s_nationkey as dealer,
  'own' || s_suppkey || '.com' as own from supplier
""")
def name_keys(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    host = F.concat(F.lit("WWW.N"), F.col("s_nationkey").cast("string"), F.lit(".Shop.com:8080/a/b?c"))
    url = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("HTTPS://"), host)).otherwise(host)
    page = F.concat(F.lit('<a href="https://dir.com">d</a><h1>X</h1><a class="w" href="https://www.own'), F.col("s_suppkey").cast("string"), F.lit('.com/x">site</a>'))
    return s.select(
        "s_suppkey", text.lenient_host(url).alias("lenient"), text.strict_host(url).alias("strict"), text.bare_domain(url).alias("bare"), text.board_key(F.concat("s_name", F.lit(", Inc."))).alias("board"),
        text.delivered_key(F.concat("s_name", F.lit(" & Sons Ltd"))).alias("delivered"), text.dealer_key(F.concat("s_name", F.lit(" LLC")), F.col("s_nationkey"), ["llc"]).alias("dealer"), text.own_site_link(page).alias("own"))


@query("""
with k as (select c_custkey, case when c_custkey % 3 = 0 then lower(c_mktsegment) || '|' || c_nationkey else 'n' || c_nationkey || '.com' end as key from customer) select key, min(c_custkey) as c_custkey from k group by key
""")
def business_export(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("name"), F.col("c_nationkey").cast("string").alias("city"),
                                                F.when(key() % 3 == 0, "").otherwise(F.concat(F.lit("http://www.n"), F.col("c_nationkey").cast("string"), F.lit(".com/x"))).alias("web"))
    return exports.businesses(c, name="name", website="web", city="city", order="c_custkey").select("key", "c_custkey")


@query("""
select 'a' as source, c_name as name, c_nationkey::varchar as place, '' as phone from customer where c_nationkey::varchar <> '' union all select 'b', s_name, '', s_suppkey::varchar from supplier where false
""")
def dealer_dumps(spark, sf_dir):
    sources = {"a": (table(spark, sf_dir, "customer"), {"name": F.col("c_name"), "place": F.col("c_nationkey")}), "b": (table(spark, sf_dir, "supplier"), {"name": F.col("s_name"), "phone": F.col("s_suppkey")})}
    return exports.stacked(sources, ["name", "place", "phone"], keep=F.col("place") != "")


@query("""
select p_partkey, case when p_size % 2 = 0 then p_type else p_brand end as body, p_name as link, 'ChIJ' || lpad(p_partkey::varchar, 6, '0') as place from part
""")
def ad_flattening(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ads = p.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("body"), F.lit(" ").alias("link"), F.array(F.struct(F.col("p_brand").alias("body"), F.col("p_name").alias("link"))).alias("cards"))
    ads = ads.withColumn("link", F.trim("link"))
    url = F.concat(F.lit("https://maps.example/?q=place_id:ChIJ"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit("&x=1"))
    return exports.ads(ads, ["body", "link"], "cards").withColumn("place", exports.place_id(url))


@query("select c_custkey from customer where c_custkey % 50 in (select event_id % 50 from events where value < 100 and event_id % 3 > 0 and event_id % 50 > 10)")
def retry_input(spark, sf_dir):
    i = F.col("event_id")
    status = table(spark, sf_dir, "events").select((i % 50).cast("string").alias("name"), F.when(F.col("value") < 100, "timeout").otherwise("ok").alias("s"), "event_id")
    items = table(spark, sf_dir, "customer").select("c_custkey", (key() % 50).cast("string").alias("name"))
    return exports.retry_input(status, items, "name", F.col("s") == "timeout", (i % 3 == 0) | (i % 50 <= 10)).select("c_custkey")


@query("""
select c_custkey, case when c_custkey % 3 = 0 then 'baseline' when c_custkey % 3 = 1 then 'changed:phone+name' else 'new' end as angle, ['sendable', 'risky', 'dropped', 'unverified'][1 + c_custkey % 4] as class,
  case when c_custkey % 4 = 2 and c_custkey % 5 = 0 then 'ok' else ['OK', 'Catch-All', 'bounced', null][1 + c_custkey % 4] end as result, case when c_nationkey = 3 then case when c_custkey % 2 = 0 then 'mine.com' else '' end else 'h' || c_nationkey end as host,
  case when c_custkey % 4 = 3 and c_custkey % 2 = 1 then 'new text' else 't' end as body
from customer
""")
def second_looks(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.get(F.array(F.lit("OK"), F.lit("Catch-All"), F.lit("bounced"), F.lit(None)), (key() % 4).cast("int")).alias("result"),
                                                F.concat(F.lit("h"), F.col("c_nationkey").cast("string")).alias("host"), F.lit("t").alias("body"))
    c = c.withColumns({"angle": stages.angle(key() % 3 == 0, F.when(key() % 3 == 1, F.array(F.lit("phone"), F.lit("name"))).otherwise(F.array().cast("array<string>"))), "class": stages.verifier_class(F.col("result"))})
    c = stages.recovered(c, "c_custkey", c.where(key() % 5 == 0).select("c_custkey", F.lit("ok").alias("result")), "result", F.col("class") == "dropped")
    c = stages.undo_wrong_fan_out(c, "c_custkey", "host", ["h3"], c.where(key() % 2 == 0).select("c_custkey", F.lit("mine.com").alias("host")))
    c = stages.site_residue(c, c.where(key() % 2 == 1).select("c_custkey", F.lit("new text").alias("body")), "c_custkey", "body", F.col("class") == "unverified")
    return c.select("c_custkey", "angle", "class", "result", "host", "body")


@query("""
select 'redo' as kind, k as key, 1 as n from (select c_custkey as k from customer where c_acctbal < 0 union select c_custkey from customer where c_nationkey = 7) union all
select 'short', 0, count(*) from customer where c_custkey < 10 union all select 'poor', 0, count(*) from customer where c_acctbal < 0 union all
select p, 0, count(*) from (select case when c_nationkey < 5 then 'home' when c_nationkey < 9 then 'near' end as p from customer) where p is not null group by p
""")
def redo_and_tracks(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    poor, far = F.col("c_acctbal") < 0, F.col("c_nationkey") == 7
    redo = stages.redo_set([c.where(poor), c.where(far)], "c_custkey").select(F.lit("redo").alias("kind"), key().cast("long").alias("key"), F.lit(1).cast("long").alias("n"))
    broken = stages.violations(c, {"short": key() < 10, "poor": poor}).select(F.col("rule").alias("kind"), F.lit(0).cast("long").alias("key"), "n")
    tracks = stages.tracks(c, {"home": F.col("c_nationkey") < 5, "near": F.col("c_nationkey") < 9}).groupBy("geo_pass").agg(F.count("*").alias("n"))
    return redo.unionByName(broken).unionByName(tracks.select(F.col("geo_pass").alias("kind"), F.lit(0).cast("long").alias("key"), "n"))


@query("""
with d as (select n_nationkey as k, string_agg(distinct 'p' || s_suppkey % 7, '; ' order by 'p' || s_suppkey % 7) as directors from supplier join nation on n_nationkey = s_nationkey where s_suppkey % 3 > 0 group by 1)
select n_nationkey, coalesce(directors, '') as directors, directors is not null as have from nation left join d on k = n_nationkey
""")
def directors_lines(spark, sf_dir):
    i = F.col("s_suppkey")
    d = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("p"), (i % 7).cast("string"))).alias("name"), (i % 7).alias("o"))
    return stages.with_directors(table(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey", d, "name", "o")


@query(r"""
select page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) as title, 'we build' as copy from pages
""")
def page_titles(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", slices.page_title(F.col("html")).alias("title"), slices.copy_key(F.lit("We build! https://x.y #roof")).alias("copy"))
