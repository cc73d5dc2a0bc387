"""Queries of roll-ups, reports, ranks, samples and batches, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.operators import rollups, windows
from leadloom.plans.queries import query, table

_E = "(select event_id, user_id, event_type, value, extract(day from ts)::int as day from events)"


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.dayofmonth("ts").alias("day"))


# --- roll-ups ---------------------------------------------------------------------------------------------------------

@query(f"""
select user_id, arg_min(event_type, event_id) as kept, coalesce(arg_min(v, event_id) filter (where v <> ''), '') as filled, count(distinct event_type) as tags
from (select *, case when value < 100 then '' else 'v' || event_id end as v from {_E}) group by user_id
""")
def shard_merge_simple(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"kept": F.col("event_type"), "filled": F.when(F.col("value") < 100, "").otherwise(F.concat(F.lit("v"), F.col("event_id").cast("string")))})
    out = rollups.shard_merge_simple(e, "user_id", "event_id", "event_type", ["filled"], ["kept"])
    return out.select("user_id", "kept", "filled", F.size("event_type").cast("long").alias("tags"))


@query(f"""
select l_suppkey, count(*) as n, count(distinct l_returnflag) as flags, arg_min(l_linestatus, o) filter (where l_linestatus = 'O') as first_open
from (select *, l_orderkey * 10 + l_linenumber as o from lineitem) group by l_suppkey
""")
def company_rollup(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"),
                                                F.when(F.col("l_linestatus") == "O", "O").otherwise(" ").alias("first_open"))
    out = rollups.company_rollup(l, "l_suppkey", "o", sets=["l_returnflag"], fields=["first_open"])
    return out.select("l_suppkey", "n", F.size("l_returnflag").cast("long").alias("flags"), F.nullif("first_open", F.lit("")).alias("first_open"))


@query(f"""
select user_id, coalesce(arg_max(event_id, event_id) filter (where s > 0), min(event_id)) as event_id from (select *, case when value < 150 then 0 else 1 end as s from {_E}) group by user_id
""")
def firmographic_rollup(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "event_id", F.when(F.col("value") < 150, 0).otherwise(1).alias("s"))
    return rollups.firmographic_rollup(e, "user_id", "event_id", "s").select("user_id", "event_id")


@query(f"""
with k as (select distinct day, user_id from {_E}), f as (select user_id, min(day) as day from k group by user_id),
p as (select k.day, count(*) as keys, (select count(*) from f where f.day = k.day) as added from k group by k.day),
t as (select *, sum(added) over (order by day)::bigint as total from p)
select day, keys, added, total, round(100.0 * keys / max(total) over (), 1) as capture_pct, coalesce(round(100.0 * added / lag(total) over (order by day), 1), -1) as growth_pct from t
""")
def pass_growth(spark, sf_dir):
    return rollups.pass_contribution(events(spark, sf_dir), "user_id", "day").withColumn("growth_pct", F.coalesce("growth_pct", F.lit(-1.0)))


@query("""
with t as (select unnest(string_split(p_name, ' ')) as tag, p_size % 5 as h from part) select tag, count(*) as n, count(*) filter (where h = 1) as single, round(avg((h = 1)::int), 4) as single_rate from t group by tag
""")
def single_hit_rate(spark, sf_dir):
    return rollups.single_hit_rate(table(spark, sf_dir, "part"), F.split("p_name", " "), F.col("p_size") % 5)


@query(f"""
select event_type, count(*) as events, sum(case when p > 0 then p else 1 end)::bigint as calls, count(*) filter (where value < 50) as zero, count(*) filter (where event_id % 10 = 0) as failed,
  round(100.0 * count(*) filter (where value < 50 and event_id % 4 > 0) / count(*) filter (where event_id % 4 > 0), 1) as zero_pct from (select *, event_id % 6 as p from {_E}) group by event_type
""")
def call_rollup(spark, sf_dir):
    i = F.col("event_id")
    e = events(spark, sf_dir).select("event_type", (i % 6).alias("pages"), F.when(F.col("value") >= 50, 3).alias("rows"), F.when(i % 10 == 0, "timeout").otherwise("ok").alias("status"), (i % 4 == 0).alias("extra"))
    return rollups.call_rollup(e, "event_type", pages="pages", rows="rows", status="status", extra="extra")


@query(f"select event_type, greatest(event_id % 6, 1) as depth, count(*) as n from {_E} group by all")
def page_depths(spark, sf_dir):
    e = events(spark, sf_dir).select("event_type", (F.col("event_id") % 6).alias("pages"))
    return rollups.page_depths(e, "event_type", "pages").select("event_type", F.col("depth").cast("long").alias("depth"), "n")


@query(f"select user_id, count(*) as queries from {_E} group by user_id having bool_and(value < 400)")
def empty_centres(spark, sf_dir):
    return rollups.all_empty(events(spark, sf_dir).withColumn("rows", F.when(F.col("value") >= 400, 1)), "user_id", "rows")


@query("""
select o_orderpriority as kind, count(*) as n, sum(d)::bigint as days, count(*) filter (where o_orderstatus = 'O') as live, max(d) as longest
from (select *, o_custkey % 90 as d from orders) group by o_orderpriority
""")
def format_breakdown(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"d": F.col("o_custkey") % 90, "kind": F.col("o_orderpriority")})
    return rollups.format_breakdown(o, "kind", "d", F.col("o_orderstatus") == "O")


@query("""
select count(*) as ads, count(distinct o_custkey) as advertisers, median(d) filter (where d > 0) as median_days, max(d) as longest, count(*) filter (where o_orderstatus = 'O') as live from (select *, o_custkey % 90 as d from orders)
""")
def ad_summary(spark, sf_dir):
    return rollups.summary(table(spark, sf_dir, "orders").withColumn("d", F.col("o_custkey") % 90), "o_custkey", "d", F.col("o_orderstatus") == "O")


@query(f"""
select user_id, count(*) as ads, count(distinct event_type) as terms, count(*) filter (where value >= 100) as with_text, count(*) filter (where value > 250) as active,
  coalesce(arg_min('u' || event_id, event_id) filter (where event_id % 3 > 0), '') as url from {_E} group by user_id
""")
def advertiser_discovery(spark, sf_dir):
    i = F.col("event_id")
    e = events(spark, sf_dir).withColumns({"text": F.when(F.col("value") >= 100, "t"), "url": F.when(i % 3 > 0, F.concat(F.lit("u"), i.cast("string"))).otherwise("")})
    return rollups.advertisers(e, ["user_id"], "event_type", "url", "event_id", F.col("value") > 250, "text")


@query(f"""
select event_type as rung, count(*) as attempted, count(*) filter (where k < 3) as found, count(*) filter (where k = 0) as sendable, count(*) filter (where k = 4) as no_credits, round(count(*) * 0.25, 2) as cost,
  round(round(count(*) * 0.25, 2) / count(*) filter (where k = 0), 4) as cost_per_sendable from (select *, event_id % 5 as k from {_E}) group by event_type
""")
def rung_report(spark, sf_dir):
    outcome = F.get(F.array(*[F.lit(x) for x in ("sendable", "risky", "dropped", "none", "no_credits")]), (F.col("event_id") % 5).cast("int"))
    e = events(spark, sf_dir).select(F.col("event_type").alias("rung"), outcome.alias("outcome"), F.lit(0.25).alias("cost"))
    return rollups.rung_report(e, "rung", "outcome", "cost")


@query("select count(*) as contacts, count(distinct c_nationkey) as domains, 11 as patterns, round(count(*) * 11 * 0.05, 2) as most_credits from customer")
def credit_estimate(spark, sf_dir):
    return rollups.credit_estimate(table(spark, sf_dir, "customer"), "c_nationkey", 11, 0.05)


@query("""
with f as (select c_custkey as id, 'poor' as flag from customer where c_acctbal < 0 union all select c_custkey, 'far' from customer where c_nationkey > 20),
r as (select *, row_number() over (partition by flag order by id) as r from f)
select flag, count(*) as n, string_agg(id::varchar, ',' order by id) filter (where r <= 5) as ids from r group by flag
""")
def flag_lists(spark, sf_dir):
    out = rollups.flag_lists(table(spark, sf_dir, "customer"), "c_custkey", {"poor": F.col("c_acctbal") < 0, "far": F.col("c_nationkey") > 20}, most=5)
    return out.select("flag", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


# --- ranks, samples, batches --------------------------------------------------------------------------------------------

@query("select c_custkey, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey)::int as rank from customer")
def rank_in_lead(spark, sf_dir):
    return windows.rank_within(table(spark, sf_dir, "customer"), "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_custkey", "rank")


@query("select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 40")
def top_rows(spark, sf_dir):
    return windows.top(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), 40, [F.col("c_acctbal").desc(), F.col("c_custkey")])


@query("""
select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as r from customer) where r = 1 order by c_acctbal desc, c_custkey limit 10
""")
def top_one_each(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return windows.top_one_each(c, "c_nationkey", 10, [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_nationkey", "c_custkey")


@query("""
with r as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as n, count(*) over () as c from orders) select o_orderkey from r where n % greatest(1, c // 60) = 0 and n < 60 * greatest(1, c // 60)
""")
def even_sample(spark, sf_dir):
    return windows.even_sample(table(spark, sf_dir, "orders").select("o_orderkey"), 60, ["o_orderkey"])


@query("select o_orderkey from orders order by md5('7:' || o_orderkey::varchar), o_orderkey limit 50")
def seeded_sample(spark, sf_dir):
    return windows.seeded_sample(table(spark, sf_dir, "orders").select("o_orderkey"), 50, "o_orderkey", 7)


@query("""
with r as (select o_orderkey, o_orderpriority as t, row_number() over (partition by o_orderpriority order by o_orderkey) - 1 as n from orders),
s as (select o_orderpriority as t, ceil(count(*) / 70.0) as b from orders group by 1), o as (select t, coalesce(sum(b) over (order by t rows between unbounded preceding and 1 preceding), 0) as f from s)
select o_orderkey, (f + n // 70)::int as batch from r join o using (t)
""")
def homogeneous_batches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return windows.homogeneous_batches(o, "o_orderpriority", [F.col("o_orderkey")], 70).select("o_orderkey", "batch")


@query("select c_custkey from customer order by c_mktsegment = 'BUILDING', c_custkey limit 100")
def last_class_last(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return windows.top(c, 100, windows.last_class_last(c, "c_mktsegment", "^BUILDING$", [F.col("c_custkey")])).select("c_custkey")


@query("select c_nationkey, arg_min(c_custkey, (c_mktsegment, c_custkey)) as c_custkey from customer group by c_nationkey")
def one_target(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment")
    return windows.one_target(c, "c_nationkey", F.col("c_mktsegment"), F.col("c_custkey")).select("c_nationkey", "c_custkey")


@query("""
with k as (select o_orderkey, (1 + o_orderkey // 900)::int as tranche from orders where o_orderkey % 3 = 0), l as (select max(tranche) as t from k), u as (select count(*) as n from k where tranche = (select t from l)),
f as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as n from orders where o_orderkey % 3 > 0)
select * from k union all select o_orderkey, ((select t from l) + (f.n + (select n from u)) // 300)::int from f
""")
def sticky_tranches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    known = o.where("o_orderkey % 3 = 0").withColumn("tranche", (1 + F.floor(F.col("o_orderkey") / 900)).cast("int"))
    return windows.sticky_tranches(o, "o_orderkey", ["o_orderkey"], 300, known)
