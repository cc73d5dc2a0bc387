"""Queries of memory between cycles, stalls, number forms, tiers and checks of the store, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.functions import text
from leadloom.operators import delta, reports, store
from leadloom.plans.queries import query, table
from leadloom.sources import files
from leadloom.streaming import incremental


@query("""
with e as (select *, case when event_id % 5 = 0 then '' else 'c' || (event_id % 7) end as fs, case when event_id % 50 = 0 then 'TRUE' else 'false' end as d from events)
select user_id, coalesce(arg_min(fs, event_id) filter (where fs <> ''), '') as first_seen, max(event_id % 11) as cumulative_hits, bool_or(lower(d) = 'true') as delivered, arg_max(event_type, event_id) as event_type
from e group by user_id
""")
def memory_merge(spark, sf_dir):
    i = F.col("event_id")
    prior = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.when(i % 5 == 0, "").otherwise(F.concat(F.lit("c"), (i % 7).cast("string"))).alias("first_seen"),
                                                  (i % 11).alias("cumulative_hits"), F.when(i % 50 == 0, "TRUE").otherwise("false").alias("delivered"))
    return delta.merged_memory(prior, "user_id", "event_id")


@query("""
with e as (select user_id, event_id, event_id // 300 as total from events), c as (select *, case when lag(total) over w is distinct from total then 1 else 0 end as new from e window w as (partition by user_id order by event_id)),
s as (select *, sum(new) over (partition by user_id order by event_id) as spell from c)
select user_id, total, count(*) - 1 as frozen, min(event_id) as since, max(event_id) as until from s group by user_id, total, spell having count(*) > 2
""")
def stalls(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.floor(F.col("event_id") / 300).alias("total"))
    return incremental.stalls(e, "user_id", "total", "event_id", 2)


@query("""
select user_id % 2 = 0 as by_id, k as capture_key, arg_max(event_id, (ts, event_id)) as event_id
from (select *, case when user_id % 2 = 0 then user_id::varchar else lower(event_type) || '|' || (user_id % 5) end as k from events) group by 1, 2
""")
def capture_newest(spark, sf_dir):
    user = F.col("user_id")
    e = table(spark, sf_dir, "events").select(F.when(user % 2 == 0, user.cast("string")).otherwise(" ").alias("id"), F.upper("event_type").alias("name"), (user % 5).alias("place"), "ts", "event_id")
    return files.newest_capture(e, "id", "name", "place", "ts", "event_id").select((F.col("id") != " ").alias("by_id"), "capture_key", "event_id")


@query("""
select '{"rows":' || count(*) || ',"large":' || count(*) filter (where p_size > 25) || ',"none":0}' as manifest from part
""")
def manifest(spark, sf_dir):
    return reports.manifest(table(spark, sf_dir, "part"), {"large": F.col("p_size") > 25, "none": F.col("p_size") < 0})


@query("""
select distinct 'q' || (c_custkey % 40) || '|' || printf('%.2f', c_nationkey / 4.0) || '|' || printf('%.2f', -c_nationkey / 2.0) as work from customer
where ('q' || (c_custkey % 40), c_nationkey) not in (select 'q' || (s_suppkey % 40), s_nationkey from supplier)
""")
def work_gaps(spark, sf_dir):
    def work(name, key, nation):
        n = F.col(nation)
        return table(spark, sf_dir, name).select(delta.work_key(F.concat(F.lit("q"), (F.col(key) % 40).cast("string")), n / 4, -n / 2).alias("work")).distinct()

    return delta.coverage_gaps(work("customer", "c_custkey", "c_nationkey"), work("supplier", "s_suppkey", "s_nationkey"), ["work"])


@query("""
with t as (select doc_id, coalesce(text, '') as t from documents), h as (select *, regexp_matches(t, 'License') as strong, regexp_matches(t, '@')::int + regexp_matches(t, '[0-9]{4}')::int as core, regexp_matches(t, '\\|')::int as adjacent from t),
w as (select *, case when strong then 'License' when regexp_matches(t, '@') then '@' when regexp_matches(t, '[0-9]{4}') then regexp_extract(t, '[0-9]{4}') when adjacent > 0 then '|' else '' end as hit from h)
select doc_id, case when strong or core = 2 then 'A' when adjacent > 0 then 'B' when core = 1 then 'C' else 'D' end as tier, core::bigint as core,
  case when hit = '' then '' else trim(regexp_replace(substr(t, greatest(1, strpos(t, hit) - 110), least(110, strpos(t, hit) - 1) + length(hit) + 110), '[ \t\n\r\f\v]+', ' ', 'g')) end as evidence from w
""")
def tier_evidence(spark, sf_dir):
    found = text.tiered(F.coalesce("text", F.lit("")), strong="License", core=["@", "[0-9]{4}"], adjacent=[r"\|"], new=["(?!)"])
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("f")).select("doc_id", "f.tier", F.col("f.core").cast("long").alias("core"), "f.evidence")


@query("""
with p as (select 'p' || (c_custkey % 100) as place_id, case when c_custkey % 9 > 0 then c_name end as name, 'r' || (c_custkey % 3) as run from customer)
select * from (
  select 'places' as "table", 'key place_id' as rule, count(*) as n from (select place_id from p group by 1 having count(*) > 1) union all
  select 'places', 'needed name', count(*) from p where name is null union all select 'places', 'parent first_seen_run', count(*) from p where run = 'r2') where n > 0
""")
def store_checks(spark, sf_dir):
    key = F.col("c_custkey")
    named = lambda prefix, n: F.concat(F.lit(prefix), (key % n).cast("string"))
    places = table(spark, sf_dir, "customer").select(named("p", 100).alias("place_id"), F.when(key % 9 > 0, F.col("c_name")).alias("name"), F.lit("gb").alias("country"), named("r", 3).alias("first_seen_run"), F.lit(1).alias("more"))
    runs = spark.createDataFrame([("r0", "c", "gb"), ("r1", "c", "gb")], "run_id string, client string, country string")
    return store.store_violations({"runs": store.conformed(runs, store.STORE["runs"]), "places": store.conformed(places, store.STORE["places"])})
