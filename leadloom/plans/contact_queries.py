"""Queries of addresses, e-mail, contacts, gates and joins with provenance, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadloom.functions import emails, geo, slices
from leadloom.operators import contacts, gates, matching, store
from leadloom.plans.queries import query, table

def key():
    return F.col("c_custkey")


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(key().cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("long").alias("n"), "c_acctbal", "c_mktsegment")


_C = "(select c_custkey::bigint as c_custkey, c_name, c_nationkey::bigint as n, c_acctbal, c_mktsegment from customer)"


# --- e-mail -----------------------------------------------------------------------------------------------------------

@query(f"select c_custkey, case when c_custkey % 5 = 0 then null else lower(replace(c_name, '#', '')) || '@n' || n || '.shop.com' end as email from {_C}")
def email_clean(spark, sf_dir):
    c = customers(spark, sf_dir)
    box = F.replace("c_name", F.lit("#"), F.lit(""))
    raw = F.concat(F.lit("MailTo:%20"), box, F.lit("@N"), F.col("n").cast("string"), F.lit(".Shop.com?subject=hi, other@x.com"))
    return c.select("c_custkey", emails.clean_email(F.when(key() % 5 == 0, "nobody").otherwise(raw)).alias("email"))


# --- addresses --------------------------------------------------------------------------------------------------------

@query(f"""
select c_custkey, case when c_custkey % 4 = 0 then 1 else count(*) over (partition by k) end as co_tenants, case when c_custkey % 4 = 0 then -1 else max(n) over (partition by k) end as top_floor,
  c_custkey % 4 <> 0 and bool_or(c_mktsegment = 'MACHINERY') over (partition by k) as hub
from (select *, case when c_custkey % 4 = 0 then -c_custkey - 1 else c_custkey % 100 end as k from {_C})
""")
def co_tenancy(spark, sf_dir):
    from leadloom.operators import rollups

    c = customers(spark, sf_dir).withColumn("street", F.when(key() % 4 == 0, "").otherwise((key() % 100).cast("string")))
    return rollups.co_tenancy(c, "c_custkey", "street", "n", "c_mktsegment", "machinery").select("c_custkey", "co_tenants", F.coalesce("top_floor", F.lit(-1)).alias("top_floor"), "hub")


# --- contacts ---------------------------------------------------------------------------------------------------------

_BUCKET = "['office_manager', 'marketing', 'other', 'gm', 'owner_or_partner', 'unheard_of'][1 + c_custkey % 6]"


@query(f"""
select n, arg_min(c_custkey, (r, c_custkey)) as c_custkey, arg_min(role_bucket, (r, c_custkey)) as role_bucket from (select *, {_BUCKET} as role_bucket, [4, 2, 5, 1, 0, 6][1 + c_custkey % 6] as r from {_C} where c_custkey % 7 < 3) group by n
""")
def primary_choice(spark, sf_dir):
    b = F.get(F.array(*[F.lit(x) for x in ("office_manager", "marketing", "other", "gm", "owner_or_partner", "unheard_of")]), (key() % 6).cast("int"))
    c = customers(spark, sf_dir).where(key() % 7 < 3).select("n", "c_custkey", b.alias("role_bucket"))
    return contacts.primary_contact(c, "n", "c_custkey")


@query(f"""
with s as (select n, 'p' || (c_custkey % 5) as person, 'P' || (c_custkey % 5) as name, case when c_custkey % 4 = 0 then '' else 't' || (c_custkey % 3) end as title, c_custkey % 3 as r from {_C}),
g as (select n, person, max(name) as name, min(r) filter (where title <> '') as best, list_sort(list(distinct 's' || r)) as s from s group by n, person)
select n, person, name, 't' || best as title, array_to_string(s, ',') as sources, len(s) > 1 as corroborated from g
""")
def source_merge(spark, sf_dir):
    c = customers(spark, sf_dir).select("n", F.concat(F.lit("P"), (key() % 5).cast("string")).alias("name"), F.when(key() % 4 == 0, "").otherwise(F.concat(F.lit("t"), (key() % 3).cast("string"))).alias("title"),
                                        F.concat(F.lit("s"), (key() % 3).cast("string")).alias("source"), (key() % 3).alias("r"))
    out = contacts.merge_sources(c, "n", "name", "title", "source", F.col("r"))
    return out.select("n", "person", "name", "title", F.array_join("sources", ",").alias("sources"), "corroborated")


@query("""
with e as (select user_id, event_id, event_id % 4 as src, case when value < 150 then 'low' end as reason from events),
c as (select user_id, min(src) as src from e where reason is null group by user_id),
t as (select e.user_id, coalesce(string_agg(distinct e.src || ':' || reason, ',' order by e.src || ':' || reason), '') as qa_trail from e join c on e.user_id = c.user_id where e.src <= c.src group by e.user_id)
select e.user_id, e.event_id, t.qa_trail from e join c on e.user_id = c.user_id and e.src = c.src join t on t.user_id = e.user_id where e.reason is null
""")
def surviving_source(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 4).alias("src"), "value")
    out = contacts.first_surviving_source(e, "user_id", "src", F.when(F.col("value") < 150, "low"))
    return out.select("user_id", "event_id", F.array_join("qa_trail", ",").alias("qa_trail"))


@query(f"select c_mktsegment, count(*) as n, count(*) filter (where c_custkey % 3 > 0) as named, round(100.0 * count(*) filter (where c_custkey % 3 > 0) / count(*), 1) as named_pct from {_C} group by c_mktsegment")
def contact_summary(spark, sf_dir):
    c = customers(spark, sf_dir).withColumn("name", F.when(key() % 3 == 0, " ").otherwise(F.col("c_name")))
    return contacts.contact_summary(c, ["c_mktsegment"], "name")


@query(f"""
select 'ok' as kind, c_custkey as id from {_C} where c_custkey % 4 = 0 union all
select p, count(*) from (select ['', 'malformed', 'unknown_index', 'no_name'][1 + c_custkey % 4] as p from {_C}) where p <> '' group by p
""")
def bank_lines(spark, sf_dir):
    c = customers(spark, sf_dir)
    line = F.when(key() % 4 == 0, F.concat(key().cast("string"), F.lit("| Ann | Owner | gm | said | so"))).when(key() % 4 == 1, "no bars").when(
        key() % 4 == 2, F.concat((-key() - 1).cast("string"), F.lit("|a|b|c|d"))).otherwise(F.concat(key().cast("string"), F.lit("||b|c|d")))
    good, bad = contacts.parse_bank_lines(c.select(line.alias("line")), "line", c.select("c_custkey"), "c_custkey")
    return good.select(F.lit("ok").alias("kind"), F.col("c_custkey").alias("id")).unionByName(bad.select(F.col("problem").alias("kind"), F.col("n").alias("id")))


# --- gates ------------------------------------------------------------------------------------------------------------

@query(f"""
select c_custkey, case when c_acctbal < 0 then 'closed' when not (n in (3, 12) or n::varchar like '2%') then 'outside' end as active,
  case when c_acctbal > 5000 then 'far_from_hubs' when n > 15 then 'wrong_country' when c_custkey % 4 = 1 then 'wrong_region' end as footprint,
  case when n = 1 then 'deid' when n = 2 then 'unreachable' when c_acctbal < 1000 then 'no_pixel' when c_mktsegment = 'MACHINERY' then 'no_sales_route' else 'pass' end as signal,
  case when n < 5 then 'linkedin' when c_acctbal > 3000 then 'google' when c_custkey % 2 = 0 then 'meta_pending' else 'none' end as channel from {_C}
""")
def lead_gates(spark, sf_dir):
    c, n, b = customers(spark, sf_dir), F.col("n"), F.col("c_acctbal")
    code = n.cast("string")
    region = F.get(F.array(F.lit(""), F.lit("X"), F.lit("R"), F.lit("R")), (key() % 4).cast("int"))
    return c.select(
        "c_custkey", gates.active_footprint(closed=b < 0, postal=code, exact=["3", "12"], prefixes=["2"]).alias("active"),
        gates.footprint_reason(b, 5000, code, [str(i) for i in range(16)], region, ["R"]).alias("footprint"),
        gates.signal_gate(known=n == 1, reachable=n != 2, pixel=b >= 1000, sales_route=F.col("c_mktsegment") != "MACHINERY").alias("signal"),
        gates.ad_channel(linkedin=n < 5, google_trusted=b > 3000, meta=key() % 2 == 0).alias("channel"))


@query(f"""
select c_custkey, case when n = 3 and c_custkey % 2 = 0 then null else n::double end as lat, case when n = 3 and c_custkey % 2 = 0 then null else 2.0 * n end as lng,
  case when n < 8 then 'Qualified' when n < 16 then 'Review' else 'Exclude' end as label, case when c_acctbal > 0 and c_custkey % 2 = 0 then 'A' when c_acctbal > 0 or c_custkey % 2 = 0 then 'B' else 'C' end as priority,
  case when n = 1 then 'aggregator' when n = 2 then 'nonicp' when n = 4 then 'verify' when c_custkey % 100 > 0 and row_number() over (partition by case when n in (1, 2, 4) then 'x' || c_custkey else (c_custkey % 100)::varchar end order by c_custkey) > 1 then 'dup' else 'ok' end as split
from {_C}
""")
def verdict_map(spark, sf_dir):
    n = F.col("n")
    c = customers(spark, sf_dir).withColumns({"lat": n.cast("double"), "lng": 2.0 * n, "at": F.when(key() % 2 == 0, " ").otherwise("x"), "domain": F.when(key() % 100 == 0, "").otherwise((key() % 100).cast("string"))})
    c = gates.blank_centroids(c, [(3.0, 6.0)], lat="lat", lng="lng", address="at")
    c = gates.noise_split(c, "domain", ["c_custkey"], aggregator=n == 1, out_of_profile=n == 2, verify=n == 4)
    v = gates.verdict_label(n < 8, n < 16, large=F.col("c_acctbal") > 0, reachable=key() % 2 == 0)
    return c.select("c_custkey", "lat", "lng", v["label"].alias("label"), v["priority"].alias("priority"), "split")


# --- joins with provenance ----------------------------------------------------------------------------------------------

@query(f"""
with f as (select c_custkey as id, c_acctbal as fact from {_C} where c_custkey % 3 = 0), r as (select c_custkey, case when c_custkey % 5 = 0 then null else c_custkey - c_custkey % 6 end as rep from {_C})
select c_custkey, fact, case when coalesce(rep, c_custkey) <> c_custkey and id is not null then rep else -1 end as fanned_from from r left join f on id = coalesce(rep, c_custkey)
""")
def sibling_fan_out(spark, sf_dir):
    c = customers(spark, sf_dir)
    rows = c.select("c_custkey", F.when(key() % 5 == 0, None).otherwise(key() - key() % 6).alias("rep"))
    return matching.fan_out(rows, "c_custkey", "rep", c.where(key() % 3 == 0).select("c_custkey", F.col("c_acctbal").alias("fact"))).select("c_custkey", "fact", F.coalesce("fanned_from", F.lit(-1)).alias("fanned_from"))


@query("""
with a as (select distinct o_custkey as k from orders), b as (select c_custkey + 100 as k from customer)
select 'left' as side, count(*) as keys, count(*) filter (where k in (select k from b)) as matched, count(*) filter (where k not in (select k from b)) as unmatched from a union all
select 'right', count(*), count(*) filter (where k in (select k from a)), count(*) filter (where k not in (select k from a)) from b
""")
def join_audit(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("k"))
    right = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 100).cast("string").alias("k"))
    return matching.audited(left, right, "k")[1]


@query(f"""
select c_custkey, case when c_custkey % 2 = 0 and c_custkey % 4 = 0 then 'second' else 'first' end as site, case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then 'b' else 'c' end as web,
  case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then 'mail' else 'llm' end as web_source, case when c_custkey % 4 = 0 then 'good' else 'unread' end as label,
  case when c_custkey % 4 = 0 then 'high' else 'fallback' end as confidence from {_C}
""")
def provenance_joins(spark, sf_dir):
    c = customers(spark, sf_dir).withColumn("site", F.lit("first"))
    second = c.where(key() % 4 == 0).select("c_custkey", F.lit("second").alias("site"))
    out = matching.override(c, "c_custkey", second, "site", key() % 2 == 0)
    out = matching.first_known(out, {"maps": F.lit(" "), "mail": F.when(key() % 3 == 1, "b"), "llm": F.when(key() % 3 == 2, "c")}, "web")
    said = second.select("c_custkey", F.lit("good").alias("label"), F.lit("high").alias("confidence"))
    return matching.with_verdicts(out, "c_custkey", said, "unread").select("c_custkey", "site", "web", "web_source", "label", "confidence")


@query("""
with r as (select 'u' || (event_id % 50) as e, arg_max(event_type, event_id) as result from events group by 1)
select c_custkey, result from customer left join r on e = 'u' || c_custkey
""")
def verifier_results(spark, sf_dir):
    results = table(spark, sf_dir, "events").select(F.concat(F.lit(" U"), (F.col("event_id") % 50).cast("string")).alias("email"), F.col("event_type").alias("result"), "event_id")
    left = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("email"))
    return matching.by_email(left, "email", results, "event_id").select("c_custkey", "result")


@query("""
select p_partkey, string_split(p_name, ' ')[1] || '.com' as host, length(string_split(p_name, ' ')[1]) as score, true as same, true as fits, true as owns, 'accepted' as page,
  'phone' as evidence, true as kept, ['home', 'conflict', 'foreign', 'unknown'][1 + p_partkey % 4] as cross_check, replace(p_name, ' ', '') || '.com' as domain
from part where length(string_split(p_name, ' ')[1]) >= 4
""")
def host_recovery(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumns({"w": F.substring_index("p_name", " ", 1)}).where(F.length("w") >= 4)
    host = F.concat("w", F.lit(".com"))
    hosts = p.select("p_partkey", "p_name", F.explode(F.array(host, F.lit("none.org"), F.lit("zz.net"))).alias("host"))
    best = matching.best_host(hosts, "p_partkey", "p_name", "host", [])
    page = F.concat(F.lit("call (020) 555-01234 x "), F.col("p_name"))
    evidence = matching.page_evidence(page, F.lit("0205550123"), F.lit("Nowhere"))
    i = F.col("p_partkey")
    checked = matching.home_or_foreign(home=[i % 4 == 0, i % 4 == 1], foreign=i % 4 != 0)
    checked = F.when(i % 4 == 3, matching.home_or_foreign(home=[F.lit(None).cast("boolean")], foreign=F.lit(False))).otherwise(checked)
    return p.join(best, "p_partkey").select(
        "p_partkey", "host", "score", matching.same_company(F.col("p_name"), F.concat(F.col("w"), F.lit(" other")), []).alias("same"), matching.domain_fits(F.col("p_name"), host, []).alias("fits"),
        matching.name_owns(F.concat(F.lit("a@"), host), F.col("p_name")).alias("owns"), matching.brand_in_page(F.col("p_name"), page).alias("page"), evidence.alias("evidence"),
        matching.keep_by_evidence(evidence, F.lit("low")).alias("kept"), checked.alias("cross_check"), F.get(matching.candidate_domains(F.col("p_name"), ["com", "net"]), 0).alias("domain"))


@query(f"""
select 'hit' as kind, c_custkey as id, 'v' || n as value from {_C} where c_custkey % 3 > 0 and n % 2 = 0 union all
select 'ask', c_custkey, '' from {_C} where c_custkey % 3 = 0 or n % 2 = 1 union all
select 'cache', i, case when i % 2 = 0 and i < 20 then 'new' when i >= 100 then 'new' else 'v' || i end from (select unnest(range(0, 25)) as i union all select unnest(range(100, 120, 2))) where i % 2 = 0
""")
def cache_split(spark, sf_dir):
    c = customers(spark, sf_dir)
    cache = spark.range(0, 25, 2).select(F.col("id").cast("string").alias("name"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"), F.lit(1).alias("at"))
    hit, ask = matching.split_by_cache(c, F.when(key() % 3 == 0, "").otherwise(F.col("n").cast("string")), cache.drop("at"), "name")
    answers = spark.range(0, 20, 2).select(F.col("id").cast("string").alias("asked"), (F.col("id") + 100).cast("string").alias("brand"), F.lit("new").alias("value"), F.lit(2).alias("at"))
    grown = matching.grown_cache(cache, answers, ["asked", "brand"], "name", "at")
    return (hit.select(F.lit("hit").alias("kind"), F.col("c_custkey").alias("id"), "value").unionByName(ask.select(F.lit("ask").alias("kind"), F.col("c_custkey").alias("id"), F.lit("").alias("value")))
            .unionByName(grown.select(F.lit("cache").alias("kind"), F.col("name").cast("long").alias("id"), "value")))


# --- stored tables ------------------------------------------------------------------------------------------------------

@query("select user_id, arg_min(event_id, (event_type = 'error', event_id)) as event_id from events group by user_id")
def first_ok_text(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return store.first_ok(e, "user_id", "event_id", F.col("event_type") != "error").select("user_id", "event_id")


@query("""
select 'u' || user_id as email, arg_max(event_type, event_id) as verdict from events where event_type <> 'error' group by user_id
""")
def verdict_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("email"), "event_id",
                                              F.when(F.col("event_type") == "error", "unverified").otherwise(F.col("event_type")).alias("verdict"))
    return store.upsert_verdicts(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "email", "verdict", "event_id").select("email", "verdict")


@query(f"""
select n, min(c_custkey) as first_id, lower(s) as person from (select n, c_custkey, c_mktsegment as s from {_C} where c_custkey % 3 > 0) group by n, lower(s)
""")
def contact_upsert(spark, sf_dir):
    c = customers(spark, sf_dir)
    nested = c.groupBy("n").agg(F.collect_list(F.struct("c_custkey", F.when(key() % 3 == 0, "").when(key() % 3 == 1, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("name"))).alias("contacts"))
    rows = store.flat_contacts(nested, "n", "contacts")
    out = store.upsert_contacts(rows.where(key() % 2 == 0), rows.where(key() % 2 == 1), "n", "name", "c_custkey")
    return out.select("n", F.col("c_custkey").alias("first_id"), F.lower("name").alias("person"))


@query("""
select 'duplicate' as problem, count(*) as n from (select o_custkey from orders group by o_custkey having count(*) > 1) union all
select 'orphan', count(*) from orders where o_custkey % 150 >= 149
""")
def key_checks(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    twice = store.key_violations(o, ["o_custkey"]).agg(F.count("*").alias("n")).select(F.lit("duplicate").alias("problem"), "n")
    lost = store.orphans(o.withColumn("p", F.col("o_custkey") % 150), "p", spark.range(149), "id").agg(F.count("*").alias("n"))
    return twice.unionByName(lost.select(F.lit("orphan").alias("problem"), "n"))


@query(f"""
select c_custkey, floor(c_acctbal / 7 + 0.5)::bigint as amount, null as note from {_C} where c_custkey % 2 = 0 union all
select c_custkey, n, c_mktsegment from {_C} where c_custkey % 2 = 1
""")
def ledger(spark, sf_dir):
    c = customers(spark, sf_dir)
    old = c.where(key() % 2 == 1).select("c_custkey", F.col("n").alias("amount"), F.col("c_mktsegment").alias("note"))
    new = c.where(key() % 2 == 0).select("c_custkey", (F.col("c_acctbal") / 7).alias("amount"))
    whole = store.ledger_append(old.drop("note").limit(0), new, "amount").withColumn("extra", F.lit(1))
    return store.append_projected(old, whole)


@query("select doc_id, length(text) > 0 as some, octet_length(encode(text)) <= 200 as whole from documents")
def byte_cap(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    cut = store.cap_bytes(F.col("text"), 200)
    fine = (F.octet_length(cut) <= 200) & (F.octet_length(cut) > F.least(F.lit(196), F.octet_length("text") - 1)) & F.col("text").startswith(cut) & ~F.coalesce(cut.contains("�"), F.lit(False))
    return d.select("doc_id", (F.when(fine, F.length(cut)).otherwise(0) > 0).alias("some"), (cut == F.col("text")).alias("whole"))


# --- texts and places -----------------------------------------------------------------------------------------------------

@query("""
select p_partkey, 'Hi ' || p_name || ', re ' || case when p_size % 2 = 0 then 'your work' else p_type end as filled, '' as problems, 'site:x.com "' || p_name || '" ("owner" OR "founder")' as search,
  case when p_size < 10 then 'small' when p_size < 40 then 'mid' else 'above' end as band, case when p_size < 25 then 'west' else 'other' end as place,
  case when p_retailprice >= 1000 then 'high' when p_retailprice >= 920 then 'mid' else 'none' end as budget, 'user' || p_partkey as handle, p_name as at, p_size % 2 = 0 as real, 'acme' || p_size as ats
from part
""")
def text_items(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size, i = F.col("p_size"), F.col("p_partkey").cast("string")
    filled = slices.fill("Hi {{name}}, re {{topic}}", {"name": F.concat(F.col("p_name"), F.lit("\n")), "topic": F.when(size % 2 == 0, " ").otherwise(F.col("p_type"))}, fallbacks={"topic": "your work"})
    return p.select(
        "p_partkey", filled.alias("filled"), F.array_join(slices.fill_problems(filled, F.lit("Ann")), ",").alias("problems"), slices.search_query(F.col("p_name"), site="x.com", terms=["owner", "founder"]).alias("search"),
        slices.size_band(size, F.lit(""), {"small": 9, "mid": 39}).alias("band"), slices.geo_bucket(F.when(size < 25, "San Jose, CA").otherwise("Oslo"), {"west": "san jose|oakland"}).alias("place"),
        slices.budget_tier(F.concat(F.lit("from $"), F.col("p_retailprice").cast("string")), {"mid": 920, "high": 1000}).alias("budget"),
        slices.handle(F.concat(F.lit("https://www.linkedin.com/in/User"), i, F.lit("/?x=1"))).alias("handle"), slices.brand_in_headline(F.concat(F.lit("Owner at "), F.col("p_name"), F.lit(" | Dad"))).alias("at"),
        slices.real_copy(F.when(size % 2 == 0, "we build good roofs here #roof").otherwise("#a #b #c #d #e now")).alias("real"),
        slices.ats_company(F.concat(F.lit("https://jobs.lever.co/Acme"), size.cast("string"), F.lit("/123"))).alias("ats"))


@query(f"""
select c_custkey, case when n < 10 then 'hub' end as label, case when n < 10 then 'nearest' else 'too_far_to_infer' end as label_source,
  case when n = 24 then 'unknown' when n <= 5 then case when c_custkey % 2 = 0 then 'spillover' else 'yes' end when n <= 8 then 'border' else 'spillover' end as tag,
  case when c_custkey % 3 = 0 then 'Town' when c_custkey % 3 = 1 then 'West End' else 'Hub' end as city, case when c_custkey % 3 = 0 then 'given' when c_custkey % 3 = 1 then 'area' else 'nearest' end as rung,
  case when n % 2 = 0 then 'Village' else 'Town' end as place from {_C}
""")
def place_inference(spark, sf_dir):
    n = F.col("n")
    near = F.struct(n.cast("double").alias("distance"), F.lit("hub").alias("name"))
    label = geo.inferred_label(near, 9)
    city = geo.city_by_rungs(F.when(key() % 3 == 0, "Town"), F.when(key() % 3 == 1, "1 Road, west end quarter"), {"end": "End", "west end": "West End"}, F.lit("Hub"))
    return customers(spark, sf_dir).select(
        "c_custkey", label["label"].alias("label"), label["source"].alias("label_source"), geo.footprint_tag(F.when(n != 24, n), n + F.when(key() % 2 == 0, -1).otherwise(1), 5, 8).alias("tag"),
        city["city"].alias("city"), city["rung"].alias("rung"), geo.locality({"suburb": F.when(n % 2 == 0, " Village ").otherwise("North District"), "town": F.lit("Town")}, "district").alias("place"))


@query("""
select n_nationkey as centre, q as query, i || '-' || n_nationkey as work_id from nation, (values ('000', 'roofer'), ('001', 'builder')) v(i, q)
""")
def grid_work(spark, sf_dir):
    return geo.grid_work(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("centre")), ["roofer", "builder"], "centre")


@query(f"""
select 'latitude_band' as problem, count(*) as n from {_C} where n > 20 union all select 'longitude_sign', count(*) from {_C} where c_custkey % 4 = 0 union all
select 'duplicate_id', count(*) from (select c_custkey // 2 from {_C} group by 1 having count(*) > 1)
""")
def coordinate_checks(spark, sf_dir):
    c = customers(spark, sf_dir).select(F.floor(key() / 2).alias("id"), F.col("n").alias("lat"), F.when(key() % 4 == 0, 5).otherwise(-5).alias("lng"))
    return geo.coordinate_problems(c, "id", lat="lat", lng="lng", south=0, north=20)
