"""Upserts into stored tables as functions of the table and the new rows, and checks of keys."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadloom.functions.text import is_blank


@dataclass(frozen=True)
class Table:
    """A stored table: its columns (DDL), primary key, columns that must not be null, further unique keys, references
    (column -> table and key) and SQL expressions for columns that are missing or null when rows are stored."""

    columns: str
    key: tuple[str, ...]
    needed: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# The tables of the store. JSON columns are strings.
STORE = {
    "runs": Table(
        "run_id string, client string, country string, started_at timestamp, finished_at timestamp, config string",
        ("run_id",), ("client", "country", "started_at", "config"), defaults={"started_at": "now()", "config": "'{}'"}),
    "places": Table(
        "place_id string, business_id string, name string, country string, lat double, lng double, full_address string, city string, region string, website string, "
        "root_domain string, google_types array<string>, review_count int, rating decimal(3,2), first_seen_run string, last_seen_run string, raw string",
        ("place_id",), ("name", "country", "google_types", "raw"), parents={"first_seen_run": ("runs", "run_id"), "last_seen_run": ("runs", "run_id")},
        defaults={"google_types": "cast(array() as array<string>)", "raw": "'{}'"}),
    "site_text": Table(
        "root_domain string, fetched_at timestamp, status string, source string, pages string, text string, emails string, emails_by_source string, socials string",
        ("root_domain",), ("fetched_at", "status", "source", "pages", "emails", "emails_by_source", "socials"),
        defaults={"fetched_at": "now()", "pages": "'[]'", "emails": "'[]'", "emails_by_source": "'{}'", "socials": "'{}'"}),
    "email_verdicts": Table(
        "email string, mv_result string, bb_result string, verdict string, detail string, verified_at timestamp",
        ("email",), ("verdict", "verified_at"), defaults={"verified_at": "now()"}),
    "registry_matches": Table(
        "place_id string, registry string, match_key string, basis string, confidence string, officers string, matched_at timestamp",
        ("place_id", "registry", "match_key"), ("officers", "matched_at"), parents={"place_id": ("places", "place_id")},
        defaults={"officers": "'[]'", "matched_at": "now()"}),
    "contacts": Table(
        "id string, place_id string, name string, first_name string, title string, role_bucket string, source string, evidence string, confidence string, run_id string",
        ("id",), ("place_id", "name", "role_bucket", "source"), (("place_id", "name", "run_id"),), {"place_id": ("places", "place_id"), "run_id": ("runs", "run_id")},
        {"id": "uuid()"}),
    "ledger": Table(
        "id string, run_id string, service string, credits int, note string, logged_at timestamp",
        ("id",), ("service", "credits", "logged_at"), parents={"run_id": ("runs", "run_id")}, defaults={"id": "uuid()", "logged_at": "now()"}),
}


def conformed(df: DataFrame, table: Table) -> DataFrame:
    """The columns of a stored table in its order and types, with its defaults; columns it does not have are dropped.

    Ids made by default are random: write the result before it is used twice.
    """
    have = {c.lower() for c in df.columns}
    kinds = {f.name: f.dataType for f in table.schema.fields}
    given = {c: F.col(c).cast(k) if c.lower() in have else F.lit(None).cast(k) for c, k in kinds.items()}
    return df.select(*[(F.coalesce(v, F.expr(table.defaults[c]).cast(kinds[c])) if c in table.defaults else v).alias(c) for c, v in given.items()])


def store_violations(tables: dict[str, DataFrame], schema: dict[str, Table] = STORE) -> DataFrame:
    """(table, rule, n): broken rules of stored tables and the rows (or keys) that break them; empty if all is well.

    Rules: ``key a, b`` (repeated or null), ``unique a, b`` (repeated; keys with a null part never are), ``needed a`` (null),
    ``parent a`` (refers to a row that is not there; checked where the parent table is given).
    """
    found = []
    for name, df in tables.items():
        t = schema[name]
        checks = [("key " + ", ".join(t.key), key_violations(df, list(t.key)))]
        checks += [("unique " + ", ".join(u), key_violations(df.dropna(subset=list(u)), list(u))) for u in t.unique]
        checks += [(f"needed {c}", df.where(F.col(c).isNull())) for c in t.needed]
        checks += [(f"parent {c}", orphans(df, c, tables[p], k)) for c, (p, k) in t.parents.items() if p in tables]
        found += [broken.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), F.lit(rule).alias("rule"), "n") for rule, broken in checks]
    return reduce(DataFrame.unionByName, found).where("n > 0")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, n) of keys that are not unique or have a null part."""
    null = F.greatest(*[F.col(k).isNull().cast("int") for k in key], F.lit(0)) == 1
    return df.groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | null)


def orphans(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key is in no row of the parent; a null key refers to nothing."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("__p")).distinct(), F.col(column) == F.col("__p"), "left_anti")


def first_ok(df: DataFrame, key: str, order: str, ok: Column) -> DataFrame:
    """For each key its first row, unless that was not ok and a later one is: then the first ok row."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct((~F.coalesce(ok, F.lit(False))).alias("bad"), F.col(order).alias("o"))).alias("m")).select(key, "m.*")


def upsert_verdicts(stored: DataFrame, new: DataFrame, key: str, verdict: str, order: str) -> DataFrame:
    """The last verdict of each address in either table; unverified is never stored."""
    every = stored.unionByName(new).where(F.coalesce(F.col(verdict), F.lit("unverified")) != "unverified").withColumn(key, F.lower(F.trim(key)))
    rest = [c for c in every.columns if c not in (key, order)]
    return every.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("m")).select(key, "m.*")


def upsert_contacts(stored: DataFrame, new: DataFrame, lead: str, name: str, order: str) -> DataFrame:
    """The first contact of each lead and lower-case name over both tables; rows without a name are left out."""
    every = stored.unionByName(new).where(~is_blank(F.col(name))).withColumn("__n", F.lower(F.trim(name)))
    rest = [c for c in every.columns if c not in (lead, "__n")]
    return every.groupBy(lead, "__n").agg(F.min_by(F.struct(*rest), F.col(order)).alias("m")).select(lead, "m.*")


def flat_contacts(leads: DataFrame, lead: str, contacts: str) -> DataFrame:
    """A row for each contact of a nested array; leads without contacts have none."""
    return leads.select(lead, F.explode(contacts).alias("c")).select(lead, "c.*")


def ledger_append(ledger: DataFrame, new: DataFrame, amount: str) -> DataFrame:
    """The ledger with new rows, amounts rounded half up to whole numbers (also below zero: -2.5 becomes -2)."""
    return ledger.unionByName(new.withColumn(amount, F.floor(F.col(amount) + 0.5).cast("long")))


def append_projected(main: DataFrame, new: DataFrame) -> DataFrame:
    """``main`` with rows of ``new``, by the columns of ``main``; more columns are dropped, missing ones are null."""
    have = {c.lower() for c in new.columns}
    return main.unionByName(new.select(*[F.col(c) if c.lower() in have else F.lit(None).cast(main.schema[c].dataType).alias(c) for c in main.columns]))


def cap_bytes(c: Column, most: int = 8000) -> Column:
    """A text cut to at most ``most`` bytes of UTF-8, without a broken last character."""
    raw = F.encode(c, "UTF-8")
    cut = F.substring(raw, 1, most)
    after = F.hex(F.substring(raw, most + 1, 1))
    inside = after.rlike("^[89AB]")  # the next byte goes on with a character: its beginning goes too
    tail = F.regexp_extract(F.hex(F.substring(cut, -4, 4)), "((?:[CDEF][0-9A-F])(?:[89AB][0-9A-F])*)$", 1)
    kept = F.when(inside, F.substring(cut, F.lit(1), F.octet_length(cut) - (F.length(tail) / 2).cast("int"))).otherwise(cut)
    return F.when(F.octet_length(c) <= most, c).otherwise(F.decode(kept, "UTF-8"))
