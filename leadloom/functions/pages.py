"""Column functions on pages: cards of a listing, JSON objects inside text, social profiles, shared boilerplate."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F

from leadloom.functions.text import blank_if_null, let

# Social networks by host, and first path segments that are no profiles.
NETWORKS = {
    "facebook": r"(^|\.)(facebook\.com|fb\.com|fb\.me)$", "instagram": r"(^|\.)instagram\.com$", "linkedin": r"(^|\.)linkedin\.com$", "x": r"(^|\.)(twitter\.com|x\.com)$",
    "tiktok": r"(^|\.)tiktok\.com$", "youtube": r"(^|\.)(youtube\.com|youtu\.be)$", "yelp": r"(^|\.)yelp\.(com|co\.uk|ca|com\.au)$",
}
NO_PROFILE = (
    "sharer sharer.php share dialog plugins login signup hashtag explore intent policies privacy help legal tr about business ads marketplace groups events watch "
    "reel reels p stories home.php search feed posts pulse shareArticle embed playlist results biz writeareview i tag accounts settings static").split()
#: Of each network: first path segments that introduce a profile, and how many segments of the path name it.
PROFILE_PATHS = {
    "linkedin": [("company|in|school", 2, 2)], "youtube": [("@.*", 1, 1), ("channel|c|user", 2, 2)], "yelp": [("biz", 2, 2)],
    "facebook": [("pages|people|pg", 2, 3)],
}
#: Networks where only the listed paths are profiles.
LISTED_ONLY = ["linkedin", "youtube", "yelp"]


def cards(markup: Column, start: str, fields: dict[str, str], *, end: str | None = None) -> Column:
    """Array of structs, one for each card of a listing page.

    A card begins where ``start`` matches and ends before the next one (or at ``end``). A field is its pattern's first
    group with tags removed and spaces collapsed, blank where it does not match.
    """
    parts = F.filter(F.split(blank_if_null(markup), f"(?={start})"), lambda p: p.rlike(f"^(?:{start})"))
    if end:
        parts = F.transform(parts, lambda p: F.regexp_replace(p, f"(?s)(?:{end}).*$", ""))
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"\s+", " "))
    return F.transform(parts, lambda p: F.struct(*[clean(F.regexp_extract(p, pattern, 1)).alias(name) for name, pattern in fields.items()]))


def json_objects(text: Column, marker: str) -> Column:
    """Array of the JSON objects (as compact text) that begin with ``marker`` anywhere in a text; broken ones are left out."""
    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder()

        def objects(t: str | None) -> list[str]:
            out, at = [], (t or "").find(marker)
            while at >= 0:
                try:
                    out.append(json.dumps(decoder.raw_decode(t, at)[0], separators=(",", ":"), ensure_ascii=False))
                except ValueError:
                    pass
                at = t.find(marker, at + 1)
            return out

        return texts.map(objects)

    return found(text)


def social_profiles(text: Column, most: int = 2) -> Column:
    """Map from network to its distinct profile addresses (``most`` each), in the order of the text.

    Shares, logins and roots are no profiles; LinkedIn keeps companies, persons and schools, YouTube channels only.
    """
    def parts(raw: Column) -> Column:
        url = F.replace(F.regexp_replace(raw, r"[.,;:!?]+$", ""), F.lit("&amp;"), F.lit("&"))
        host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^https?://(?:[^/@?#]*@)?([^/?#:]+)", 1)), r"^(www|m|mobile|business)\.", "")
        path = F.filter(F.split(F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1), "/"), lambda s: s != "")
        return F.struct(host.alias("host"), path.alias("path"), F.regexp_extract(url, r"[?&]id=([^&#]+)", 1).alias("page_id"))

    def named(p: Column) -> Column:
        network = F.coalesce(*[F.when(p["host"].rlike(pattern), F.lit(name)) for name, pattern in NETWORKS.items()])
        return F.struct(p["host"].alias("host"), p["path"].alias("path"), p["page_id"].alias("page_id"), network.alias("network"))

    def place(p: Column) -> Column:
        network, path, n, first = p["network"], p["path"], F.size(p["path"]), F.coalesce(F.get(p["path"], 0), F.lit(""))
        plain = ~first.isin(*NO_PROFILE) & ~first.rlike(r"(?i)\.(php|html)$") & (F.length(first) >= 2)
        keep = F.when((network == "facebook") & (first == "profile.php"), F.when(p["page_id"] != "", F.array(F.concat(F.lit("profile.php?id="), p["page_id"]))))
        for name, paths in PROFILE_PATHS.items():
            for segment, least, taken in paths:
                keep = keep.when((network == name) & first.rlike(f"(?i)^(?:{segment})$"), F.when(n >= least, F.slice(path, 1, taken)))
        keep = keep.when(~network.isin(*LISTED_ONLY) & plain, F.slice(path, 1, 1))
        return F.struct(network.alias("network"), F.concat(F.lit("https://"), p["host"], F.lit("/"), F.array_join(keep, "/")).alias("url"))

    def lists(found: Column) -> Column:
        of = lambda network: F.slice(F.transform(F.filter(found, lambda x: x["network"] == network), lambda x: x["url"]), 1, most)
        return F.array(*[F.struct(F.lit(n).alias("key"), of(n).alias("value")) for n in NETWORKS])

    raw = F.regexp_extract_all(blank_if_null(text), F.lit(r"""(?i)https?://[^\s"'<>()\[\]\\]+"""), F.lit(0))
    known = F.filter(F.transform(F.transform(raw, parts), named), lambda p: p["network"].isNotNull())
    found = F.array_distinct(F.filter(F.transform(known, place), lambda x: x["url"].isNotNull()))
    return F.map_from_entries(F.filter(let(found, lists), lambda e: F.size(e["value"]) > 0))


def strip_shared(texts: Column, least: int = 60) -> Column:
    """An array of one site's page texts without the start and the end that all of them share (``least`` characters each).

    The length of a shared start is found by halving steps, each a comparison of two slices: no more memory than the texts.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def same(a: Column, b: Column) -> Column:
        most = F.least(F.length(a), F.length(b))
        return F.aggregate(steps, F.lit(0), lambda n, s: F.when((s <= most - n) & (a.substr(n + 1, s) == b.substr(n + 1, s)), n + s).otherwise(n))

    first = F.get(texts, 0)
    shared = lambda turn: F.aggregate(texts, F.length(first), lambda n, t: F.least(n, same(turn(first), turn(t))))
    some = lambda n: F.when(n >= least, n).otherwise(0)
    bounds = F.struct(some(shared(lambda t: t)).alias("pre"), some(shared(F.reverse)).alias("suf"))

    def cut(t: Column, b: Column) -> Column:
        end = F.greatest(b["pre"], F.length(t) - b["suf"])
        return F.trim(F.when(b["pre"] < F.length(t), t.substr(b["pre"] + 1, end - b["pre"])).otherwise(t))

    done = F.get(F.transform(F.array(bounds), lambda b: F.transform(texts, lambda t: cut(t, b))), 0)
    return F.when(F.size(texts) < 2, texts).otherwise(done)
