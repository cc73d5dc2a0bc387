"""Column functions that pick, cut and fill texts: page slices within a budget, cue lines, templates, queries, copy."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadloom.functions.text import blank_if_null, is_blank


def flat(c: Column) -> Column:
    """A value on one line: line breaks and runs of spaces are one space."""
    return F.trim(F.regexp_replace(blank_if_null(c), r"\s+", " "))


def page_title(markup: Column) -> Column:
    return flat(F.regexp_extract(blank_if_null(markup), r"(?is)<title[^>]*>(.*?)</title>", 1))


def pruned(markup: Column, most: int = 2500) -> Column:
    """TITLE | META | BODY of a page without navigation, footers and drawings, the body cut to ``most`` characters."""
    h = blank_if_null(markup)
    meta = flat(F.regexp_extract(h, r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["']([^"']*)""", 1))
    body = F.regexp_replace(h, r"(?is)<(script|style|noscript|nav|footer|svg|title)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.concat_ws(" | ", page_title(h), meta, F.substring(flat(F.regexp_replace(body, r"<[^>]*>", " ")), 1, most))


def link_score(path: Column, anchor: Column, words: list[str]) -> Column:
    """How many of some words a link's path and text hold."""
    text = F.lower(F.concat_ws(" ", blank_if_null(path), blank_if_null(anchor)))
    return sum((text.contains(w.lower()).cast("int") for w in words), F.lit(0))


def best_links(links: Column, words: list[str], most: int = 6) -> Column:
    """The ``most`` best distinct paths of an array of struct(path, anchor), by score, then in their order."""
    scored = F.filter(F.transform(links, lambda x, i: F.struct((-link_score(x["path"], x["anchor"], words)).alias("no"), i.alias("i"), x["path"].alias("path"))), lambda s: s["no"] < 0)
    return F.slice(F.array_distinct(F.transform(F.array_sort(scored), lambda s: s["path"])), 1, most)


def within_budget(parts: Column, most: int) -> Column:
    """Texts of an array, in order, joined by line breaks as long as all fit in ``most`` characters; the one that does not is cut."""
    start = F.lit("").cast("string")
    return F.substring(F.aggregate(parts, start, lambda out, p: F.when(F.length(out) >= most, out).when(out == "", p).otherwise(F.concat(out, F.lit("\n"), p))), 1, most)


def preferred_first(pages: Column, pattern: str, most: int) -> Column:
    """Pages (struct(path, text)) as one text of ``most`` characters, those whose path matches first."""
    ordered = F.array_sort(F.transform(pages, lambda p, i: F.struct((~F.lower(p["path"]).rlike(pattern)).alias("later"), i.alias("i"), p["text"].alias("text"))))
    return within_budget(F.transform(ordered, lambda p: p["text"]), most)


def one_page_and_home(pages: Column, pattern: str, most: int) -> Column:
    """The first page whose path matches and the first page, as one text of ``most`` characters."""
    hit = F.get(F.filter(pages, lambda p: F.lower(p["path"]).rlike(pattern)), 0)
    return within_budget(F.array_distinct(F.array_compact(F.array(hit["text"], F.get(pages, 0)["text"]))), most)


def cue_lines_first(text: Column, cue: str, most: int) -> Column:
    """A text's distinct lines, those with a cue first, cut to ``most`` characters."""
    lines = F.array_distinct(F.filter(F.transform(F.split(blank_if_null(text), "\n"), F.trim), lambda x: x != ""))
    hits, rest = F.filter(lines, lambda x: x.rlike(cue)), F.filter(lines, lambda x: ~x.rlike(cue))
    return within_budget(F.concat(hits, rest), most)


def combined(parts: list[Column], most_bytes: int) -> Column:
    """Texts in their priority, each taken whole or left out, within ``most_bytes`` bytes of UTF-8."""
    out = F.lit("")
    for part in parts:
        more = F.when(out == "", blank_if_null(part)).otherwise(F.concat(out, F.lit("\n"), blank_if_null(part)))
        out = F.when(is_blank(part) | (F.octet_length(more) > most_bytes), out).otherwise(more)
    return out


def fill(template: str, values: dict[str, Column], *, fallbacks: dict[str, str] | None = None, most: int | None = None) -> Column:
    """A template with {{name}} filled by flat values, a fallback where a value is blank; unknown names stay for the checker."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.when(is_blank(value), (fallbacks or {}).get(name, "")).otherwise(flat(value)))
    return F.substring(out, 1, most) if most else out


def fill_problems(text: Column, name: Column) -> Column:
    """The rules that a filled text breaks: unfilled, line_break, name_case (a name in capitals)."""
    return F.array_compact(F.array(F.when(text.rlike(r"\{\{|\}\}"), "unfilled"), F.when(text.rlike(r"[\r\n]"), "line_break"), F.when(name.rlike("^[A-Z]{3,}$"), "name_case")))


def search_query(phrase: Column, *, site: str = "", terms: list[str] = ()) -> Column:
    """A quoted phrase with a site and alternatives for a search engine."""
    parts = [F.lit(f"site:{site}")] * bool(site) + [F.concat(F.lit('"'), flat(phrase), F.lit('"'))] + [F.lit("(" + " OR ".join(f'"{t}"' for t in terms) + ")")] * bool(terms)
    return F.when(~is_blank(phrase), F.concat_ws(" ", *parts)).otherwise("")


def size_band(employees: Column, stage: Column, bands: dict[str, int]) -> Column:
    """The first band whose upper bound holds a number of employees, else one that a stage's text names, else unknown."""
    out = None
    for band, most in bands.items():
        out = F.when(employees <= most, band) if out is None else out.when(employees <= most, band)
    text = F.lower(blank_if_null(stage))
    return F.when(employees > 0, out.otherwise("above")).when(text.rlike("seed|pre-seed|angel"), next(iter(bands))).when(text.rlike("series [c-z]|public|ipo"), "above").otherwise("unknown")


def geo_bucket(text: Column, patterns: dict[str, str]) -> Column:
    """The first bucket whose pattern a head office's text matches, else other."""
    out = None
    for name, pattern in patterns.items():
        hit = F.lower(blank_if_null(text)).rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def budget_tier(text: Column, tiers: dict[str, int]) -> Column:
    """The highest tier whose bound the first amount of dollars in a text (k and m count) reaches, else none."""
    t = F.lower(F.replace(blank_if_null(text), F.lit(","), F.lit("")))
    unit = F.regexp_extract(t, r"\$\s*[0-9.]+\s*([km]?)", 1)
    low = F.nullif(F.regexp_extract(t, r"\$\s*([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).cast("double") * F.when(unit == "k", 1000).when(unit == "m", 1_000_000).otherwise(1)
    out = None
    for name, bound in sorted(tiers.items(), key=lambda x: -x[1]):
        out = F.when(low >= bound, name) if out is None else out.when(low >= bound, name)
    return out.otherwise("none")


def handle(url: Column) -> Column:
    """The handle of a profile's address, or blank."""
    return F.lower(F.regexp_extract(blank_if_null(url), r"(?i)^https?://[^/]+/(?:(?:in|company|school|channel|c|user|pages)/)?@?([A-Za-z0-9._-]+)", 1))


def brand_in_headline(headline: Column) -> Column:
    """The company after "at" or "@" in a headline, up to a separator, or blank."""
    return F.trim(F.regexp_extract(blank_if_null(headline), r"(?i)(?:^|\s)(?:at\s+|@\s*)([^|,;•·–—]+?)\s*(?:[|,;•·–—].*)?$", 1))


def real_copy(text: Column, least: int = 5) -> Column:
    """Whether a text has ``least`` words or more and more words than hashtags."""
    words = F.filter(F.split(flat(text), " "), lambda w: w != "")
    tags = F.size(F.filter(words, lambda w: w.startswith("#")))
    return (F.size(words) - tags >= least) & (F.size(words) - tags > tags)


def copy_key(text: Column) -> Column:
    """A text for comparing: lower case, without addresses of the web, hashtags, signs and runs of spaces."""
    t = F.regexp_replace(F.lower(blank_if_null(text)), r"https?://\S+|#\S+", " ")
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))


def ats_company(url: Column) -> Column:
    """The company's slug in the address of a job board's system, or blank."""
    u = F.lower(blank_if_null(url))
    return F.coalesce(*[F.nullif(F.regexp_extract(u, p, 1), F.lit("")) for p in (
        r"//(?:boards|job-boards)\.greenhouse\.io/([a-z0-9_-]+)", r"//jobs\.lever\.co/([a-z0-9_-]+)", r"//jobs\.ashbyhq\.com/([a-z0-9_.-]+)", r"//([a-z0-9-]+)\.(?:recruitee|bamboohr|workable)\.com")], F.lit(""))
