"""Column functions on names, numbers, addresses of the web, phones, e-mail and markup."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Second-level labels under which a country's domains are registered, company forms, hosts of free mail
# (in all countries, and more of them by country), boxes that are no person's.
SECOND_LEVEL = ["co", "com", "org", "net", "gov", "edu", "ac", "ltd", "plc", "me", "sch", "nhs", "id", "asn", "gob"]
COMPANY_FORMS = ["inc", "llc", "ltd", "limited", "corp", "corporation", "gmbh", "plc"]
FREE_MAIL = (r"^(gmail|googlemail|hotmail|outlook|yahoo|live|aol|icloud|me|btinternet|btconnect|sky|talktalk|virginmedia|ntlworld|blueyonder|hotmail\.co|yahoo\.co|"
             r"mail|protonmail|msn)\.")
FREE_MAIL_OF = {
    "au": r"^(bigpond|optusnet|iinet|tpg|westnet|internode|dodo|adam|ozemail|y7mail|exemail|aapt|iprimus|primus|netspace|optushome|people|live|yahoo|hotmail|outlook)"
          r"\.(com\.au|net\.au|com|net)$",
}
GENERIC_BOXES = [
    "info", "enquiries", "enquiry", "hello", "sales", "office", "admin", "contact", "mail", "enquire", "email", "hi", "estimates", "quotes", "quote", "team",
    "accounts", "support", "service", "services", "help", "bookings", "booking", "orders", "office", "reception", "customerservice", "customer", "general", "main",
    "post", "web", "site", "director", "manager", "md", "boss", "owner", "company", "business", "work", "home", "me", "you", "us",
]


def blank_if_null(c: Column) -> Column:
    """Text with null as the empty string: every blank test works on trimmed text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for each row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), 0)


def is_blank(c: Column) -> Column:
    return F.trim(blank_if_null(c)) == ""


def lenient_number(c: Column) -> Column:
    """The number at the start of a text once all but digits, points and signs are gone, or null."""
    kept = F.regexp_replace(blank_if_null(c), r"[^0-9.\-]", "")
    return F.nullif(F.regexp_extract(kept, r"^-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)", 0), F.lit("")).try_cast("double")


def strict_number(c: Column) -> Column:
    """The number that the whole trimmed text is, or null."""
    return F.nullif(F.trim(blank_if_null(c)), F.lit("")).try_cast("double")


def whole_number(c: Column) -> Column:
    """The leading integer of a text, else 0."""
    return F.coalesce(F.nullif(F.regexp_extract(F.trim(blank_if_null(c)), r"^[+-]?[0-9]+", 0), F.lit("")).try_cast("int"), F.lit(0))


def flag(c: Column) -> Column:
    """true/1 and the like as a boolean; blank is null."""
    return F.when(is_blank(c), F.lit(None).cast("boolean")).otherwise(F.lower(F.trim(c.cast("string"))).isin("true", "1"))


def squash(c: Column) -> Column:
    return F.regexp_replace(F.lower(blank_if_null(c)), "[^a-z0-9]+", "")


def company_key(c: Column, forms: list[str] | None = None) -> Column:
    """Lower-case words of a company's name without its legal form; & counts as and."""
    text = F.regexp_replace(F.replace(F.lower(blank_if_null(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    text = F.regexp_replace(text, r"\b(?:" + "|".join(forms or COMPANY_FORMS) + r")\b", " ")
    return F.trim(F.regexp_replace(text, " +", " "))


def core_tokens(c: Column, stop: list[str]) -> Column:
    """Distinct words of a company key without stop words, in order."""
    words = F.array_distinct(F.filter(F.split(company_key(c), " "), lambda w: w != ""))
    return F.array_except(words, F.array(*[F.lit(w) for w in stop]).cast("array<string>"))


def host_of(url: Column) -> Column:
    """Lower-case host of an address, with or without scheme, without www. and port; blank if there is none."""
    return F.regexp_extract(F.lower(F.trim(blank_if_null(url))), r"^(?:[a-z][a-z0-9+.\-]*://)?(?:[^/?#@]*@)?(?:www\.)?([^/?#:\s]+\.[^/?#:\s]+)", 1)


def root_domain(host: Column) -> Column:
    """The registrable domain: the last two labels, or three where a country registers below a second level."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    three = (n >= 3) & (F.length(F.get(labels, n - 1)) == 2) & F.get(labels, n - 2).isin(SECOND_LEVEL)
    return F.array_join(F.slice(labels, F.greatest(F.lit(1), n - F.when(three, 2).otherwise(1)), F.lit(3)), ".")


def normal_url(url: Column) -> Column:
    """An address without scheme, www., fragment and trailing slashes."""
    bare = F.regexp_replace(F.trim(blank_if_null(url)), r"#.*$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)^[a-z][a-z0-9+.\-]*://(?:www\.)?", ""), "/+$", "")


def on_shared_host(host: Column, shared: list[str]) -> Column:
    """Whether a host is a listed one or below it."""
    return F.coalesce(F.exists(F.array(*[F.lit(h) for h in shared]), lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h))), F.lit(False))


def phone_key(c: Column) -> Column:
    """The last ten digits of a phone number, or blank if it has fewer."""
    digits = F.regexp_replace(blank_if_null(c), "[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.substring(digits, -10, 10)).otherwise("")


def uk_phone(c: Column) -> Column:
    """Digits of a British number in national form (00 and 44 become 0), or blank if they are fewer than nine."""
    digits = F.regexp_replace(F.regexp_replace(blank_if_null(c), "[^0-9]", ""), "^00", "")
    national = F.regexp_replace(digits, "^44(?=[0-9]{9})", "0")
    return F.when(F.length(national) >= 9, national).otherwise("")


def us_phone(c: Column) -> Column:
    """struct(display, e164, key) of a number; other than ten digits (after a leading 1) are shown as given, without e164."""
    digits = F.regexp_replace(F.regexp_replace(blank_if_null(c), "[^0-9]", ""), "^1(?=[0-9]{10}$)", "")
    ten = F.length(digits) == 10
    return F.struct(F.when(ten, F.regexp_replace(digits, "^(...)(...)(....)$", "($1) $2-$3")).otherwise(F.trim(blank_if_null(c))).alias("display"),
                    F.when(ten, F.concat(F.lit("+1"), digits)).otherwise("").alias("e164"), digits.alias("key"))


def uk_postcode(c: Column) -> Column:
    """struct(full, outward) of the last postcode in a text, blank if none."""
    found = F.regexp_extract_all(F.upper(blank_if_null(c)), F.lit(r"\b([A-Z]{1,2}[0-9][A-Z0-9]?) ?([0-9][A-Z]{2})\b"), F.lit(0))
    last = F.replace(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("")), F.lit(" "), F.lit(""))
    return F.struct(last.alias("full"), F.when(last == "", "").otherwise(last.substr(F.lit(1), F.length(last) - 3)).alias("outward"))


def html_to_text(markup: Column) -> Column:
    """Text of a page: no scripts, styles and comments, blocks as lines, entities decoded, spaces collapsed."""
    text = F.regexp_replace(blank_if_null(markup), r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav)\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    return F.trim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"))


def page_links(markup: Column) -> Column:
    """Targets of a page's links, in order."""
    return F.regexp_extract_all(blank_if_null(markup), F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*\"([^\"]*)\""), F.lit(1))


def emails_in(text: Column) -> Column:
    """Distinct lower-case e-mail addresses of a text, in order."""
    found = F.regexp_extract_all(F.lower(blank_if_null(text)), F.lit(r"[a-z0-9._%+\-]+@[a-z0-9\-]+(?:\.[a-z0-9\-]+)*\.[a-z]{2,}"), F.lit(0))
    return F.array_distinct(found)


def email_kind(email: Column) -> Column:
    """person, generic or other, by the shape of the local part."""
    local = F.regexp_replace(F.substring_index(email, "@", 1), "[0-9]+$", "")
    return F.when(F.regexp_replace(local, "[._-]+$", "").isin(GENERIC_BOXES), "generic").when(local.rlike(r"^[a-z]+[._-][a-z]+$|^[a-z]{2,}[._-]?$"), "person").otherwise("other")


def ownness(email: Column, root: Column) -> Column:
    """exact, subdomain or sibling relation of an address's host to a root domain, else blank."""
    host = F.substring_index(email, "@", -1)
    label = F.substring_index(root, ".", 1)
    return (F.when(root == "", "").when(host == root, "exact").when(host.endswith(F.concat(F.lit("."), root)), "subdomain")
            .when((F.length(label) >= 4) & (F.substring_index(root_domain(host), ".", 1) == label), "sibling").otherwise(""))


def email_score(email: Column, root: Column) -> Column:
    """Kind times ten plus ownness: persons before boxes, own hosts before others."""
    kind = F.when(email_kind(email) == "person", 3).when(email_kind(email) == "generic", 2).otherwise(1)
    own = F.when(ownness(email, root) != "", 3).when(F.substring_index(email, "@", -1).rlike(FREE_MAIL), 2).otherwise(1)
    return (kind * 10 + own).cast("int")


def decode_cf_email(token: Column) -> Column:
    """An address hidden as hex whose first byte is XORed with the others."""
    byte = lambda i: F.conv(token.substr(2 * i + 1, F.lit(2)), 16, 10).cast("int")
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.length(token) / 2).cast("int") - 1))
    return F.when(F.length(token) >= 4, F.array_join(F.transform(places, lambda i: F.char(byte(i).bitwiseXOR(byte(F.lit(0))))), ""))


def tags_by_pattern(text: Column, patterns: dict[str, str], none: str = "(untagged)") -> Column:
    """All labels whose pattern matches, joined by |, in the order given."""
    found = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for label, p in patterns.items()]))
    return F.when(F.size(found) > 0, F.array_join(found, "|")).otherwise(none)


def hits(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns match (each once)."""
    return sum((text.rlike(p).cast("int") for p in patterns[1:]), patterns and text.rlike(patterns[0]).cast("int"))


def overlap_share(a: Column, b: Column, of_larger: bool = True) -> Column:
    """Shared elements of two token arrays over the larger (or smaller) of both."""
    n = F.greatest(F.size(a), F.size(b)) if of_larger else F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def lenient_host(url: Column) -> Column:
    """Lower-case host of an address, a scheme added where it has none, without www.; the port and single labels stay, blank
    where there is no host."""
    text = F.trim(blank_if_null(url))
    whole = F.when(text.rlike(r"(?i)^[a-z][a-z0-9+.\-]*://"), text).otherwise(F.concat(F.lit("https://"), text))
    return F.regexp_replace(F.lower(F.regexp_extract(whole, r"(?i)^[a-z][a-z0-9+.\-]*://(?:[^/?#@\s]*@)?([^/?#@\s]+)", 1)), r"^www\.", "")


def strict_host(url: Column) -> Column:
    """As ``lenient_host``, but blank for an address without a scheme."""
    return F.when(F.trim(blank_if_null(url)).rlike(r"(?i)^[a-z][a-z0-9+.\-]*://"), lenient_host(url)).otherwise("")


def bare_domain(url: Column) -> Column:
    """An address in lower case without scheme, www. and path."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(blank_if_null(url))), r"^[a-z]+://", ""), r"^www\.|/.*$", "")


def board_key(c: Column, forms: list[str] | None = None) -> Column:
    """A job board's company: without points, commas and legal forms, squashed."""
    text = F.regexp_replace(F.lower(blank_if_null(c)), "[.,]", "")
    return squash(F.regexp_replace(text, r"\b(?:" + "|".join(forms or COMPANY_FORMS) + r")\b", " "))


def delivered_key(c: Column, forms: list[str] | None = None) -> Column:
    """A delivered list's company: & counts as and, without legal forms, squashed."""
    return F.replace(company_key(c, forms), F.lit(" "), F.lit(""))


def dealer_key(name: Column, zip_code: Column, suffixes: list[str]) -> Column:
    """A dealer's squashed name without a last suffix, and its postal code."""
    text = F.regexp_replace(F.lower(F.trim(blank_if_null(name))), r"[\s,]+(?:" + "|".join(suffixes) + r")\.?$", "")
    return F.concat_ws("|", squash(text), F.trim(blank_if_null(zip_code)))


def own_site_link(markup: Column) -> Column:
    """The first outside link after a profile page's heading, as a host, or blank."""
    after = F.regexp_extract(blank_if_null(markup), r"(?is)</h1\s*>(.*)$", 1)
    return lenient_host(F.regexp_extract(after, r"(?i)<a\b[^>]*\bhref\s*=\s*[\"'](https?://[^\"']+)", 1))


# Postcode areas outside England.
NATION_AREAS = {
    "SCT": ["AB", "DD", "DG", "EH", "FK", "G", "HS", "IV", "KA", "KW", "KY", "ML", "PA", "PH", "TD", "ZE"],
    "WLS": ["CF", "LD", "LL", "NP", "SA"],
    "NIR": ["BT"],
    "Isle of Man": ["IM"], "Guernsey": ["GY"], "Jersey": ["JE"],
}


def nation_of(address: Column, areas: dict[str, list[str]] = NATION_AREAS) -> Column:
    """The nation of an address by its last postcode's area; ENG for areas not listed, null without a postcode."""
    area = F.regexp_extract(uk_postcode(address)["outward"], "^[A-Z]+", 0)
    cases = F.when(area == "", F.lit(None).cast("string"))
    for nation, listed in areas.items():
        cases = cases.when(area.isin(listed), nation)
    return cases.otherwise("ENG")


def snippet(c: Column, pattern: str, reach: int = 110) -> Column:
    """The first match with ``reach`` characters on both sides, white space squashed; blank without a match."""
    before, match = F.split(c, pattern, 2)[0], F.regexp_extract(c, pattern, 0)
    after = c.substr(F.length(before) + F.length(match) + 1, F.lit(reach))
    around = F.concat(F.right(before, F.lit(reach)), match, after)
    return F.when(c.rlike(pattern), F.trim(F.regexp_replace(around, r"\s+", " "))).otherwise("")


def tiered(c: Column, *, strong: str, core: list[str], adjacent: list[str], new: list[str], reach: int = 110) -> Column:
    """struct(tier, core, adjacent, new, evidence): A by a strong pattern or two core ones, B by an adjacent one, C by a new
    or one core pattern, D otherwise. Counts are of different patterns; evidence is a snippet of the first pattern that
    matches, in the order strong, core, adjacent, new."""
    n_core, n_adjacent, n_new = hits(c, core), hits(c, adjacent), hits(c, new)
    tier = F.when(c.rlike(strong) | (n_core >= 2), "A").when(n_adjacent >= 1, "B").when((n_new >= 1) | (n_core == 1), "C").otherwise("D")
    evidence = F.coalesce(*[F.when(c.rlike(p), snippet(c, p, reach)) for p in (strong, *core, *adjacent, *new)], F.lit(""))
    return F.struct(tier.alias("tier"), n_core.alias("core"), n_adjacent.alias("adjacent"), n_new.alias("new"), evidence.alias("evidence"))
