"""Column functions on postal addresses: keys of streets and brands, floors, cities, states and postcodes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadloom.functions.text import blank_if_null

# Words of units inside a building, company words of brand keys, usual short forms of street words.
UNIT_WORDS = ["suite", "ste", "unit", "shop", "floor", "flr", "rm", "room", "block", "wing"]
BRAND_STOP = ["ltd", "limited", "plc", "inc", "llc", "nig", "nigeria", "ng", "company", "co", "enterprises", "ventures", "int'l", "international", "group"]
STREET_SHORT = {"street": "st", "avenue": "ave", "road": "rd", "drive": "dr", "boulevard": "blvd", "lane": "ln", "court": "ct", "place": "pl", "highway": "hwy",
                "parkway": "pkwy", "square": "sq", "terrace": "ter", "circle": "cir", "north": "n", "south": "s", "east": "e", "west": "w"}


def _words(c: Column, keep: str = "") -> Column:
    text = F.regexp_replace(F.lower(blank_if_null(c)), f"[^a-z0-9\\s{keep}]", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _without(c: Column, phrases: list[str]) -> Column:
    longest_first = "|".join(sorted(phrases, key=lambda p: (-len(p), p)))
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"\b(?:{longest_first})\b", " "), r"\s+", " ")) if phrases else c


def union_name(c: Column) -> Column:
    """A name in lower case that keeps apostrophes, ampersands and hyphens."""
    return _words(c, r"'&\-")


def brand_key(name: Column, places: list[str] = (), stop: list[str] = BRAND_STOP) -> Column:
    """The first two words of a name without company and place words; the whole name if nothing is left."""
    rest = _without(_without(union_name(name), list(stop)), list(places))
    return F.coalesce(F.nullif(F.substring_index(rest, " ", 2), F.lit("")), union_name(name))


def street_key(address: Column, name: Column, places: list[str] = (), postcode: str = r"\d{6}") -> Column:
    """A building's key: the address without plus code, leading business name, units, postcode and places; blank without a digit."""
    a = F.regexp_replace(blank_if_null(address), r"^[A-Z0-9]{4}\+[A-Z0-9]{2,3}\s*", "")
    n = F.trim(blank_if_null(name))
    a = F.when((n != "") & F.lower(a).startswith(F.lower(n)), a.substr(F.length(n) + 1, F.length(a))).otherwise(a)
    a = _words(a, r"'&\-")
    a = F.regexp_replace(a, rf"\b(?:{'|'.join(UNIT_WORDS)})\s*[a-z0-9-]*", " ")
    a = _without(F.trim(F.regexp_replace(F.regexp_replace(a, rf"\b(?:{postcode})\b", " "), r"\s+", " ")), list(places))
    return F.when(a.rlike("[0-9]"), a).otherwise("")


def short_street(address: Column) -> Column:
    """The first comma part up to a suite or unit, street words shortened, without spaces and signs."""
    part = F.regexp_replace(F.lower(F.substring_index(blank_if_null(address), ",", 1)), r"(?:\b(?:suite|ste|unit|apt|bldg)\b|\s#).*$", "")
    words = F.filter(F.split(F.regexp_replace(part, "[^a-z0-9]+", " "), " "), lambda w: w != "")
    short = F.create_map(*[F.lit(x) for pair in STREET_SHORT.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), "")


def floor_of(address: Column) -> Column:
    """The floor that an address names, or null."""
    return F.nullif(F.regexp_extract(F.lower(blank_if_null(address)), r"([0-9]{1,2})(?:st|nd|rd|th)?\s*floor", 1), F.lit("")).cast("int")


def us_place(address: Column) -> Column:
    """struct(city, state, zip) of the "City, ST 12345" in an address, blank where there is none."""
    pattern = r",\s*([A-Za-z .'\-]+),\s*([A-Z]{2})\s*([0-9]{5})?"
    return F.struct(*[F.trim(F.regexp_extract(blank_if_null(address), pattern, k)).alias(n) for k, n in enumerate(("city", "state", "zip"), 1)])


def city_of(city: Column, address: Column, region: list[str] = ()) -> Column:
    """The city without what follows a comma, else the one of the address; names of streets and regions are no cities."""
    given = F.trim(F.substring_index(blank_if_null(city), ",", 1))
    found = F.when(given != "", given).otherwise(us_place(address)["city"])
    found = F.regexp_replace(found, r"(?i)^(?:city|shire|town|municipality) of\s+", "")
    barred = found.rlike("[0-9]") | found.rlike(r"(?i)\b(?:street|road|avenue|drive|lane|highway)$") | F.lower(found).isin(*[r.lower() for r in region] or [""])
    return F.when(barred, "").otherwise(F.initcap(found))


def postal_code(text: Column, pattern: str = r"\b([0-9]{5})(?:-[0-9]{4})?\b") -> Column:
    """The last postal code of a text (its pattern's first group), or blank."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(blank_if_null(text), F.lit(pattern), F.lit(1)), F.lit(-1)), F.lit(""))


def state_from_box(lat: Column, lng: Column, boxes: dict[str, tuple[float, float, float, float]]) -> Column:
    """The first state whose box (south, north, west, east) holds a point, or blank."""
    out = None
    for state, (south, north, west, east) in boxes.items():
        hit = lat.between(south, north) & lng.between(west, east)
        out = F.when(hit, state) if out is None else out.when(hit, state)
    return F.lit("") if out is None else out.otherwise("")
