"""Personal data replaced by format-preserving Feistel pseudonyms, with DataFrame functions only.

One pattern finds candidates; each is validated by its kind: card numbers by the Luhn sum, bank account numbers (IBAN)
modulo 97, addresses of networks by their octets, social security numbers by their areas, dates by the calendar. A valid
value is permuted by a keyed Feistel network inside its format (digits stay digits, letters letters, separators stay;
check digits are made anew; a date is again a date). The permutation has no state, so equal values get equal pseudonyms
in all documents and tasks, different values different ones, and whoever holds the key can reverse it.

Scale: a row is rewritten within itself; nothing is shuffled. Texts without a digit or @ are passed on unread by the
candidate pattern.

Edge cases: a null text stays null and an empty one empty; candidates that fail their validation stay as they are;
repeated rows are rewritten alike; an empty table gives an empty result; extra columns stay; the counts go to one struct
column ``out_col`` (replacing a column of that name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadloom.llm.shared import fresh_prefix

ROUNDS = 8
KINDS = ["email", "iban", "ip", "date", "ssn", "phone", "card", "secret"]
# Candidate patterns by kind, in the order in which they are tried.
_L, _R = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": _L + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _R,
    "ip": r"(?<![\p{L}\p{N}.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\p{L}\p{N}])(?!\.[0-9])",
    "date": r"(?<![\p{L}\p{N}])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})" + _R,
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _R,
    "card": _L + r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _R,
    "secret": _L + r"(?:[0-9a-fA-F]{32,128}|AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,})" + _R,
}
CANDIDATE = "|".join(f"(?:{p})" for p in PATTERNS.values())
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
HEX_LOWER, HEX_UPPER = "abcdef", "ABCDEF"
#: Days of a block within which dates are permuted, as a product; the calendar's last block is smaller.
DATE_A, DATE_B, DATE_LAST_A, DATE_LAST_B = 292, 250, 29, 71
_FIRST_DAY = "0001-01-01"


def _prf(key: str, *parts: Column) -> Column:
    """A keyed pseudorandom number of 48 bits."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts], F.lit(key))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("long")


def _numbers(key: str, tag: str, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """Feistel over pairs (a below size_a, b below size_b) as struct(a, b)."""

    def step(s: Column, r: Column) -> Column:
        left = F.pmod(s["a"] + _prf(key, F.lit(tag), r, s["b"]), size_a)
        right = F.pmod(s["b"] + _prf(key, F.lit(tag), r, s["a"]), size_b)
        return F.struct(F.when(r % 2 == 0, left).otherwise(s["a"]).alias("a"), F.when(r % 2 == 1, right).otherwise(s["b"]).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _shifted(text: Column, key: str, tag: str, r: Column, by: Column, letters: list[str]) -> Column:
    """``text`` with each character moved within its class, by numbers drawn from ``by``."""

    def move(c: Column, i: Column) -> Column:
        out = c
        for alphabet in letters:
            at = F.instr(F.lit(alphabet), c)
            out = F.when(at > 0, F.substring(F.lit(alphabet), F.pmod(at - 1 + _prf(key, F.lit(tag), r, i, by), F.lit(len(alphabet))).cast("int") + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), move), "")


def _characters(key: str, tag: str, text: Column, letters: list[str]) -> Column:
    """Feistel over the halves of a string, each character within its class; other characters stay."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(s: Column, r: Column) -> Column:
        left = _shifted(s["a"], key, tag, r, s["b"], letters)
        right = _shifted(s["b"], key, tag, r, s["a"], letters)
        return F.struct(F.when(r % 2 == 0, left).otherwise(s["a"]).alias("a"), F.when(r % 2 == 1, right).otherwise(s["b"]).alias("b"))

    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, F.length(text)).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits."""
    def value(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 1, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, v: a + v) % 10


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(key: str, m: Column) -> Column:
    body = _characters(key, "card", m.substr(F.lit(1), F.length(m) - 1), [DIGITS])
    check = F.pmod(10 - _luhn(F.concat(_only_digits(body), F.lit("0"))), F.lit(10))
    return F.concat(body, check.cast("string"))


def _mod97(text: Column) -> Column:
    """The IBAN remainder of a string of digits and capital letters."""
    digits = F.transform(F.split(text, ""), lambda c: F.when(F.instr(F.lit(UPPER), c) > 0, F.instr(F.lit(UPPER), c) + 9).otherwise(c.cast("int")))
    return F.aggregate(digits, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _iban_ok(m: Column) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    return _mod97(F.concat(s.substr(F.lit(5), F.length(s)), s.substr(F.lit(1), F.lit(4)))) == 1


def _iban(key: str, m: Column) -> Column:
    body = _characters(key, "iban", m.substr(F.lit(5), F.length(m)), [DIGITS, UPPER])
    plain = F.replace(body, F.lit(" "), F.lit(""))
    check = 98 - _mod97(F.concat(plain, m.substr(F.lit(1), F.lit(2)), F.lit("00")))
    return F.concat(m.substr(F.lit(1), F.lit(2)), F.lpad(check.cast("string"), 2, "0"), body)


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda x: x.cast("int"))


def _ip(key: str, m: Column) -> Column:
    o = _octets(m)
    done = _numbers(key, "ip", F.get(o, 0) * 256 + F.get(o, 1), F.get(o, 2) * 256 + F.get(o, 3), F.lit(65536), F.lit(65536))
    parts = lambda s: F.array(*[F.floor(s[h] / 256).cast("long") if k == 0 else s[h] % 256 for h in "ab" for k in (0, 1)])
    return _let(done, lambda s: F.array_join(parts(s).cast("array<string>"), "."))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _ssn_ok(m: Column) -> Column:
    return ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = (m.substr(F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    index = area - 1 - F.when(area > 666, 1).otherwise(0)
    done = _numbers(key, "ssn", index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    pad = lambda c, n: F.lpad(c.cast("long").cast("string"), n, "0")
    return _let(done, lambda s: F.concat_ws("-", pad(s["a"] + 1 + F.when(s["a"] >= 665, 1).otherwise(0), 3), pad(F.floor(s["b"] / 9999) + 1, 2), pad(s["b"] % 9999 + 1, 4)))


def _day(m: Column) -> Column:
    """The date that a string names, or null. d.m.y with points, m/d/y with slashes (d/m/y if only that is valid)."""
    iso = F.try_to_date(m, "yyyy-MM-dd")
    return F.when(m.contains("-"), iso).when(m.contains("."), F.try_to_date(m, "dd.MM.yyyy")).otherwise(F.coalesce(F.try_to_date(m, "MM/dd/yyyy"), F.try_to_date(m, "dd/MM/yyyy")))


def _date(key: str, m: Column) -> Column:
    size = DATE_A * DATE_B
    days = F.datediff(_day(m), F.to_date(F.lit(_FIRST_DAY))).cast("long")
    block = F.floor(days / size).cast("long")
    last = block >= 50  # the calendar to the end of 9999 has 50 blocks and a rest
    b = F.when(last, DATE_LAST_B).otherwise(DATE_B)
    rest = days - block * size
    done = _numbers(key, "date", F.floor(rest / b), rest % b, F.when(last, DATE_LAST_A).otherwise(DATE_A), b)
    new = lambda s: F.date_add(F.to_date(F.lit(_FIRST_DAY)), (block * size + s["a"] * b + s["b"]).cast("int"))
    return _let(done, lambda s: F.when(m.contains("-"), F.date_format(new(s), "yyyy-MM-dd")).when(m.contains("."), F.date_format(new(s), "dd.MM.yyyy")).otherwise(
        F.when(F.try_to_date(m, "MM/dd/yyyy").isNotNull(), F.date_format(new(s), "MM/dd/yyyy")).otherwise(F.date_format(new(s), "dd/MM/yyyy"))))


def _email(key: str, m: Column) -> Column:
    end = F.length(m) - F.length(F.substring_index(m, ".", -1))  # all but the last label
    return F.concat(_characters(key, "email", m.substr(F.lit(1), end), [DIGITS, LOWER, UPPER]), F.substring_index(m, ".", -1))


def _phone(key: str, m: Column) -> Column:
    head = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])|^\+?", 0)
    return F.concat(head, _characters(key, "phone", m.substr(F.length(head) + 1, F.length(m)), [DIGITS]))


def _kind(m: Column) -> Column:
    """The kind of a candidate if it is valid, else null."""
    valid = {"iban": _iban_ok, "ip": lambda m: F.forall(_octets(m), lambda o: o < 256), "date": lambda m: _day(m).isNotNull(),
             "ssn": _ssn_ok, "card": lambda m: _luhn(_only_digits(m)) == 0, "secret": lambda m: ~m.rlike("^(?:[0-9]+|[a-fA-F]+)$")}
    found = F.when(m.contains("@"), F.lit("email"))
    for kind in KINDS[1:]:
        hit = m.rlike(f"^(?:{PATTERNS[kind]})$")
        found = found.when(hit, F.when(valid[kind](m), F.lit(kind)) if kind in valid else F.lit(kind))
    return found


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid value of a kind; other strings as they are."""
    makers = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    out = F.when(kind == "secret", F.when(m.rlike("^[0-9a-fA-F]+$"), _characters(key, "secret", m, [DIGITS, HEX_LOWER, HEX_UPPER])).otherwise(
        _characters(key, "secret", m, [DIGITS, LOWER, UPPER])))
    for name, make in makers.items():
        out = out.when(kind == name, make(key, m))
    return out.otherwise(m)


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and a struct ``out_col`` with the number of values of each kind."""
    names = [c for c in docs.columns if c.lower() != out_col.lower()]
    mine = fresh_prefix(docs) + "found"
    text = F.col(text_col)
    some = text.rlike("[0-9@]")
    found = F.when(some, F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), lambda m: F.struct(m.alias("m"), _kind(m).alias("kind"))))
    df = docs.select(*names, found.alias(mine))
    found = F.col(mine)
    between = F.split(text, CANDIDATE, -1)
    pairs = F.zip_with(between, found, lambda rest, f: F.concat(rest, F.coalesce(pseudonym(f["m"], f["kind"], key), F.lit(""))))
    masked = F.when(F.size(F.filter(found, lambda f: f["kind"].isNotNull())) > 0, F.array_join(pairs, "")).otherwise(text)
    number = lambda kind: F.coalesce(F.size(F.filter(found, lambda f: f["kind"] == kind)), F.lit(0))
    counts = F.struct(*[number(kind).alias(kind) for kind in KINDS])
    return df.select(*[masked.alias(c) if c == text_col else F.col(c) for c in names], counts.alias(out_col))
