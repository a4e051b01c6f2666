"""Personal data: format-preserving Feistel pseudonyms, with DataFrame functions alone.

Values that pass their kind's validation are permuted inside their own format by a keyed
Feistel network over mixed radices, so equal values stay equal across documents, different
values stay different, and a new value is again valid (check digits, calendar days, octets,
SSN ranges).  E-mail names of other scripts, or mostly of other letters than ASCII, become ASCII names by a keyed hash.
Rows never leave their partition: no shuffle, whatever the skew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the setting that holds the secret key; the default is public and serves tests alone
KEY_SETTING, DEFAULT_KEY = "spark.tessera.pseudonyms.key", "replace this key"
ROUNDS = 10
_DAY, _DAYS = "1900-01-01", 270  # days are permuted in blocks of 270 * 270
#: days from _DAY to the first and the last day with a year of four digits; the blocks that they cut
#: short hold 7499 * 5 and 1327 * 32 days
_FIRST, _LAST, _FIRST_RADICES, _LAST_RADICES = -693595, 2958463, (7499, 5), (1327, 32)
SSN_RADICES = (898, 99, 9999)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SIXTEEN = r"\d{4}(?:[ -]?\d{4}){3}"
#: kind -> pattern; the first kind that matches at a place takes it
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![\d.-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d./])\d{2}\.\d{2}\.\d{4}(?!\d)|(?<![\d./])\d{2}/\d{2}/\d{4}(?!\d)",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    "card": rf"(?<!\d)(?:{_SIXTEEN}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}|\d{{13,19}}|\d(?:[ -]?\d){{12,18}})(?!\d)",
}
_MARK, _ESCAPED = "\x01", "\x01\x02"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def feistel(values: Column, radices: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of arrays of digits, digit i below radix i.

    Each round adds to one half a stream drawn from the other half, modulo the radices; that
    can be undone from the half that stays, so every round is a permutation.
    """
    return _bound(F.struct(values.alias("v"), radices.alias("m")), lambda x: _rounds(x["v"], x["m"], key, tweak))


def _rounds(values: Column, radices: Column, key: str, tweak: str) -> Column:
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half

    def stirred(part: Column, other: Column, bounds: Column, k: Column) -> Column:
        seed = F.concat_ws(",", F.lit(key), F.lit(tweak), k.cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ","))
        block = lambda s, i: F.sha2(F.concat_ws("/", s, F.floor(i / 8).cast("string")), 256)
        drawn = lambda s, i: F.conv(F.substring(block(s, i), (i % 8) * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
        return _bound(seed, lambda s: F.transform(part, lambda x, i: ((x + drawn(s, i)) % F.get(bounds, i)).cast("int")))

    low, high = F.slice(radices, F.lit(1), half), F.slice(radices, half + 1, rest)

    def step(state: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(
            F.when(even, stirred(state["l"], state["r"], low, k)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(stirred(state["r"], state["l"], high, k)).alias("r"),
        )

    first = F.struct(F.slice(values, F.lit(1), half).alias("l"), F.slice(values, half + 1, rest).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, step, lambda state: F.concat(state["l"], state["r"]))


def _characters(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)))


def _permuted(word: Column, key: str, tweak: str) -> Column:
    """ASCII digits and letters permuted, everything else where it was."""
    chars = _characters(word)
    base = lambda c: F.when(c.between("0", "9"), 48).when(c.between("A", "Z"), 65).when(c.between("a", "z"), 97).otherwise(0)
    radix = lambda c: F.when(c.between("0", "9"), 10).when(c.between("A", "Z") | c.between("a", "z"), 26).otherwise(1)
    live = F.filter(chars, lambda c: base(c) > 0)

    def put(new: Column) -> Column:
        def step(state: Column, c: Column) -> Column:
            fresh = base(c) > 0
            return F.struct(
                F.concat(state["out"], F.when(fresh, F.char(base(c) + F.get(new, state["at"]))).otherwise(c)).alias("out"),
                (state["at"] + F.when(fresh, 1).otherwise(0)).alias("at"),
            )

        return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda state: state["out"])

    new = feistel(F.transform(live, lambda c: F.ascii(c) - base(c)), F.transform(live, radix), key, tweak)
    return F.when(F.length(word) == 0, word).otherwise(_bound(new, put))


def _luhn(digits: Column) -> Column:
    """The check digit that belongs behind the digits."""

    def step(state: Column, c: Column) -> Column:
        twice = c.cast("int") * 2
        return F.struct((state["sum"] + F.when(state["odd"], F.floor(twice / 10).cast("int") + twice % 10).otherwise(c.cast("int"))).cast("int").alias("sum"), (~state["odd"]).alias("odd"))

    return F.aggregate(F.reverse(_characters(digits)), F.struct(F.lit(0).alias("sum"), F.lit(True).alias("odd")), step, lambda s: ((F.lit(10) - s["sum"] % 10) % 10).cast("int"))


def _card(word: Column, key: str) -> Column:
    """The last digit keeps its distance from the right check digit: valid stays valid."""
    front, last = F.substring(word, F.lit(1), F.length(word) - 1), F.substring(word, -1, 1).cast("int")
    off = last - _luhn(F.regexp_replace(front, "[^0-9]", "")) + 10
    return _bound(_permuted(front, key, "card"), lambda new: F.concat(new, ((_luhn(F.regexp_replace(new, "[^0-9]", "")) + off) % 10).cast("string")))


def _mod97(word: Column) -> Column:
    """An IBAN's number modulo 97, the first four characters moved to the end."""
    turned = F.concat(F.substring(word, F.lit(5), F.length(word)), F.substring(word, 1, 4))
    return F.aggregate(_characters(turned), F.lit(0), lambda n, c: F.when(c.between("0", "9"), (n * 10 + c.cast("int")) % 97).otherwise((n * 100 + F.ascii(c) - 55) % 97).cast("int"))


def _iban(word: Column, key: str) -> Column:
    country = F.substring(word, 1, 2)
    written = lambda new: F.concat(country, F.lpad((F.lit(98) - _mod97(F.concat(country, F.lit("00"), new))).cast("string"), 2, "0"), new)
    return _bound(_permuted(F.substring(word, F.lit(5), F.length(word)), key, "iban"), written)


def _ip(word: Column, key: str) -> Column:
    octets = F.transform(F.split(word, r"\."), lambda x: x.cast("int"))
    return F.array_join(F.transform(feistel(octets, F.array_repeat(F.lit(256), 4), key, "ip"), lambda x: x.cast("string")), ".")


def _ssn(word: Column, key: str) -> Column:
    """Area (001-899 without 666), group and serial permuted together over all valid numbers."""
    area, group, serial = (F.substring(word, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    values = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)

    def written(new: Column) -> Column:
        first, *rest = (F.get(new, F.lit(i)) for i in range(3))
        return F.format_string("%03d-%02d-%04d", first + F.when(first >= 665, 2).otherwise(1), *(x + 1 for x in rest))

    return _bound(feistel(values, F.array(*map(F.lit, SSN_RADICES)), key, "ssn"), written)


def _email_name(name: Column, key: str) -> Column:
    """Mostly ASCII names keep their form, accented Latin letters in place; any other name becomes an ASCII one."""
    size = lambda but: F.length(F.regexp_replace(name, but, ""))
    formed = (size(r"[^A-Za-z0-9]") > size(r"[^\p{L}\p{N}]|[A-Za-z0-9]")) & (size(r"[^\p{L}\p{N}]|[\p{IsLatin}0-9]") == 0)
    return F.when(formed, _permuted(name, key, "email")).otherwise(F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws(",", F.lit(key), F.lit("email-name"), name), 256), 1, 32)))


def _day(word: Column) -> Column:
    return F.when(word.rlike("^[0-9]{4}-"), F.try_to_date(word, "yyyy-MM-dd")).when(F.contains(word, F.lit(".")), F.try_to_date(word, "dd.MM.yyyy")).otherwise(F.try_to_date(word, "MM/dd/yyyy"))


def _date(word: Column, key: str) -> Column:
    """Days are permuted within blocks of about two hundred years, so years stay of four digits."""
    size = _DAYS * _DAYS
    as_written = lambda d: F.when(word.rlike("^[0-9]{4}-"), F.date_format(d, "yyyy-MM-dd")).when(F.contains(word, F.lit(".")), F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy"))

    def moved(n: Column) -> Column:
        first = F.greatest(F.floor(n / size).cast("int") * size, F.lit(_FIRST))
        radices = [F.when(n < _FIRST - _FIRST % size + size, F.lit(low)).when(n >= _LAST - _LAST % size, F.lit(high)).otherwise(F.lit(_DAYS)) for low, high in zip(_FIRST_RADICES, _LAST_RADICES, strict=True)]
        new = feistel(F.array(((n - first) / radices[1]).cast("int"), ((n - first) % radices[1]).cast("int")), F.array(*radices), key, "date")
        return _bound(new, lambda d: F.date_add(F.lit(_DAY).cast("date"), (first + F.get(d, F.lit(0)) * radices[1] + F.get(d, F.lit(1))).cast("int")))

    return _bound(_bound(F.datediff(_day(word), F.lit(_DAY).cast("date")), moved), as_written)


def _valid(kind: str, word: Column) -> Column:
    if kind == "iban":
        return _mod97(word) == 1
    if kind == "email":
        return ~word.rlike(r"^\.|\.\.|\.@|@-|-\.|\.-") & word.rlike(r"\.[A-Za-z][A-Za-z0-9-]*[A-Za-z0-9]$")
    if kind == "card":
        digits = F.regexp_replace(word, "[^0-9]", "")
        return word.rlike(f"^{_SIXTEEN}$") | (_luhn(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.substring(digits, -1, 1).cast("int"))
    if kind == "date":
        return _day(word).isNotNull() & ~word.startswith("0000")
    if kind == "ssn":
        return ~word.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "phone":
        return F.length(F.regexp_replace(word, "[^0-9]", "")).between(7, 15)
    return F.lit(True)


def _renamed(kind: str, word: Column, key: str) -> Column:
    if kind == "email":
        return F.concat(_email_name(F.substring_index(word, "@", 1), key), F.lit("@"), F.substring_index(word, "@", -1))
    if kind == "phone":
        country = F.regexp_extract(word, r"^\+\d{1,3}(?=[ .(-])", 0)
        return F.concat(country, _permuted(F.substring(word, F.length(country) + 1, F.length(word)), key, "phone"))
    return {"iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "card": _card}[kind](word, key)


def _pieces(text: Column, which: list[str]) -> Column:
    """The text cut at values: array of (kind, word), kind null for the text between."""
    safe = F.replace(text, F.lit(_MARK), F.lit(_ESCAPED))
    union = "|".join(f"(?<{kind}>{PATTERNS[kind]})" for kind in which)
    marked = F.regexp_replace(safe, union, f"{_MARK}$0{_MARK}")
    return F.split(marked, f"{_MARK}(?!\x02)")


def _kind(word: Column, which: list[str]) -> Column:
    """The kind that took the word: the first whose whole pattern fits and that is valid."""
    looks = F.when(F.lit(False), F.lit(""))
    for kind in which:
        looks = looks.when(word.rlike(f"^(?:{PATTERNS[kind]})$") & _valid(kind, word), F.lit(kind))
    return looks


def pseudonymise(docs: DataFrame, key: str | None = None, kinds: tuple[str, ...] = tuple(PATTERNS), text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; all other columns and rows as they were.

    Sixteen digits in a card's layout count as a card whatever their check digit, which keeps its
    distance from the right one; other lengths and layouts must pass the Luhn check.
    Without ``key`` the session's setting ``spark.tessera.pseudonyms.key`` counts.
    ``found_col`` adds the kinds found, in order, as array<string>.  Null texts stay null,
    empty ones empty; values that fail their validation stay.  Equal values get equal
    pseudonyms in every row and every run with the same key; a column of that name in
    ``docs`` is replaced.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY)
    which = [k for k in PATTERNS if k in kinds]
    text = F.col(f"`{text_col}`")
    parts_col, kinds_col = (f"_{name}_{uuid.uuid4().hex}" for name in ("parts", "kinds"))
    parts = F.when(text.rlike("[0-9@]"), _pieces(text, which)).otherwise(F.array(text))
    with_parts = docs.withColumn(parts_col, parts)
    named = with_parts.withColumn(kinds_col, F.transform(parts_col, lambda p, i: F.when(i % 2 == 1, _kind(p, which))))

    def replaced(p: Column, i: Column) -> Column:
        kind = F.get(kinds_col, i)
        out = F.when(kind.isNull(), p)
        for k in which:
            out = out.when(kind == k, _renamed(k, p, key))
        return out

    new = F.replace(F.array_join(F.transform(parts_col, replaced), ""), F.lit(_ESCAPED), F.lit(_MARK))
    out = named.withColumn(text_col, F.when(F.size(parts_col) > 1, new).otherwise(text))
    if found_col:
        out = out.withColumn(found_col, F.coalesce(F.filter(kinds_col, lambda k: k.isNotNull()), F.array().cast("array<string>")))
    return out.drop(parts_col, kinds_col)


def pseudonym_report(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the new text and the number of replaced values of each kind."""
    found = pseudonymise(docs.select(id_col, text_col), key, text_col=text_col, found_col="_found")
    count = lambda kind: F.size(F.filter("_found", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(id_col, text_col, *map(count, PATTERNS))
