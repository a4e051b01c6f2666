"""Column functions of the extraction rules, all from built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space as Unicode counts it, spelled out, since regex dialects differ on \s
_NO_BLANK = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: the same characters one by one
SPACES = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_TICK = rf"""(?i)<i(?:{SPACE}[^>]*)?{SPACE}class{SPACE}*={SPACE}*(?:"(?:[^"]*{SPACE})?icon-tick(?:{SPACE}[^"]*)?"|'(?:[^']*{SPACE})?icon-tick(?:{SPACE}[^']*)?')[^>]*>{SPACE}*</i>"""
_READABLE = "^[a-z0-9]+(-[a-z0-9]+)*$"
#: fixed values: prefixes of the last-modified line of support articles
_DATE_PREFIX = rf"(?i)^(?:最后更新(?:时间|日期)|更新时间|last{SPACE}+updated|updated){SPACE}*[：:]?{SPACE}*"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def collapse_space(text: Column) -> Column:
    """White-space runs to one blank, none at the ends."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def tick_icons(html: Column) -> Column:
    """Empty tick icons outside comments become a tick sign."""
    parts = F.split(html, "(?<=-->)|(?=<!--)")
    return F.array_join(F.transform(parts, lambda p: F.when(p.startswith("<!--"), p).otherwise(F.regexp_replace(p, _TICK, "✓"))), "")


def root_sources(html: Column) -> Column:
    """``src="/x"`` gets the base-url placeholder, unless it has it or names a host."""
    return F.regexp_replace(html, rf"""(?i)(\bsrc{SPACE}*={SPACE}*["'])(/(?!/|\{{base_url\}})[^"']*)""", "$1{base_url}$2")


def root_images(html: Column) -> Column:
    return F.regexp_replace(html, r"(?<!\{base_url\})/Images/", "{base_url}/Images/")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse_runs(html: Column) -> Column:
    """White-space runs to one blank; single blanks, most of them, are no match.  Most characters are told by one range to be none."""
    return F.regexp_replace(html, f"(?![!-~])(?:[{_NO_BLANK}]{SPACE}*| {SPACE}+)", " ")


def _finish(html: Column) -> Column:
    """The rules behind the first, where blanks stand alone and are the only white space.  A rule
    that scans slowly is asked for only where its literal part occurs."""
    filled = let(html, lambda h: F.when(F.contains(h, F.lit("<div>")), F.regexp_replace(h, "<div> *</div>", "")).otherwise(h))
    bare = let(filled, lambda h: F.when(F.contains(h, F.lit("> ")), F.regexp_replace(h, "> +<", "><")).otherwise(h))
    # no tick makes a source
    rooted = lambda h, low: F.when(F.contains(low, F.lit("src")), root_sources(h)).otherwise(h)
    ticked = lambda h, low: F.when(F.contains(low, F.lit("icon-tick")), tick_icons(h)).otherwise(h)
    sourced = let(bare, lambda h: let(F.lower(h), lambda low: let(ticked(h, low), lambda t: rooted(t, low))))
    return F.trim(let(sourced, lambda h: F.when(F.contains(h, F.lit("/Images/")), root_images(h)).otherwise(h)))


def normalize_html(html: Column) -> Column:
    """One pass of each rule in order; null stays null.  Nested empty divs lose one level a pass."""
    return _finish(collapse_runs(html))


def normalize_joined(html: Column) -> Column:
    """``normalize_html`` of a text joined from parts of ``collapse_runs`` or of ``normalize_html``: runs of white space can only
    be blanks, where parts meet."""
    return _finish(let(html, lambda h: F.when(F.contains(h, F.lit("  ")), F.regexp_replace(h, " {2,}", " ")).otherwise(h)))


def fragment_id(href: Column) -> Column:
    """The href without one leading ``#``."""
    return F.regexp_replace(href, "^#", "")


def slug(url: Column) -> Column:
    """Path segments after ``/details/``, without one ``/index.html`` at the end, joined by ``_``."""
    path = F.regexp_replace(F.regexp_extract(url, r"^(?:[a-z]+://[^/?#]*)?([^?#]*)", 1), r"/index\.html$", "")
    tail = F.when(F.contains(path, F.lit("/details/")), F.substring_index(path, "/details/", -1)).otherwise(F.lit(""))
    return F.array_join(F.filter(F.split(tail, "/"), lambda s: s != ""), "_")


def display_name(label: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(strip(F.regexp_replace(label, "[:：]+$", "")), F.lit("")), F.lit(fallback))


def article_title(title: Column) -> Column:
    return F.regexp_replace(title, rf"{SPACE}*\|{SPACE}*Azure{SPACE}*$", "")


def modified_date(line: Column) -> Column:
    return strip(F.regexp_replace(line, _DATE_PREFIX, ""))


def is_readable_id(text: Column) -> Column:
    return F.coalesce(text.rlike(_READABLE), F.lit(False))


def is_safe_path(path: Column) -> Column:
    """Relative, without a parent step, a backslash or an empty name."""
    return F.coalesce((path != "") & ~path.rlike(r"^/|(^|/)\.\.(/|$)|\\|//"), F.lit(False))


def is_plain_line(text: Column) -> Column:
    return F.coalesce((strip(text) != "") & ~text.rlike("[\n\r]"), F.lit(False))


def has_phrase(text: Column, phrases: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for phrase in phrases:
        out = out | F.contains(low, F.lit(phrase))
    return F.coalesce(out, F.lit(False))


def is_visible(style: Column) -> Column:
    return ~F.contains(F.lower(F.regexp_replace(F.coalesce(style, F.lit("")), f"{SPACE}+", "")), F.lit("display:none"))


def group_name(labels: Column) -> Column:
    """Labels joined by `` - ``; null if a label is empty or holds the joint itself."""
    bad = F.exists(labels, lambda x: x.isNull() | (x == "") | F.contains(x, F.lit(" - ")))
    return F.when(~bad, F.array_join(labels, " - "))


def criteria_json(pairs: list[tuple[str, Column]]) -> Column:
    """Compact JSON of (key, value) criteria in order; pairs whose value is null are left out."""
    items = F.array(*(F.when(v.isNotNull(), F.struct(F.lit(k).alias("filterKey"), v.alias("matchValues"))) for k, v in pairs))
    return F.to_json(F.array_compact(items))


def options_json(options: Column) -> Column:
    """Compact JSON of options (value, label, href): all active, the first one the default."""
    return F.to_json(F.transform(options, lambda o, i: F.struct(o["value"].alias("value"), o["label"].alias("label"), o["href"].alias("href"), F.lit(True).alias("isActive"), F.when(i == 0, F.lit(True)).alias("isDefault"))))


def first_difference(a: Column, b: Column) -> Column:
    """1-based place of the first differing character; null if the texts are equal.

    Bisection over prefixes: each step compares one substring, so long texts cost length times
    its logarithm, not a character array."""
    n = F.least(F.length(a), F.length(b))

    def step(state: Column, _: Column) -> Column:
        mid = F.ceil((state["lo"] + state["hi"]) / 2).cast("int")
        same = F.substring(a, F.lit(1), mid) == F.substring(b, F.lit(1), mid)
        return F.struct(F.when(same, mid).otherwise(state["lo"]).alias("lo"), F.when(same, state["hi"]).otherwise(mid - 1).alias("hi"))

    common = F.aggregate(F.sequence(F.lit(1), F.lit(32)), F.struct(F.lit(0).alias("lo"), n.cast("int").alias("hi")), step, lambda s: s["lo"])
    return F.when(a != b, (common + 1).cast("bigint"))


def readable_value(text: Column, most: int = 240, end: int = 120) -> Column:
    """Long values as their length with the first and the last characters."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.lit("len="), F.length(text).cast("string"), F.lit(" "), F.left(text, F.lit(end)), F.lit(" ... "), F.right(text, F.lit(end))))


def ordered_subset(values: Column, allowed: list[str]) -> Column:
    """Distinct values that are allowed, in the allowed order."""
    return F.filter(F.array(*map(F.lit, allowed)), lambda x: F.array_contains(values, x))


def reason_sentence(*reasons: tuple[Column, str]) -> Column:
    """The given texts whose conditions hold, joined for reading."""
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(t)) for c, t in reasons))), "；")
