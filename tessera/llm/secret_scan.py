"""Secret scans with DataFrame functions alone.

Three base patterns give spans; beside them, candidate strings are scanned with a sliding
window whose Shannon entropy is kept up by incremental counts, for each character class, and
an allow list suppresses what is known to be harmless.  No row leaves its partition: the
operator has no shuffle, whatever the skew.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
_NAME = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
_RUN = "[A-Za-z0-9+/_=-]"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH, RUN_LENGTH = 6, 20, 24, 20
WINDOW = 20
#: class -> (its characters as a pattern, its alphabet, least entropy in bits of a window)
CLASSES = {
    "hex": ("[0-9a-f]", "0123456789abcdef", 2.95),
    "base64": (_RUN, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.75),
}
#: a candidate that one of these matches is no secret: without digits, digits alone, a UUID, a placeholder
ALLOWED = (r"^[^0-9]*$", r"^[0-9_=/+-]*$", r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", r"(?i)(example|sample|dummy|placeholder|changeme)")

_SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"


def _chunks(text: Column, pattern: str) -> Column:
    """The text cut after each match, leftmost first: every chunk ends with one."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?(?:{pattern})"), F.lit(0))


def _located(chunks: Column, pattern: str, rank: int, keep=None) -> Column:
    """Spans of the matches that end the chunks."""

    def step(state: Column, chunk: Column) -> Column:
        end = state["at"] + F.length(chunk)
        start = end - F.length(F.regexp_extract(chunk, pattern, 0))
        span = F.array(F.struct(start.cast("bigint").alias("start"), F.lit(rank).alias("rank"), end.cast("bigint").alias("end")))
        return F.struct(end.cast("bigint").alias("at"), F.when(keep(chunk), F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans") if keep else F.concat(state["spans"], span).alias("spans"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(chunks, zero, step, lambda state: state["spans"])


#: counts of characters, ``_PACKED`` of them in a 64-bit integer, ``_BITS`` bits each
_PACKED, _BITS = 12, 5
#: k log2 k in units of 2**-40, as integers: sums of what comes and goes never drift
_UNIT = 1 << 40
_XLOGX = [0] + [round(k * math.log2(k) * _UNIT) for k in range(1, WINDOW + 2)]


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entropy_span(word: Column, alphabet: str, least: float) -> Column:
    """(first, last): ends of the first and the last window of high entropy; zeros if none.

    The state holds the count of each character in the window, packed into a few integers, and
    the sum of c log2 c; a character that enters or leaves changes one count and one term of
    the sum, so a run costs the same for each of its characters however long it is.
    """
    slots = -(-len(alphabet) // _PACKED)
    gain = F.array(*(F.lit(b - a) for a, b in zip(_XLOGX, _XLOGX[1:])))
    shifted = lambda name, value, by: F.call_function(name, value, by)

    def moves(codes: Column) -> Column:
        """What each step adds and takes away: the slot, the place in it, and that place's one."""

        def one(code: Column, prefix: str) -> list[Column]:
            by = code % _PACKED * _BITS
            return [F.floor(code / _PACKED).cast("int").alias(f"{prefix}slot"), by.alias(f"{prefix}by"), F.when(code >= 0, shifted("shiftleft", F.lit(1).cast("bigint"), by)).otherwise(F.lit(0).cast("bigint")).alias(f"{prefix}one")]

        both = F.transform(codes, lambda c, i: F.struct(c.alias("new"), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1)).alias("old")))
        return F.transform(both, lambda m: F.struct(*one(m["new"], "n"), *one(m["old"], "o"), (m["new"] == m["old"]).cast("int").alias("same")))

    def high(state: Column) -> Column:
        """Whether the window that ends at the state's place is a full one of high entropy."""
        return (state["i"] >= WINDOW) & (F.lit(math.log2(WINDOW)) - state["s"] / F.lit(float(WINDOW * _UNIT)) >= least - 1e-9)

    def seen(state: Column) -> list[Column]:
        return [F.when(high(state) & (state["first"] == 0), state["i"]).otherwise(state["first"]).alias("first"), F.when(high(state), state["i"]).otherwise(state["last"]).alias("last")]

    def step(state: Column, m: Column) -> Column:
        count = lambda prefix: shifted("shiftright", F.get(state["n"], m[f"{prefix}slot"]), m[f"{prefix}by"]).bitwiseAND(F.lit((1 << _BITS) - 1).cast("bigint")).cast("int")
        lost = F.when(m["oone"] > 0, F.get(gain, count("o") + m["same"] - 1)).otherwise(F.lit(0).cast("bigint"))
        slot = lambda q: F.get(state["n"], F.lit(q)) + F.when(m["nslot"] == q, m["none"]).otherwise(F.lit(0).cast("bigint")) - F.when(m["oslot"] == q, m["oone"]).otherwise(F.lit(0).cast("bigint"))
        return F.struct(F.array(*map(slot, range(slots))).alias("n"), (state["s"] + F.get(gain, count("n")) - lost).alias("s"), (state["i"] + 1).alias("i"), *seen(state))

    zero = F.struct(F.array_repeat(F.lit(0).cast("bigint"), slots).alias("n"), F.lit(0).cast("bigint").alias("s"), F.lit(0).alias("i"), F.lit(0).alias("first"), F.lit(0).alias("last"))
    codes = F.transform(F.split(word, ""), lambda c: (F.position(c, F.lit(alphabet)) - 1).cast("int"))
    return F.aggregate(_bound(codes, moves), zero, step, lambda state: F.struct(*seen(state)))


def _within(runs: Column, spans_of) -> Column:
    """Spans inside each run, moved to the run's place in the text."""

    def moved(run: Column) -> Column:
        return F.transform(spans_of(run["word"]), lambda s: F.struct((s["start"] + run["start"]).alias("start"), s["rank"].alias("rank"), (s["end"] + run["start"]).alias("end")))

    return F.flatten(F.transform(runs, moved))


def _by_entropy(word: Column) -> Column:
    def of_class(pattern: str, alphabet: str, least: float) -> Column:
        def narrowed(s: Column) -> Column:
            hit = _entropy_span(F.substring(word, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), alphabet, least)
            span = lambda h: F.struct((s["start"] + h["first"] - WINDOW).cast("bigint").alias("start"), F.lit(3).alias("rank"), (s["start"] + h["last"]).cast("bigint").alias("end"))
            return F.transform(F.filter(F.array(hit), lambda h: h["last"] > 0), span)

        whole = f"{pattern}{{{WINDOW},}}"
        return F.flatten(F.transform(_located(_chunks(word, whole), whole, 3), narrowed))

    found = [of_class(*c) for c in CLASSES.values()]
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | word.rlike(pattern)
    return F.when(allowed, F.array().cast(_SPANS)).otherwise(F.array_distinct(F.concat(*found)))


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``base`` and ``extra`` spans (start, rank in KINDS, end; code
    points, end exclusive).

    A null text is empty; empty texts have no spans.  An entropy span that touches a base
    span is not repeated.  Repeated rows give repeated results; other columns are ignored.
    """
    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    value = f"{_NAME}([A-Za-z0-9+/_.=-]+)"
    run = f"(?<!{_RUN}){_RUN}{{{RUN_LENGTH},}}"
    cut = base.select(id_col, _chunks(F.col("_t"), value).alias("_a"), _chunks(F.col("_t"), run).alias("_r"))
    tail = f"{_RUN}{{{RUN_LENGTH},}}$"

    def step(state: Column, chunk: Column) -> Column:
        word = F.regexp_extract(chunk, tail, 0)
        end = state["at"] + F.length(chunk)
        item = F.array(F.struct((end - F.length(word)).cast("bigint").alias("start"), word.alias("word")))
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["runs"], item).alias("runs"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,word:string>>").alias("runs"))
    runs = cut.select(
        id_col,
        _located(F.col("_a"), value, 0, lambda chunk: F.length(F.regexp_extract(chunk, value, 1)) >= ASSIGN_VALUE).alias("_assign"),
        F.aggregate("_r", zero, step, lambda state: state["runs"]).alias("_runs"),
    )
    access, hexa = f"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}", f"[0-9a-f]{{{HEX_LENGTH},}}"
    spans = runs.select(
        id_col,
        F.concat(
            "_assign",
            _within(F.col("_runs"), lambda w: _located(_chunks(w, access), access, 1)),
            _within(F.col("_runs"), lambda w: _located(_chunks(w, hexa), hexa, 2)),
        ).alias("base"),
        _within(F.col("_runs"), _by_entropy).alias("_more"),
    )
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return spans.select(id_col, "base", F.filter("_more", apart).alias("extra"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest of ``find_secrets`` that the query returns."""
    found = find_secrets(docs, id_col, text_col)
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("bigint")
    return found.select(
        id_col,
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS[:3])),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "extra")).alias("spans"),
    )


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
pat AS (SELECT '[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]' AS kw),
rx AS (SELECT '(' || kw || ')["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS a, '[A-Za-z0-9+/_=-]{20,}' AS r FROM pat),
ac AS (SELECT rid, a, unnest(c) AS chunk, unnest(range(1, len(c) + 1)) AS k FROM (SELECT rid, a, regexp_extract_all(text, '(?s).*?(?:' || a || ')', 0) AS c FROM t, rx)),
av AS (SELECT rid, k, sum(length(chunk)) OVER (PARTITION BY rid ORDER BY k) AS e, length(regexp_extract(chunk, a, 0)) AS n, length(regexp_extract(chunk, a, 2)) AS v FROM ac),
assign AS (SELECT rid, CAST(e - n AS BIGINT) AS s, 0 AS rank, CAST(e AS BIGINT) AS e FROM av WHERE v >= 6),
rc AS (SELECT rid, r, unnest(c) AS chunk, unnest(range(1, len(c) + 1)) AS k FROM (SELECT rid, r, regexp_extract_all(text, '(?s).*?' || r, 0) AS c FROM t, rx)),
runs AS (SELECT rid, word, CAST(e - length(word) AS BIGINT) AS s0, row_number() OVER () AS run FROM (SELECT rid, k, sum(length(chunk)) OVER (PARTITION BY rid ORDER BY k) AS e, regexp_extract(chunk, r, 0) AS word FROM rc)),
kinds AS (SELECT * FROM (VALUES (1, 'AKIA[A-Z0-9]{16,}'), (2, '[0-9a-f]{24,}'), (3, '[0-9a-f]{20,}'), (4, '[A-Za-z0-9+/_=-]{20,}')) v(kind, p)),
ic AS (SELECT rid, run, s0, kind, p, unnest(c) AS chunk, unnest(range(1, len(c) + 1)) AS k FROM (SELECT rid, run, s0, kind, p, regexp_extract_all(word, '(?s).*?' || p, 0) AS c FROM runs, kinds)),
iv AS (SELECT rid, run, kind, s0 + CAST(sum(length(chunk)) OVER (PARTITION BY run, kind ORDER BY k) AS BIGINT) AS e, regexp_extract(chunk, p, 0) AS word FROM ic),
base AS (SELECT * FROM assign UNION ALL SELECT rid, e - length(word), kind, e FROM iv WHERE kind < 3),
ent AS (SELECT rid, e, word, list_filter(range(1, length(word) - 18), lambda i: list_aggregate(string_split(substr(word, i, 20), ''), 'entropy') >= CASE kind WHEN 3 THEN 2.95 ELSE 3.75 END - 1e-9) AS w
        FROM iv JOIN runs USING (rid, run, word) WHERE false
        UNION ALL
        SELECT iv.rid, iv.e, iv.word, list_filter(range(1, length(iv.word) - 18), lambda i: list_aggregate(string_split(substr(iv.word, i, 20), ''), 'entropy') >= CASE iv.kind WHEN 3 THEN 2.95 ELSE 3.75 END - 1e-9)
        FROM iv JOIN runs ON runs.run = iv.run
        WHERE iv.kind >= 3 AND regexp_matches(runs.word, '[0-9]') AND regexp_matches(runs.word, '[^0-9_=/+-]')
          AND NOT regexp_matches(runs.word, '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$') AND NOT regexp_matches(lower(runs.word), 'example|sample|dummy|placeholder|changeme')),
extra AS (SELECT DISTINCT rid, e - length(word) + list_min(w) - 1 AS s, 3 AS rank, e - length(word) + list_max(w) + 19 AS e FROM ent WHERE len(w) > 0),
allspans AS (SELECT *, true AS b FROM base UNION ALL SELECT *, false FROM extra x WHERE NOT EXISTS (SELECT 1 FROM base y WHERE y.rid = x.rid AND y.s < x.e AND x.s < y.e)),
g AS (SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
      string_agg(['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (b) AS bs,
      string_agg(['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS sp FROM allspans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(bs, '')) AS base_sha256, coalesce(sp, '') AS spans
FROM t LEFT JOIN g USING (rid)
"""
