"""Source divergence audit: how far the sources of each language stand from each other and from the language.

Terms are counted per (lang, source, term) inside the tasks first; one shuffle by (lang, term)
gives the counts of the groups and of the language.  The shared terms of a group that stand out
most are found by dominance: with fixed totals a term's excess never falls with its group
count, never rises with its language count, and ties go to the earlier term.  So a term that k
others dominate in (higher group count, lower language count, earlier UTF-8) can't be among the k
best.  Each partition keeps its k-skyband, the skybands of a group are merged, and only what is
left is ranked exactly.  Distances between sources are sums over chunks of terms, for blocks of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, small_batches, staged, text_buffer, word_array

LEAST_DOCUMENTS = 30
PRIOR = 5
SCALE = 1_000_000_000
BEST = 50
CHUNK_TERMS = 1_024
BLOCK_SOURCES = 256
_HELD_ROWS = 400_000
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = _IS_LETTER[128:] = True
_KEYS = ["lang", "source", "term"]


def _groups(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """The group of each row, and the lang and source of each group."""
    lang, source = (batch.column(name).dictionary_encode() for name in ("lang", "source"))
    codes = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
    known, group = np.unique(codes, return_inverse=True)
    width = max(len(source.dictionary), 1)
    return group, lang.dictionary.take(pa.array(known // width)), source.dictionary.take(pa.array(known % width))


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """lang, source, term, n occurrences, df documents of the batch that hold the term."""
    data, offsets = text_buffer(batch.column("text"))
    words, owner = word_array(LOWER[data], offsets, _IS_LETTER)
    words = words.dictionary_encode()
    width = max(len(words.dictionary), 1)
    held, times = np.unique(owner * width + words.indices.to_numpy(), return_counts=True)
    group, langs, sources = _groups(batch)
    seen, place = np.unique(group[held // width] * width + held % width, return_inverse=True)
    n = np.zeros(len(seen), np.int64)
    np.add.at(n, place, times)
    at = pa.array(seen // width)
    terms = words.dictionary.view(pa.string()).take(pa.array(seen % width))
    return pa.table([langs.take(at), sources.take(at), terms, pa.array(n), pa.array(np.bincount(place, minlength=len(seen)).astype(np.int64))], [*_KEYS, "n", "df"])


def _combined(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(_KEYS).aggregate([("n", "sum"), ("df", "sum")])
    return sums.select([*_KEYS, "n_sum", "df_sum"]).rename_columns([*_KEYS, "n", "df"])


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the batches, combined as long as they fit into the bound."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_counted(batch))
            rows += held[-1].num_rows
        if rows > _HELD_ROWS:
            held = [_combined(held)]
            rows = held[0].num_rows
            if rows > _HELD_ROWS // 2:
                yield from held[0].to_batches(20_000)
                held, rows = [], 0
    if held:
        yield from _combined(held).to_batches(20_000)


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n: count in the group, total: count in the lang, lead: true on one row of each
    (lang, term)) of the terms that ``least_documents`` rows of the lang or more hold; ``docs``
    has lang, source and text without nulls."""
    small_batches(docs.sparkSession)
    counts = docs.select("lang", "source", "text").mapInArrow(_task_counts, "lang string, source string, term string, n bigint, df bigint")
    # by (lang, term) alone: the sums of the groups and of the lang need no other shuffle
    sums = counts.repartition("lang", "term").groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    whole = Window.partitionBy("lang", "term")
    marked = sums.select(*_KEYS, "n", F.sum("n").over(whole).alias("total"), F.sum("df").over(whole).alias("held"), (F.min("source").over(whole) == F.col("source")).alias("lead"))
    return marked.where(F.col("held") >= least_documents).drop("held")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every occurring (lang, source): v terms kept in the lang, n_group and n_lang, their
    occurrences, and i, the place of the source in the lang."""
    langs = kept.groupBy("lang").agg(F.sum(F.col("lead").cast("bigint")).alias("v"), F.sum("n").alias("n_lang"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    every = docs.select("lang", "source").distinct()
    zero = F.lit(0).cast("bigint")
    joined = every.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint")
    return joined.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "n_group", "n_lang")], place.alias("i"))


def _share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * v)), exact; null where no term is kept."""
    top = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = F.nullif(total + PRIOR * v, F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return 1 + F.call_function("div", top, under)


def skyband(n: np.ndarray, total: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the points that fewer than ``k`` others dominate: n as high, total as low, rank as early.

    Points are taken by falling n, so who dominates one stands before it; it is enough to count
    those that stay, since a point with k dominators has k among them."""
    order = np.lexsort((rank, total, -n))
    stay = np.zeros(0, np.int64)
    for lo in range(0, len(order), 512):
        part = order[lo : lo + 512]
        t, r = total[part], rank[part]
        count = ((total[stay][:, None] <= t) & (rank[stay][:, None] <= r)).sum(axis=0)
        count += np.triu((t[:, None] <= t) & (r[:, None] <= r), 1).sum(axis=0)
        stay = np.concatenate([stay, part[count < k]])
    return stay


def _skybands(k: int):
    """Rows (lang, source, term, n, total) of each group's skyband within the partition."""

    def reduce(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        rows = rows[0] if rows else held[0]
        group, langs, _ = _groups(rows)
        n, total = rows.column("n").to_numpy(), rows.column("total").to_numpy()
        rank = np.empty(rows.num_rows, np.int64)
        rank[pc.sort_indices(rows.column("term").cast(pa.binary())).to_numpy()] = np.arange(rows.num_rows)
        order = np.argsort(group, kind="stable")
        stay = [own[skyband(n[own], total[own], rank[own], k)] for own in np.split(order, np.searchsorted(group[order], np.arange(1, len(langs))))]
        return rows.take(pa.array(np.concatenate(stay)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, least = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            # at least as many new rows as those that stayed, so the work stays in proportion
            if rows > max(200_000, 2 * least):
                held = [reduce(held)]
                rows = least = held[0].num_rows
        if held:
            yield reduce(held)

    return run


def standing_out(kept: DataFrame, totals: DataFrame, k: int = BEST) -> DataFrame:
    """(lang, source, item, value, rank): the ``k`` terms of each group whose share exceeds the
    lang's most, by exact rank of what dominance leaves."""
    kind = "lang string, source string, term string, n bigint, total bigint"
    rows = kept.select(*_KEYS, "n", "total")
    local = rows.mapInArrow(_skybands(k), kind)
    merged = local.repartition("lang", "source").mapInArrow(_skybands(k), kind)
    t = F.col
    value = _share(t("n"), t("n_group"), t("v")) - _share(t("total"), t("n_lang"), t("v"))
    valued = merged.join(totals, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _distances(table: pa.Table) -> pa.Table:
    """Sums of |p - p'| over the terms of one chunk for the pairs of sources of one or two blocks."""
    first = table.slice(0, 1).to_pylist()[0]
    i, p = table.column("i").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    width = len(term.dictionary)
    base = np.array(pc.is_null(term.indices))
    sources = np.sort(i[base])
    shares = np.zeros((len(sources), width), np.int64)
    shares[np.searchsorted(sources, i[base])] = p[base][:, None]
    real = np.flatnonzero(~base)
    shares[np.searchsorted(sources, i[real]), term.indices.take(pa.array(real)).to_numpy()] = p[real]
    block = sources // BLOCK_SOURCES
    out = []
    for a in np.flatnonzero(block == first["low"]).tolist():
        b = np.flatnonzero((block == first["high"]) & (sources > sources[a]))
        out.append((np.full(len(b), sources[a]), sources[b], np.abs(shares[b] - shares[a]).sum(axis=1)))
    columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table([pa.array([first["lang"]] * len(columns[0]), pa.string()), *[pa.array(c.astype(np.int64)) for c in columns]], ["lang", "i", "j", "value"])


def between_sources(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) of each other source of the lang, by falling distance.

    The result has a row for every two sources of a lang, as asked.  A task holds one chunk of
    about ``CHUNK_TERMS`` terms for two blocks of ``BLOCK_SOURCES`` sources at most, whatever
    the sizes; a source without a term in the chunk has its share at count zero."""
    chunks = F.greatest(F.ceil(F.col("v") / CHUNK_TERMS), F.lit(1).cast("bigint"))
    known = totals.select("lang", "source", "i", "v", "n_group", chunks.alias("chunks"))
    shares = kept.select(*_KEYS, "n").join(known, ["lang", "source"])
    shares = shares.select("lang", "i", F.expr("pmod(xxhash64(term), chunks)").alias("chunk"), "term", _share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"))
    none = known.select("lang", "i", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), F.lit(None).cast("string").alias("term"), F.coalesce(_share(F.lit(0).cast("bigint"), F.col("n_group"), F.col("v")), F.lit(0).cast("bigint")).alias("p"))
    blocks = totals.groupBy("lang").agg(F.expr(f"max(i) div {BLOCK_SOURCES}").alias("last"))
    own = F.expr(f"i div {BLOCK_SOURCES}")
    dealt = shares.unionByName(none).join(blocks, "lang").withColumn("other", F.explode(F.expr("sequence(0L, last)")))
    dealt = dealt.select("lang", "chunk", F.least(own, "other").alias("low"), F.greatest(own, "other").alias("high"), "i", "term", "p")
    parts = dealt.groupBy("lang", "chunk", "low", "high").applyInArrow(_distances, "lang string, i bigint, j bigint, value bigint")
    sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    names = totals.select("lang", "i", "source")
    named = both.join(names, ["lang", "i"]).join(names.select("lang", F.col("i").alias("j"), F.col("source").alias("item")), ["lang", "j"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def divergence_report(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_documents: int = LEAST_DOCUMENTS, k: int = BEST) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks all other sources of the lang
    by distance, part ``term`` the ``k`` terms that stand out most in the group.

    Null lang, source and text count as empty strings.  Every row is a document, repeated rows
    and ids too.  Equal values go by the UTF-8 order of the item.  A lang with one source gives no
    pairs; without kept terms pairs have value 0 and there are no terms.  An empty table gives
    no rows, other columns are ignored.
    """
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept, _ = staged(kept_terms(texts, least_documents), "kept-terms")
    totals, _ = staged(group_totals(texts, kept), "group-totals")
    parts = [between_sources(kept, totals).withColumn("part", F.lit("pair")), standing_out(kept, totals, k).withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS cl FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.cl, coalesce(x.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) x USING (lang, source, term)),
l AS (SELECT lang, count(*) AS v, sum(cl) AS nl FROM k GROUP BY lang),
t AS (SELECT lang, source, sum(n) AS ng FROM c GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + (1000000000::HUGEINT * (c.n + 5)) // (t.ng + 5 * l.v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (c.cl + 5)) // (l.nl + 5 * l.v)::HUGEINT AS q
      FROM c JOIN l USING (lang) JOIN t USING (lang, source)),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(dist.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source),
terms AS (SELECT lang, source, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms) WHERE rank <= 50
"""
