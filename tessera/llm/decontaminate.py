"""Benchmark decontamination: token windows of documents against a hash set of benchmark windows.

The windows of the benchmark are gathered in slices of at most ``slice_windows`` and
broadcast; a benchmark beyond one slice is scanned slice by slice and the hits of each row
are united, so what is broadcast has a fixed bound whatever the benchmark's size, and the
result does not depend on where it is cut.  A rolling hash finds candidates, and every
candidate is verified on the words themselves.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, blocks, mix, prefix_sums, small_batches, staged, text_buffer, word_bounds

WINDOW = 10
SLICE_WINDOWS = 400_000
_BLOCK = 1 << 19
_BITS = 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BYTES, _WORDS = Powers(0x9E3779B97F4A7C15), Powers(0xD6E8FEB86659FD93)


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased bytes; no word crosses an offset."""
    return word_bounds(_IS_WORD[data], offsets)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total, down = prefix_sums(data.astype(np.uint64) + np.uint64(1), _BYTES)
    return mix((total[ends] - total[starts]) * down[starts])


class _Windows:
    """One slice of the benchmark: window -> item ids, and for each length a bitmap of hashes."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.items = dict(windows)
        self.maps: dict[int, np.ndarray] = {}
        for key in self.items:
            data = np.frombuffer(key, np.uint8)
            starts, ends = _split(data, np.array([0, len(data)]))
            n = len(starts)
            total, down = prefix_sums(_word_hashes(data, starts, ends), _WORDS)
            bitmap = self.maps.setdefault(n, np.zeros(1 << _BITS, bool))
            bitmap[int(mix(np.array([total[n] * down[0]]))[0]) >> (64 - _BITS)] = True

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set[str]]]:
        """(word starts, word ends, document of each word, hit flags, items by document) of a block."""
        starts, ends = _split(data, offsets)
        owner = np.searchsorted(offsets, starts, "right") - 1
        hit, found = np.zeros(len(starts), bool), {}
        if not len(starts):
            return starts, ends, owner, hit, found
        total, down = prefix_sums(_word_hashes(data, starts, ends), _WORDS)
        raw = data.tobytes()
        for n, bitmap in self.maps.items():
            if len(starts) < n:
                continue
            hashes = mix((total[n:] - total[:-n]) * down[: len(starts) - n + 1])
            maybe = np.flatnonzero(bitmap[hashes >> np.uint64(64 - _BITS)])
            for j in maybe[owner[maybe] == owner[maybe + n - 1]].tolist():
                key = b" ".join(raw[a:b] for a, b in zip(starts[j : j + n].tolist(), ends[j : j + n].tolist(), strict=True))
                if (items := self.items.get(key)) is not None:
                    hit[j : j + n] = True
                    found.setdefault(int(owner[j]), set()).update(items)
        return starts, ends, owner, hit, found


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct windows (window string, items array<string>): ``n`` consecutive words of each
    item, or all words of an item that has fewer.  Null and wordless texts give none."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))))
    return (
        benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("w"))
        .where(F.size("w") > 0)
        .select("item", "w", at.alias("at"))
        .select("item", F.array_join(F.slice("w", F.col("at"), n), " ").alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
    )


def _slices(windows: DataFrame, most: int) -> Iterator[_Windows]:
    part: list[tuple[bytes, list[str]]] = []
    for row in windows.toLocalIterator():
        part.append((row["window"].encode(), list(row["items"])))
        if len(part) == most:
            yield _Windows(part)
            part = []
    yield _Windows(part)


_SPAN = pa.list_(pa.struct([(name, pa.int64()) for name in ("at", "start", "end", "words")]))
_SPAN_SQL = "array<struct<at:bigint,start:bigint,end:bigint,words:bigint>>"


def _spans(docs: DataFrame, known) -> DataFrame:
    """Per (row, id, text): number of words, hit spans (``at`` the first word's place, byte
    offsets, number of words), items."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = known.value
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            n_words = np.zeros(batch.num_rows, np.int64)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            items: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for lo, hi in blocks(np.diff(offsets), _BLOCK):
                own = offsets[lo : hi + 1]
                starts, ends, owner, hit, found = windows.scan(_LOWER[data[own[0] : own[-1]]], own - own[0])
                n_words[lo:hi] = np.bincount(owner, minlength=hi - lo)
                first = np.searchsorted(owner, np.arange(hi - lo))
                words = np.flatnonzero(hit)
                cut = np.flatnonzero((np.diff(words) > 1) | (np.diff(owner[words]) > 0)) + 1 if len(words) else []
                for run in np.split(words, cut) if len(words) else []:
                    d = int(owner[run[0]])
                    base = int(own[d] - own[0])
                    spans[lo + d].append({"at": int(run[0] - first[d]), "start": int(starts[run[0]]) - base, "end": int(ends[run[-1]]) - base, "words": len(run)})
                for d, names in found.items():
                    items[lo + d] = sorted(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(n_words), pa.array(spans, _SPAN), pa.array(items, pa.list_(pa.string()))],
                ["row", "id", "n_words", "spans", "items"],
            )

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(scan, f"row bigint, id {kind}, n_words bigint, spans {_SPAN_SQL}, items array<string>")


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans sorted by their first words; those that share words or follow each other become one."""
    for batch in batches:
        k = batch.schema.get_field_index("spans")
        flat = batch.column(k).flatten()
        n = batch.column(k).value_lengths().to_numpy()
        owner = np.repeat(np.arange(batch.num_rows, dtype=np.int64), n)
        at, start, end, words = (flat.field(i).to_numpy() for i in range(4))
        reach = np.maximum.accumulate((owner << 40) + at + words)
        apart = np.ones(len(at), bool)
        apart[1:] = ((owner[1:] << 40) + at[1:] > reach[:-1]) | (owner[1:] > owner[:-1])
        new = np.flatnonzero(apart)
        if len(new):
            at, start, end, words, owner = at[new], start[new], np.maximum.reduceat(end, new), np.maximum.reduceat(at + words, new) - at[new], owner[new]
        offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(x) for x in (at, start, end, words)], fields=list(_SPAN.value_type))
        columns = batch.columns
        columns[k] = pa.ListArray.from_arrays(pa.array(offsets), values)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """One row per document row: id, n_words, hit spans (byte offsets in the text's UTF-8, end
    exclusive, with the number of words inside), n_hit and the matching item ids (as strings).

    Null and empty texts have no words and no hits.  Repeated rows, repeated ids and null ids
    are rows of their own.  Spans of a row neither touch nor overlap.  Other columns are
    ignored.  An empty benchmark finds nothing.
    """
    sc = docs.sparkSession.sparkContext
    known = [sc.broadcast(part) for part in _slices(benchmark_windows(benchmark, n=n), slice_windows)]
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if len(known) == 1:
        found = _spans(texts, known[0])
    else:
        # written once, so that every slice's scan sees a row under the same number
        texts, _ = staged(texts, "contamination")
        found = functools.reduce(DataFrame.unionByName, [_spans(texts, part) for part in known])
        found = found.groupBy("row").agg(F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        found = found.mapInArrow(_united, found.schema)
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["words"].alias("words")))
    return found.select(F.col("id").alias(id_col), "n_words", spans.alias("spans"), "items")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest of ``find_contamination`` that the query returns."""
    found = find_contamination(docs, benchmark, **options)
    return found.select(
        options.get("id_col", "doc_id"),
        "n_words",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["words"]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, all columns as they were.

    Rows with a null id are judged by their texts too, like any other.
    """
    sc = docs.sparkSession.sparkContext
    kept = docs
    for part in _slices(benchmark_windows(benchmark, n=n), SLICE_WINDOWS):
        kept = _without_hits(kept, sc.broadcast(part), text_col)
    return kept


def _without_hits(docs: DataFrame, known, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            keep = np.ones(batch.num_rows, bool)
            for lo, hi in blocks(np.diff(offsets), _BLOCK):
                own = offsets[lo : hi + 1]
                _, _, owner, hit, _ = known.value.scan(_LOWER[data[own[0] : own[-1]]], own - own[0])
                keep[lo + owner[hit]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)


def digest_sha(names: list[str]) -> str:
    """The digest of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i+9], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ks, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
