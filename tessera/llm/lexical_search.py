"""Ranked lexical search: MaxScore with bounds of term pairs over an index of document blocks.

Items are searched in slices of a bounded size, so what is broadcast has a fixed bound.  Per slice:

1. ``_forward`` scans every text once and writes, per document, its length and the terms of the slice.
2. ``_index`` turns each batch of documents into a block: posting lists with impacts and
   their maxima, and for each pair of terms that an item puts side by side (its terms by rising
   document frequency, two by two) the intersection of their lists with joint impacts and the
   joint maximum.  A document's joint impacts over the disjoint pairs of an item are a lower
   bound of its score; the k-th best of these over all blocks starts the item's threshold.
3. ``_Block.best`` bounds a pair by max(top a, top b, joint top), which is less than top a + top b
   where the terms do not meet at their best, skips blocks and documents whose sum of bounds
   stays under the threshold, and scores all others exactly.

Scores are 64-bit integers throughout, so the order of additions does not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import LOWER, blocks, discard, small_batches, staged, text_buffer, word_array

BEST = 20
SLICE_ITEMS = 2_000
SLICE_BYTES = 4 << 20
#: a block ends at so many documents or postings; a document is never cut
BLOCK_DOCS = 2_048
BLOCK_POSTINGS = 200_000
#: rows of blocks are large: few of them are held before they are written, or read at once
_SMALL_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
_IS_TERM = np.zeros(256, bool)
_IS_TERM[48:58] = _IS_TERM[97:123] = _IS_TERM[128:] = True


class _Slice:
    """Items of one round: ids, the distinct terms, and each item's (term, times)."""

    def __init__(self, items: list[tuple[object, Counter]]):
        self.ids = [i for i, _ in items]
        self.terms = sorted({t for _, counts in items for t in counts})
        at = {t: i for i, t in enumerate(self.terms)}
        self.items = [[(at[t], n) for t, n in counts.items()] for _, counts in items]

    def weigh(self, n_documents: int, n_terms: int, df: dict[int, int]) -> None:
        """Weights, and the units (pairs, at most one single term) of each item by rising document frequency."""
        self.n_documents, self.n_terms = n_documents, n_terms
        self.weights = np.zeros(len(self.terms), np.int64)
        for t, n in df.items():
            self.weights[t] = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * n + 1)))
        pairs: dict[tuple, int] = {}
        self.units = []
        for item in self.items:
            rare_first = sorted((df[t], t, n) for t, n in item if t in df)
            flat = [(t, n) for _, t, n in rare_first]
            two = [(*flat[i], *flat[i + 1]) for i in range(0, len(flat) - 1, 2)]
            self.units.append((np.array([pairs.setdefault(p, len(pairs)) for p in two], np.int64), flat[-1] if len(flat) % 2 else None))
        self.pairs = np.array(list(pairs), np.int64).reshape(-1, 4)


def _slices(items: DataFrame, id_col: str, text_col: str) -> Iterator[_Slice]:
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"))
    part, size = [], 0
    for row in items.select(F.col(id_col).alias("i"), terms.alias("w")).toLocalIterator():
        counts = Counter(row["w"] or ())
        more = sum(len(t.encode()) + 16 for t in counts)
        if part and (len(part) == SLICE_ITEMS or size + more > SLICE_BYTES):
            yield _Slice(part)
            part, size = [], 0
        part.append((row["i"], counts))
        size += more
    if part:
        yield _Slice(part)


def _forward(docs: DataFrame, id_col: str, text_col: str, known) -> DataFrame:
    """(id, n: terms of the text, terms, tfs: those of the slice) of every document with terms."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array([t.encode() for t in known.value], pa.binary())
        v = max(len(vocabulary), 1)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            words, owner = word_array(LOWER[data], offsets, _IS_TERM)
            codes = pc.index_in(words, value_set=vocabulary)
            codes = codes.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            found, tfs = np.unique(owner[codes >= 0] * v + codes[codes >= 0], return_counts=True)
            places = pa.array(np.searchsorted(found // v, np.arange(batch.num_rows + 1)).astype(np.int32))
            n = np.bincount(owner, minlength=batch.num_rows).astype(np.int64)
            lists = [pa.ListArray.from_arrays(places, pa.array(x.astype(np.int32))) for x in (found % v, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), *lists], ["id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(scan, f"id {texts.schema['id'].dataType.simpleString()}, n bigint, terms array<int>, tfs array<int>")


_LISTS = ("starts", "docs", "impacts", "tops", "pair_starts", "pair_docs", "joints", "pair_tops")
_INDEX_SQL = ", ".join(f"{name} binary" for name in _LISTS)


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common values of two rising arrays."""
    if len(a) > len(b):
        right, left = _common(b, a)
        return left, right
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    same = np.flatnonzero(b[at] == a) if len(b) else np.zeros(0, np.int64)
    return same, at[same]


class _Block:
    """Posting lists of one block of documents, by place in the block.

    List t is docs[starts[t]:starts[t+1]] with impacts, its greatest impact is tops[t]; the same
    holds of the pairs, whose lists have the documents of both terms with their joint impact."""

    def __init__(self, own: _Slice, lists: dict[str, np.ndarray]):
        self.own = own
        self.__dict__.update(lists)

    @classmethod
    def build(cls, own: _Slice, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> _Block:
        owner = np.repeat(np.arange(len(n)), sizes)
        m = 75 + (25 * n * own.n_documents) // own.n_terms
        impacts = own.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m[owner]))
        order = np.argsort(terms, kind="stable")
        starts = np.searchsorted(terms[order], np.arange(len(own.terms) + 1))
        docs, impacts = owner[order].astype(np.int32), impacts[order]
        tops = np.zeros(len(own.terms), np.int64)
        here = np.flatnonzero(np.diff(starts))
        if len(here):
            tops[here] = np.maximum.reduceat(impacts, starts[here])
        pair_docs, joints = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        pair_sizes, pair_tops = np.zeros(len(own.pairs), np.int64), np.zeros(len(own.pairs), np.int64)
        a, na, b, nb = own.pairs.T
        for p in np.flatnonzero((tops[a] > 0) & (tops[b] > 0)).tolist():
            lo_a, hi_a, lo_b, hi_b = starts[a[p]], starts[a[p] + 1], starts[b[p]], starts[b[p] + 1]
            left, right = _common(docs[lo_a:hi_a], docs[lo_b:hi_b])
            if len(left):
                joint = na[p] * impacts[lo_a + left] + nb[p] * impacts[lo_b + right]
                pair_docs.append(docs[lo_a + left])
                joints.append(joint)
                pair_sizes[p], pair_tops[p] = len(left), joint.max()
        pair_starts = np.concatenate([[0], np.cumsum(pair_sizes)])
        return cls(own, dict(zip(_LISTS, (starts, docs, impacts, tops, pair_starts, np.concatenate(pair_docs), np.concatenate(joints), pair_tops))))

    def pair(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.pair_starts[p], self.pair_starts[p + 1]
        return self.pair_docs[lo:hi], self.joints[lo:hi]

    def term(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.starts[t], self.starts[t + 1]
        return self.docs[lo:hi], self.impacts[lo:hi]

    def seeds(self, item: int, n_docs: int, k: int) -> np.ndarray:
        """The k greatest sums of joint impacts over the item's pairs, one for a document."""
        low = np.zeros(n_docs, np.int64)
        for p in self.own.units[item][0].tolist():
            docs, joints = self.pair(p)
            low[docs] += joints
        low = low[low > 0]
        return np.partition(low, len(low) - k)[len(low) - k :] if len(low) > k else low

    def best(self, item: int, n_docs: int, threshold: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, number of documents scored): every document whose score is
        positive and at least the threshold."""
        pairs, single = self.own.units[item]
        a, na, b, nb = self.own.pairs[pairs].T
        bounds = np.maximum(np.maximum(na * self.tops[a], nb * self.tops[b]), self.pair_tops[pairs])
        units: list[tuple] = list(zip(pairs.tolist(), a.tolist(), na.tolist(), b.tolist(), nb.tolist()))
        if single:
            bounds, units = np.append(bounds, single[1] * self.tops[single[0]]), [*units, single]
        below = np.cumsum(np.sort(bounds))
        if not len(below) or below[-1] < max(threshold, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        order = np.argsort(bounds, kind="stable").tolist()
        # documents that stand in these units alone can't reach the threshold
        spare = int(np.searchsorted(below, threshold, "left")) if threshold > 0 else 0
        total = np.zeros(n_docs, np.int64)
        for u in order[spare:]:
            unit = units[u][-4:]
            for t, times in zip(unit[::2], unit[1::2]):
                docs, impacts = self.term(t)
                total[docs] += times * impacts
        rest = int(below[spare - 1]) if spare else 0
        live = np.flatnonzero((total > 0) & (total + rest >= threshold))
        n_scored = len(live)
        for u in reversed(order[:spare]):
            unit, single_top = units[u], 0
            todo = np.arange(len(live))
            if len(unit) == 5:
                docs, joints = self.pair(unit[0])
                left, right = _common(live, docs)
                total[live[left]] += joints[right]
                todo = np.delete(todo, left)
                # who is not in the intersection has one of the two terms at most
                single_top = max(unit[2] * self.tops[unit[1]], unit[4] * self.tops[unit[3]])
                rest -= int(bounds[u])
                todo = todo[total[live[todo]] + rest + single_top >= threshold]
            else:
                rest -= int(bounds[u])
            pairs_of = unit[-4:]
            for t, times in zip(pairs_of[::2], pairs_of[1::2]):
                docs, impacts = self.term(t)
                left, right = _common(live[todo], docs)
                total[live[todo[left]]] += times * impacts[right]
            live = live[total[live] + rest >= threshold]
        return live, total[live], n_scored


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = batch.column("terms").value_lengths().to_numpy()
    for a in range(0, batch.num_rows, BLOCK_DOCS):
        for lo, hi in blocks(sizes[a : a + BLOCK_DOCS], BLOCK_POSTINGS):
            yield batch.slice(a + lo, hi - lo)


def _index(forward: DataFrame, known, k: int) -> DataFrame:
    """One row per block: ids of its documents, its lists, and seeds (item, score) that are
    among the k best of the task so far."""
    small_batches(forward.sparkSession)
    kind = forward.schema["id"].dataType

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        held = [np.zeros(0, np.int64)] * len(own.items)
        for batch in (part for whole in batches for part in _cut(whole)):
            terms, tfs = batch.column("terms"), batch.column("tfs")
            block = _Block.build(own, batch.column("n").to_numpy(), terms.value_lengths().to_numpy(), terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64))
            items, scores = [], []
            for i in range(len(own.items)):
                new = block.seeds(i, batch.num_rows, k)
                new = new[new > held[i][0]] if len(held[i]) == k else new
                if len(new):
                    held[i] = np.sort(np.concatenate([held[i], new]))[-k:]
                    items += [i] * len(new)
                    scores += new.tolist()
            lists = [pa.array([getattr(block, name).tobytes()], pa.binary()) for name in _LISTS]
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array([items], pa.list_(pa.int32())), pa.array([scores], pa.list_(pa.int64())), *lists], ["ids", "seed_items", "seed_scores", *_LISTS])

    return forward.mapInArrow(build, f"ids array<{kind.simpleString()}>, seed_items array<int>, seed_scores array<bigint>, {_INDEX_SQL}")


def _thresholds(index: DataFrame, n_items: int, k: int) -> np.ndarray:
    """For each item the k-th best lower bound, zero where fewer documents have one."""
    seeds = index.select(F.explode(F.arrays_zip("seed_items", "seed_scores")).alias("s")).select(F.col("s.seed_items").alias("item"), F.col("s.seed_scores").alias("score"))
    ranked = seeds.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).where(F.col("rank") <= k)
    out = np.zeros(n_items, np.int64)
    for row in ranked.where(F.col("rank") == k).select("item", "score").collect():
        out[row["item"]] = row["score"]
    return out


_DTYPES = {"docs": np.int32, "pair_docs": np.int32}


def _found(index: DataFrame, known, start, k: int, item_type) -> DataFrame:
    """The k best documents of each item in each task: item, item_id, doc, score."""
    kind = index.schema["ids"].dataType.elementType
    arrow_id, arrow_item = to_arrow_type(kind), to_arrow_type(item_type)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        held: list[list[tuple]] = [[] for _ in own.items]
        least = start.value.copy()
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("ids")[r].values
                block = _Block(own, {name: np.frombuffer(batch.column(name)[r].as_buffer(), _DTYPES.get(name, np.int64)) for name in _LISTS})
                for i in range(len(own.items)):
                    docs, scores, _ = block.best(i, len(ids), int(least[i]))
                    if not len(docs):
                        continue
                    if len(docs) > k:
                        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        docs, scores = docs[keep], scores[keep]
                    new = [(-s, d is None, d) for s, d in zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist())]
                    held[i] = sorted(held[i] + new, key=lambda x: x if x[2] is not None else x[:2])[:k]
                    if len(held[i]) == k:
                        least[i] = max(least[i], -held[i][-1][0])
        rows = [(i, own.ids[i], d, -s) for i, best in enumerate(held) for s, _, d in best]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), arrow_item, arrow_id, pa.int64()))], ["item", "item_id", "doc", "score"])

    return index.mapInArrow(search, f"item int, item_id {item_type.simpleString()}, doc {kind.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = BEST) -> DataFrame:
    """(item, rank, document, score): the ``k`` best documents of each item, scores above zero.

    Null texts have no terms, on either side; an item without terms, or without documents that
    share one, gives no rows.  Equal scores go by ascending id, null ids last.  Repeated rows are
    documents (or items) of their own.  Other columns are ignored; either table empty gives no rows.
    """
    spark = docs.sparkSession
    sc, item_type = spark.sparkContext, items.schema[item_col].dataType
    out = None
    for own in _slices(items, item_col, item_text):
        forward, path = staged(_forward(docs, id_col, text_col, sc.broadcast(own.terms)), "forward")
        n_documents, n_terms = forward.agg(F.count("*"), F.sum("n")).first()
        if not n_documents:
            break
        df = {r["t"]: r["n"] for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
        own.weigh(n_documents, n_terms, df)
        known = sc.broadcast(own)
        index, _ = staged(_index(forward, known, k), "blocks", **_SMALL_GROUPS)
        discard(spark, path)
        start = sc.broadcast(_thresholds(index, len(own.items), k))
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        found = _found(index.select("ids", *_LISTS), known, start, k, item_type).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found = found.select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        item, doc = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_col}` {item}, rank int, `{id_col}` {doc}, score bigint")
    return out


def search_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query's columns."""
    return search(docs, items).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
tot AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM len),
tf AS (SELECT doc_id, t, count(*) AS tf FROM w WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
imp AS (SELECT tf.doc_id, tf.t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) AS impact
        FROM tf JOIN df USING (t) JOIN len USING (doc_id), tot),
s AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM q JOIN imp USING (t) GROUP BY ALL HAVING sum(times * impact) > 0),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
