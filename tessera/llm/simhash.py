"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of the fingerprint is given a non-zero vector over F2 of radius + 1 dimensions; a
table keeps the bits whose vectors have the product 1 with the table's own vector.  Any
``radius`` differing bits span too little to meet every table, so each pair within the radius
agrees on the kept bits of some table: none is missed.  Buckets that many different
fingerprints share are cut by the same construction once more, on the bits that still differ,
so no group grows with the data.  A bucket gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, staged, text_buffer
from .components import connected_components

RADIUS, SHINGLE, SEED = 3, 3, 42
#: buckets of more fingerprints are cut again
BUCKET = 128
_PART = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text in UTF-8: bits set in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    last = max(len(words) - shingle + 1, 1)
    total = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for lo in range(0, last, _PART):
        hi = min(lo + _PART, last)
        parts = zip(*(words[lo + i : hi + i] for i in range(shingle)), strict=True) if len(words) >= shingle else [words]
        hashes = np.fromiter((digest(join(p), seed) for p in parts), "<u8", hi - lo)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp bigint) of every row; a null text counts as empty and has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            raw, at = memoryview(data), offsets.tolist()
            fps = np.array([fingerprint(bytes(raw[a:b]), shingle) for a, b in zip(at, at[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def covering_masks(radius: int, bits: list[int]) -> list[int]:
    """2**(radius + 1) - 1 masks over the given bit positions; any two values that differ in at
    most ``radius`` of these positions agree under one of them."""
    size = 1 << (radius + 1)
    vectors = {bit: 1 + k % (size - 1) for k, bit in enumerate(bits)}
    return [sum(1 << bit for bit, m in vectors.items() if (m & v).bit_count() % 2) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _keys(fp: Column, levels: list[tuple[str, list[int]]]) -> Column:
    masks = F.array(*(F.lit(_signed(m)) for m in levels))
    return F.transform(masks, lambda m, i: F.struct(i.alias("t"), fp.bitwiseAND(m).alias("key")))


def _forest(batches: Iterator[pa.RecordBatch], radius: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Links of a spanning forest of each bucket; rows come sorted by bucket."""

    def links(values: np.ndarray) -> list[np.ndarray]:
        if len(values) == 2:
            return [values[None, :]] if int(values[0] ^ values[1]).bit_count() <= radius else []
        left, todo, out = np.sort(values), np.zeros(0, np.uint64), []
        while len(left) or len(todo):
            if not len(todo):
                todo, left = left[:1], left[1:]
            u, todo = todo[0], todo[1:]
            near = np.bitwise_count(left ^ u) <= radius
            if near.any():
                found = left[near]
                out.append(np.stack([np.full_like(found, u), found], 1))
                todo, left = np.concatenate([todo, found]), left[~near]
        return out

    def write(parts: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate(parts).view(np.int64) if parts else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both.min(1)), pa.array(both.max(1))], ["a", "b"])

    held_key, held, out = None, [], []
    for batch in batches:
        keys = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(fps):
            continue
        cut = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(fps)]):
            key = tuple(int(k[a]) for k in keys)
            if key != held_key:
                if held and sum(map(len, held)) > 1:
                    out += links(np.concatenate(held))
                held_key, held = key, []
            held.append(fps[a:b])
        if out:
            yield write(out)
            out = []
    if held and sum(map(len, held)) > 1:
        out += links(np.concatenate(held))
    yield write(out)


def _bucket_links(spread: DataFrame, names: list[str], radius: int) -> DataFrame:
    dealt = spread.select(*names, "fp").repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInArrow(lambda batches: _forest(batches, radius, names), "a bigint, b bigint")


def near_links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b), a < b, whose components are those of all pairs of the distinct ``fp`` within
    the radius."""
    bits = list(range(64))
    spread, names = distinct.select("fp"), []
    links = None
    for level in range(3):
        t, key = f"t{level}", f"k{level}"
        masks = covering_masks(radius, bits[level * 21 :] + bits[: level * 21])
        spread = spread.select("fp", *names, F.explode(_keys(F.col("fp"), masks)).alias("x")).select("fp", *names, F.col("x.t").alias(t), F.col("x.key").alias(key))
        names = [*names, t, key]
        sizes = spread.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1")
        live, path = staged(spread.join(sizes, names), "buckets")
        here = _bucket_links(live.where(F.col("n") <= bucket) if level < 2 else live, names, radius)
        links = here if links is None else links.unionByName(here)
        if level == 2 or live.where(F.col("n") > bucket).isEmpty():
            break
        spread = live.where(F.col("n") > bucket).drop("n")
    return links.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document row: id, fp bigint, component: the smallest id that links reach.

    Texts without words have fingerprint zero and link like any other; null texts count as
    empty.  Rows with a null id belong to their group but never name it; a group without any
    id has a null component.  Repeated rows give repeated results.
    """
    prints, _ = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes, _ = staged(prints.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    members, _ = connected_components(near_links(classes, radius))
    named = classes.join(members.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    named, path = staged(named, "roots")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    answer, _ = staged(named.join(least, "root").select("fp", "component"), "components")
    discard(docs.sparkSession, path)
    return prints.join(answer, "fp").select(F.col("id").alias(id_col), "fp", "component")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """The query's columns: doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one of the smallest id; all columns as they were.

    Rows of the same id count as one document and only one of them stays; rows with a null
    id can't be told apart and stay.
    """
    found = near_duplicates(docs, id_col, text_col).where(F.col(id_col).isNotNull())
    verdict, _ = staged(found.groupBy(id_col).agg(F.count("*").alias("_n"), F.first("component").alias("_component")).where(f"_n > 1 or _component != `{id_col}`"), "verdicts")
    left = docs.join(verdict.where(f"_component != `{id_col}`"), id_col, "left_anti").select(*docs.columns)
    again = verdict.where("_n > 1").select(id_col)
    if again.isEmpty():
        return left
    return left.join(again, id_col, "left_anti").unionByName(left.join(again, id_col, "left_semi").dropDuplicates([id_col])).select(*docs.columns)
