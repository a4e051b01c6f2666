"""Exact removal of long repeated strings.

Anchors (see ``suffix_anchors``) cut every text into regions of windows.  Regions that are the
same from end to end are counted by their hashes (192 bits).  Regions that share an anchor but differ are
compared by their bytes: their collection's Burrows-Wheeler transform is built column by column,
one symbol of every region each round, and neighbours in its suffix order show which windows
share their whole length.  An anchor that more different regions share than one collection holds
would put a hot passage into one task; ranges of the windows of its regions are counted, by anchor, distance and hash, in
grouped aggregations that add up before their shuffles instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, staged, text_buffer
from .suffix_anchors import GRAM, text_regions, word_symbols

LENGTH = 400
#: words of a passage that is told when it repeats: over fifty
LEAST_WORDS = 51
#: regions that one transform is built of, about; anchors with more regions are hot
COLLECTION = 1000
HOT = 1000
_RANK_BLOCK = 128
#: neighbouring windows that are counted together for hot anchors, round by round
_GRIDS = (49, 7, 1)


def collection_bwt(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The transform of a collection, built from the right, and the symbols' codes by byte.

    In each round every text that has symbols left inserts one suffix, a symbol longer than the
    last.  Its place follows from the transform so far: all symbols that are smaller, and equal
    ones before the place of its last suffix.  Code 0 marks where a text begins.
    """
    lengths = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(lengths)
    used = np.flatnonzero(np.bincount(flat, minlength=256))
    code = np.zeros(256, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    sigma, m = len(used) + 1, len(texts)

    def symbol(rows: np.ndarray, back: int) -> np.ndarray:
        left = lengths[rows] > back
        return np.where(left, code[flat[np.maximum(ends[rows] - 1 - back, 0)]], 0)

    rows = np.arange(m)
    bwt, place = symbol(rows, 0).astype(np.uint8 if sigma <= 256 else np.uint16), np.arange(m)
    edge, counts = _counted(bwt, sigma)
    for t in range(int(lengths.max(initial=0))):
        going = lengths[rows] > t
        rows, place = rows[going], place[going]
        own = bwt[place]
        block = np.searchsorted(edge, place, "right") - 1
        inner, width = place - edge[block], int(np.diff(edge).max())
        padded = np.concatenate([bwt, np.zeros(width, bwt.dtype)])
        same = (np.lib.stride_tricks.sliding_window_view(padded, width)[edge[block]] == own[:, None]) & (np.arange(width) < inner[:, None])
        upto = np.cumsum(counts, 0)
        smaller = np.cumsum(upto[-1]) - upto[-1] - upto[-1, 0]
        place = m + smaller[own] + upto[block, own] - counts[block, own] + same.sum(1)
        new = symbol(rows, t + 1).astype(bwt.dtype)
        order = np.argsort(place)
        cuts = place[order] - np.arange(len(order))
        bwt = _inserted(bwt, cuts, new[order])
        # blocks grow where symbols come in; they are cut anew before one gets long
        grown = np.clip(np.searchsorted(edge, cuts, "right") - 1, 0, len(counts) - 1)
        np.add.at(counts, (grown, new[order]), 1)
        edge = edge + np.concatenate([[0], np.cumsum(np.bincount(grown, minlength=len(counts)))])
        if np.diff(edge).max() > 2 * _RANK_BLOCK:
            edge, counts = _counted(bwt, sigma)
    return bwt, code


def _counted(bwt: np.ndarray, sigma: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of blocks of equal size, and how often each symbol stands in each block."""
    n = len(bwt)
    blocks = max(1, -(-n // _RANK_BLOCK))
    counts = np.bincount(np.arange(n) // _RANK_BLOCK * sigma + bwt, minlength=blocks * sigma).reshape(blocks, sigma)
    return np.append(np.arange(blocks) * _RANK_BLOCK, n), counts


def _inserted(old: np.ndarray, cuts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """``old`` with the symbols put in before the places ``cuts``, copied run by run."""
    at = (cuts * old.itemsize).tolist()
    raw, new, size = old.tobytes(), symbols.tobytes(), old.itemsize
    parts = [b""] * (2 * len(at) + 1)
    parts[0::2] = [raw[a:b] for a, b in zip([0, *at], [*at, len(raw)], strict=True)]
    parts[1::2] = [new[i : i + size] for i in range(0, len(new), size)]
    return np.frombuffer(b"".join(parts), old.dtype)


def suffix_order(texts: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, offset) of all suffixes of at least ``least`` symbols, in lexicographic order."""
    bwt, _ = collection_bwt(texts)
    lengths = np.array([len(t) for t in texts])
    m = len(texts)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[by_symbol] = np.arange(len(bwt)) - (bwt == 0).sum() + m
    owner, offset = np.full(len(bwt), -1, np.int64), np.zeros(len(bwt), np.int64)
    rows, place = np.arange(m), np.arange(m)
    for t in range(int(lengths.max(initial=0))):
        going = lengths[rows] > t
        rows, place = rows[going], step[place[going]]
        if t + 1 >= least:
            owner[place], offset[place] = rows, lengths[rows] - t - 1
    long = owner >= 0
    return owner[long], offset[long]


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, flags of the window starts whose string starts somewhere else as well."""
    owner, offset = suffix_order(texts, length)
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(texts), np.uint8)
    at = starts[owner] + offset
    equal = np.zeros(len(at), bool)
    if len(at) > 1:
        windows = np.lib.stride_tricks.sliding_window_view(flat, length)
        for lo in range(0, len(at) - 1, 8192):
            part = at[lo : lo + 8193]
            own = windows[part]
            equal[lo : lo + len(part) - 1] = (own[1:] == own[:-1]).all(1)
    hit = equal.copy()
    hit[1:] |= equal[:-1]
    flags = [np.zeros(max(n - length + 1, 0), bool) for n in lengths.tolist()]
    for i, o in zip(owner[hit].tolist(), offset[hit].tolist(), strict=True):
        flags[i][o] = True
    return flags


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two 64-bit keys tell rows apart: of the id and of the text.  Rows equal in both are equal
    in all that counts, so they may share what is found about them."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select("id", "text", F.xxhash64("id").alias("k1"), F.xxhash64("text").alias("k2"))


_KEY = ("anchor", "region", "more")


@dataclass(frozen=True)
class Unit:
    """What texts are strings of: bytes, or words as 64-bit hashes."""

    length: int
    gram: int
    width: int
    hot: int
    grids: tuple[int, ...]

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (data, offsets) if self.width == 1 else word_symbols(data, offsets)

    def string(self, text: bytes) -> bytes:
        """The text as the bytes of its symbols."""
        if self.width == 1:
            return text
        return self.symbols(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tobytes()


def of_bytes(length: int = LENGTH, hot: int | None = None) -> Unit:
    return Unit(length, GRAM, 1, HOT if hot is None else hot, _GRIDS)


def of_words(length: int = LEAST_WORDS) -> Unit:
    """Words give short strings, so all their regions go by ranges."""
    return Unit(length, min(8, length), 8, 0, (7, 1))


def _anchors(keyed: DataFrame, unit: Unit) -> DataFrame:
    """One row for each different region of a text, with all its places there: a text that repeats
    itself without end does not send a row for every turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = unit.symbols(*text_buffer(batch.column("text")))
            rows, parts = [], []
            for row, part in text_regions(data, offsets, unit.length, unit.gram):
                rows.append(np.full(len(part["start"]), row))
                parts.append(part)
            if not parts:
                continue
            row = np.concatenate(rows)
            whole = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
            order = np.lexsort((whole["start"], *(whole[k] for k in _KEY), row))
            new = np.ones(len(order), bool)
            new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (row, *(whole[k] for k in _KEY))], 0)
            first = order[np.flatnonzero(new)]
            ends = np.append(np.flatnonzero(new), len(order)).astype(np.int32)
            starts = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole["start"][order].astype(np.int64)))
            columns = [batch.column("k1").take(pa.array(row[first])), batch.column("k2").take(pa.array(row[first])), starts]
            columns += [pa.array(whole[k][first].astype(kind)) for k, kind in (("windows", np.int32), ("at", np.int32), *((k, np.int64) for k in _KEY))]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "starts", "windows", "at", *_KEY])

    return keyed.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, starts array<bigint>, windows int, at int, anchor bigint, region bigint, more bigint")


def _packed(keyed: DataFrame, *columns: str) -> DataFrame:
    """Texts compressed for the way to a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            at = offsets.tolist()
            packed = pa.array([press.compress(data[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*columns, "k1", "k2")), packed], [*columns, "k1", "k2", "packed"])

    kinds = dict(keyed.dtypes)
    return keyed.select(*columns, "k1", "k2", "text").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in (*columns, "k1", "k2")) + ", packed binary")


_PART = "k1 bigint, k2 bigint, anchor bigint, start bigint, at int, single boolean, hot boolean, bytes binary"


def _cut_out(needed: DataFrame, unit: Unit) -> DataFrame:
    """Bytes of the symbols of the needed regions."""
    length, width = unit.length, unit.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, packed, wanted in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "packed", "wanted")), strict=True):
                text = unit.string(unpack.decompress(packed))
                out += [(k1, k2, w["anchor"], w["start"], w["at"], w["single"], w["hot"], text[w["start"] * width : (w["start"] + w["windows"] + length - 1) * width]) for w in wanted]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["k1", "k2", "anchor", "start", "at", "single", "hot", "bytes"])

    return needed.mapInArrow(run, _PART)


_WHOLE, _CORE = ("whole1", "whole2"), ("core1", "core2")


def _ranges(rows: DataFrame, grid: int, unit: Unit) -> DataFrame:
    """Each region's windows in ranges of ``grid`` neighbouring distances to the anchor.

    ``low`` and ``high`` bound the distances that the region has of the range, ``whole`` is the
    hash of all bytes of these windows, ``core`` that of the bytes that all windows of the
    range share, had by this region or not: regions of different cores share no window there.
    """
    length, width = unit.length, unit.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k1, k2, anchor, start, at, single, low, high, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "anchor", "start", "at", "single", "low", "high", "bytes")), strict=True):
                for q in range(low // grid, high // grid + 1):
                    lo, hi = max(low, q * grid), min(high, q * grid + grid - 1)
                    core = text[(at - q * grid) * width : (at - (q * grid + grid - 1) + length) * width]
                    digest = blake2b(text[(at - hi) * width : (at - lo + length) * width], digest_size=16).digest() + blake2b(core, digest_size=16).digest()
                    out.append((k1, k2, anchor, start, at, single, lo, hi, q, digest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32())
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            digests = np.frombuffer(b"".join(r[9] for r in out), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(digests[:, i])) for i in range(4))], ["k1", "k2", "anchor", "start", "at", "single", "low", "high", "q", *_WHOLE, *_CORE])

    return rows.mapInArrow(run, "k1 bigint, k2 bigint, anchor bigint, start bigint, at int, single boolean, low int, high int, q int, whole1 bigint, whole2 bigint, core1 bigint, core2 bigint")


def _hot_spans(parts: DataFrame, unit: Unit, paths: list[str]) -> DataFrame | None:
    """Spans of the single regions of hot anchors: ranges of their windows are counted, in sizes that
    shrink to one window.  A range that stands there twice is settled, and so is one whose core
    no other has; only what is left is cut finer, one of each kind.  Counts add up before their
    shuffle, so no anchor meets in one task, however many regions share it."""
    length, hot = unit.length, parts.where("hot")
    rows = hot.select("k1", "k2", "anchor", "start", "at", "single", F.greatest(F.lit(0), F.col("at") + length - (F.octet_length("bytes") / unit.width).cast("int")).alias("low"), F.col("at").alias("high"), "bytes")
    if rows.isEmpty():
        return None
    spans = None
    for grid in unit.grids:
        ranges = _noted(_ranges(rows, grid, unit), "ranges", paths)
        key = ["anchor", "q", "low", "high", *_WHOLE]
        one = [F.first(c).alias(c) for c in ("k1", "k2", "start", "at", "single", *_CORE)]
        kinds = _noted(ranges.groupBy(*key).agg(F.count("*").alias("n"), *one), "kinds", paths)
        found = ranges.where("single").join(kinds.where("n > 1").select(*key).hint("shuffle_hash"), key).select("k1", "k2", (F.col("start") + F.col("at") - F.col("high")).alias("lo"), (F.col("start") + F.col("at") - F.col("low") + length).alias("hi"))
        spans = found if spans is None else spans.unionByName(found)
        if grid > 1:
            core = ["anchor", "q", *_CORE]
            met = kinds.groupBy(*core).agg(F.count("*").alias("kinds")).where("kinds > 1")
            left = kinds.withColumn("once", F.col("n") == 1).join(met.hint("shuffle_hash"), core, "left_semi")
            # a kind that stands there twice goes on twice in one: its windows are found whoever else has them
            left = left.select("k1", "k2", "anchor", "start", "at", (F.col("single") & F.col("once")).alias("single"), "low", "high")
            rows = _noted(left.join(hot.select("k1", "k2", "anchor", "start", "bytes"), ["k1", "k2", "anchor", "start"]), "left", paths)
    return spans


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection over slices."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _longest_shared(texts: list[bytes]) -> list[int]:
    """For each text its longest common prefix with any other one."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    longest = [0] * len(texts)
    for i, j in zip(order, order[1:]):
        n = _common(texts[i], texts[j])
        longest[i], longest[j] = max(longest[i], n), max(longest[j], n)
    return longest


def narrowed(regions: list[tuple[bytes, int]], length: int) -> list[tuple[int, int]]:
    """For regions (bytes, place of the anchor) of one anchor: the range of window starts that can be
    in another region.  A shared window agrees from the anchor to both its ends, so it lies
    within the longest agreements to the left and to the right."""
    right = _longest_shared([text[at:] for text, at in regions])
    left = _longest_shared([text[:at][::-1] for text, at in regions])
    return [(max(0, at - far), min(len(text) - length, at + near - length) + 1) for (text, at), far, near in zip(regions, left, right, strict=True)]


def _compared(parts: DataFrame, length: int) -> DataFrame:
    """Spans of the single regions whose strings start in another region of their anchor, too."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        held: list[tuple] = []

        def solved(rows: list[tuple]) -> pa.RecordBatch:
            out: list[tuple] = []
            if len(rows) > 1:
                # strings that stand there twice are repeated throughout; the transform gets one of them
                number = {text: i for i, text in enumerate(dict.fromkeys(r[4] for r in rows))}
                times = np.bincount([number[r[4]] for r in rows])
                runs = [_runs(flags | (n > 1)) for flags, n in zip(repeated_windows(list(number), length), times.tolist(), strict=True)]
                out = [(k1, k2, start + a, start + b - 1 + length) for k1, k2, start, single, text in rows if single for a, b in runs[number[text]]]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], ["k1", "k2", "lo", "hi"])

        def close(rows: list[tuple]) -> None:
            for (k1, k2, start, at, single, text), (lo, hi) in zip(rows, narrowed([(r[5], r[3]) for r in rows], length), strict=True):
                if lo < hi:
                    held.append((k1, k2, start + lo, single, text[lo : hi - 1 + length]))

        last = None
        for batch in batches:
            for anchor, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "k1", "k2", "start", "at", "single", "bytes")), strict=True):
                if anchor != last:
                    close(group)
                    group = []
                    if len(held) >= COLLECTION:
                        yield solved(held)
                        held.clear()
                last = anchor
                group.append(tuple(row))
        close(group)
        yield solved(held)

    cold = parts.where("not hot").select("anchor", "k1", "k2", "start", "at", "single", "bytes")
    return cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(spans, "k1 bigint, k2 bigint, lo bigint, hi bigint")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(keyed documents, spans): spans (k1, k2, lo, hi) in bytes, which overlap; together they cover
    exactly the bytes of strings of ``length`` bytes that start at two places or more."""
    keyed = _keys(docs, id_col, text_col)
    return keyed, _spans(keyed, of_bytes(length, hot), [])


def _noted(df: DataFrame, name: str, paths: list[str]) -> DataFrame:
    """``df`` staged, its path noted for a later removal."""
    table, path = staged(df, name)
    paths.append(path)
    return table


def _spans(keyed: DataFrame, unit: Unit, paths: list[str]) -> DataFrame:
    length = unit.length
    anchors = _noted(_anchors(keyed, unit), "anchors", paths)
    # the first row of a class stands for it: all columns are taken from the same row, in hash aggregation
    rows = anchors.select("k1", "k2", F.col("starts")[0].alias("start"), F.size("starts").alias("times"), "windows", "at", *_KEY)
    classes = _noted(rows.groupBy(*_KEY).agg(F.sum("times").alias("n"), *(F.first(c).alias(c) for c in ("k1", "k2", "start", "windows", "at"))), "regions", paths)
    shared = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    compared = classes.join(shared.hint("shuffle_hash"), "anchor").select("k1", "k2", "start", "windows", "at", "anchor", (F.col("n") == 1).alias("single"), (F.col("kinds") > unit.hot).alias("hot"))
    wanted = compared.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "windows", "at", "anchor", "single", "hot")).alias("wanted"))
    texts = _packed(keyed)
    parts = _noted(_cut_out(texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "packed", "wanted"), unit), "parts", paths)
    # equal regions have equal anchors, so their own hashes are key enough
    repeated = anchors.select("k1", "k2", "starts", "windows", *_KEY[1:]).join(classes.where("n > 1").select(*_KEY[1:]).hint("shuffle_hash"), [*_KEY[1:]]).select("k1", "k2", F.explode("starts").alias("lo"), "windows")
    spans = repeated.select("k1", "k2", "lo", (F.col("lo") + F.col("windows") - 1 + length).alias("hi"))
    if unit.hot:
        spans = spans.unionByName(_compared(parts, length))
    by_range = _hot_spans(parts, unit, paths)
    return spans if by_range is None else spans.unionByName(by_range)


def _gathered(spans: DataFrame, name: str) -> DataFrame:
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias(name))


def repeated_words(keyed: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(k1, k2, words): how many words of a text stand in passages of ``least`` words or more that
    stand somewhere else as well; texts without one have no row."""

    def add(state: Column, span: Column) -> Column:
        return F.struct(F.greatest(state["end"], span["hi"]).alias("end"), (state["n"] + F.greatest(F.lit(0).cast("bigint"), span["hi"] - F.greatest(state["end"], span["lo"]))).alias("n"))

    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    total = F.aggregate(F.array_sort("spans"), zero, add, lambda state: state["n"])
    paths: list[str] = []
    words, _ = staged(_gathered(_spans(keyed, of_words(least), paths), "spans").select("k1", "k2", total.alias("words")), "words")
    discard(keyed.sparkSession, *paths)
    return words


def _with_spans(docs: DataFrame, id_col: str, text_col: str, length: int, least_words: int | None) -> DataFrame:
    # first the words: what they leave on disk is one number a text
    words = repeated_words(_keys(docs, id_col, text_col), least_words) if least_words else None
    keyed, spans = repeated_spans(docs, id_col, text_col, length)
    found = _gathered(spans, "spans")
    if words is not None:
        found = found.join(words, ["k1", "k2"], "full_outer")
    return _packed(keyed, "id").join(found, ["k1", "k2"], "left")


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of the text, and the number of maximal removed runs."""
    parts, at, runs = [], 0, 0
    end = -1
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or []):
        if lo > end:
            runs += 1
            parts.append(text[at:lo])
        end = max(end, hi)
        at = end
    parts.append(text[max(at, 0) :])
    return b"".join(parts), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, least_words: int | None = None) -> DataFrame:
    """One row per document row: id, n_bytes, ``kept`` (the remaining bytes), n_spans.

    Texts count as UTF-8; a null text is empty.  Texts shorter than ``length`` lose nothing.
    Repeated rows are occurrences of their own, so their long strings go in every one of
    them.  A cut may split a character, so what is kept is bytes.  Other columns are ignored.
    ``least_words`` adds ``n_repeated_words``: words in passages of so many words that stand elsewhere
    too, whatever their bytes; they are told, not removed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [unpack.decompress(p) for p in batch.column("packed").to_pylist()]
            kept = [_kept(t, s) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            columns = [batch.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([k for k, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[3:]], ["id", "n_bytes", "kept", "n_spans", *more])

    more = ["n_repeated_words"] if least_words else []
    found = _with_spans(docs, id_col, text_col, length, least_words).select("id", "packed", "spans", *(F.coalesce("words", F.lit(0).cast("bigint")).alias(c) for c in more))
    return found.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_bytes bigint, kept binary, n_spans bigint" + "".join(f", {c} bigint" for c in more)).withColumnRenamed("id", id_col)


def repeat_report(docs: DataFrame) -> DataFrame:
    """The query's digest of ``remove_repeats``."""
    left = remove_repeats(docs)
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["GRAM", "LENGTH", "collection_bwt", "narrowed", "remove_repeats", "repeat_report", "repeated_spans", "repeated_words", "repeated_windows", "suffix_order"]
