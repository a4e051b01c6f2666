"""Byte-level BPE: encoding by a rank file and decoding back.

Pre-tokenisation works on arrays of codepoint classes.  Where a token starts depends on the
classes next to it and, for the English contractions, on a small automaton; its transition
functions form a finite monoid, so their composition is an associative operation, and an
array scan gives the state at every codepoint at once.  Slices between the starts go through
a bounded cache of merged pieces.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, small_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_ENTRIES = 200_000
_SHORT = 32
_NONE = np.int32(2**31 - 1)
_BLOCK = 300_000

# classes of codepoints; letters of contractions have their own
LETTER, NUMBER, OTHER, QUOTE, SPACE, WHITE, EDGE, STMD, R_V, E, L = range(11)
_GROUP = np.array([0, 1, 2, 2, 3, 3, 4, 0, 0, 0, 0], np.uint8)  # letter, number, other, white space, edge

# states: a quote here may begin a contraction; it may not; it did; 'r or 'v; 'l; a contraction ended
FREE, BOUND, OPEN, WANTS_E, WANTS_L, ENDED = range(6)


def _step(state: int, kind: int) -> int:
    if kind in (OTHER, SPACE):
        return BOUND
    if kind == QUOTE:
        return BOUND if state in (BOUND, OPEN) else OPEN
    if kind == STMD and state == OPEN:
        return ENDED
    if kind == R_V and state == OPEN:
        return WANTS_E
    if kind == L and state in (OPEN, WANTS_L):
        return WANTS_L if state == OPEN else ENDED
    if kind == E and state == WANTS_E:
        return ENDED
    return FREE


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(function of each class, composition table, states by function and first state)."""
    found = {tuple(range(6)): 0}
    letters = [tuple(_step(s, k) for s in range(6)) for k in range(11)]
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in letters:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    functions = list(found)
    table = np.array([[found[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    return np.array([found[g] for g in letters], np.uint8), table, np.array(functions, np.uint8)


_OF_CLASS, _THEN, _APPLIED = _monoid()
_WIDTH = 64


def _states(kinds: np.ndarray) -> np.ndarray:
    """The automaton's state after each codepoint."""
    n = len(kinds)
    rows = -(-n // _WIDTH)
    f = np.zeros(rows * _WIDTH, np.uint8)
    f[:n] = _OF_CLASS[kinds]
    f = f.reshape(rows, _WIDTH)
    flat, k = _THEN.ravel(), _THEN.shape[0]
    d = 1
    while d < _WIDTH:
        f[:, d:] = flat[f[:, :-d].astype(np.uint16) * k + f[:, d:]]
        d *= 2
    first = np.empty(rows, np.uint8)
    state = FREE
    for i, whole in enumerate(f[:, -1].tolist()):
        first[i] = state
        state = int(_APPLIED[whole, state])
    return _APPLIED.ravel()[f.astype(np.uint16) * 6 + first[:, None]].ravel()[:n]


_classes: list[np.ndarray] = []


def codepoint_classes() -> np.ndarray:
    """The class of every codepoint."""
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            major = unicodedata.category(chr(c))[0]
            if major == "L":
                table[c] = LETTER
            elif major == "N":
                table[c] = NUMBER
        for c in [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
            table[c] = WHITE
        table[32], table[39] = SPACE, QUOTE
        for letters, kind in (("stmd", STMD), ("rv", R_V), ("e", E), ("l", L)):
            for c in letters:
                table[ord(c)] = kind
        _classes.append(table)
    return _classes[0]


def token_starts(kinds: np.ndarray) -> np.ndarray:
    """Flags of the codepoints where a piece starts; EDGE separates texts and is a piece alone."""
    n = len(kinds)
    group = _GROUP[kinds]
    before, after = np.full(n, 4, np.uint8), np.full(n, 4, np.uint8)
    before[1:], after[:-1] = group[:-1], group[1:]
    spaced = np.zeros(n, bool)
    spaced[1:] = kinds[:-1] == SPACE
    white = group == 3
    start = np.where(white, (before != 3) | (after < 3), (group != before) & ~spaced)
    start |= (group == 4) | (before == 4)
    ended = np.flatnonzero(_states(kinds) == ENDED)
    if len(ended):
        start[ended] = False
        start[ended[kinds[ended] != STMD] - 1] = False
        start[ended[ended + 1 < n] + 1] = True
        chained = ended[ended + 1 < n] + 1
        # a white space after a contraction follows the rule of runs: its first one starts a piece anyway
        start[chained] = True
    return start


class Encoder:
    """Ranks of one vocabulary with a cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        self.cache: dict[str, bytes] = {}
        self._bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = {}
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                if (left := self.ranks.get(piece[:i])) is not None and (right := self.ranks.get(piece[i:])) is not None:
                    pairs[left << 32 | right] = rank
        self._pairs = np.array(sorted(pairs), np.int64)
        self._merged = np.array([pairs[k] for k in self._pairs.tolist()], np.int32)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: again and again the adjacent pair of the lowest rank is merged, the
        leftmost first.  A heap of pairs keeps long pieces at n log n steps."""
        if (rank := self.ranks.get(piece)) is not None:
            return [rank]
        ranks, n = self.ranks, len(piece)
        ends = list(range(1, n + 1))  # end of the part that starts at i
        follow, prior, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = follow[i] if alive[i] else n
            if j >= n or ends[j] != end:
                continue
            ends[i], alive[j], follow[i] = end, False, follow[j]
            if follow[j] < n:
                prior[follow[j]] = i
                if (r := ranks.get(piece[i : ends[follow[j]]])) is not None:
                    heapq.heappush(heap, (r, i, ends[follow[j]]))
            if (p := prior[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = follow[i]
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids; _NONE where they don't merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, keys), len(self._pairs) - 1)
        return np.where((self._pairs[at] == keys) & (left >= 0) & (right >= 0), self._merged[at], _NONE)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many short pieces at once: in each round every piece merges its best pair."""
        n, width = np.array([len(p) for p in pieces]), max(map(len, pieces)) + 2
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < n[:, None]] = self._bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full(ids.shape, _NONE, np.int32)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        rows, columns = np.arange(len(pieces)), np.arange(width)
        while True:
            at = ranks[rows].argmin(1)
            best = ranks[rows, at]
            rows, at, best = rows[best != _NONE], at[best != _NONE], best[best != _NONE]
            if not len(rows):
                break
            for table, blank in ((ids, np.int32(-1)), (ranks, _NONE)):
                part = table[rows]
                shifted = np.full_like(part, blank)
                shifted[:, :-1] = part[:, 1:]
                table[rows] = np.where(columns > at[:, None], shifted, part)
            ids[rows, at] = best
            ranks[rows, at] = self._rank(best, ids[rows, at + 1])
            inner = at > 0
            ranks[rows[inner], at[inner] - 1] = self._rank(ids[rows[inner], at[inner] - 1], best[inner])
        known = ids >= 0
        flat, ends = ids[known].astype("<u4").tobytes(), np.cumsum(known.sum(1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, pieces: list[str]) -> None:
        """Put the pieces that the cache lacks into it; it is emptied before it grows too large."""
        new = set(pieces).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
            new = set(pieces)
        coded = {p: p.encode() for p in new}
        short = [p for p, raw in coded.items() if len(raw) <= _SHORT]
        for lo in range(0, len(short), 20_000):
            part = short[lo : lo + 20_000]
            self.cache.update(zip(part, self.merge_many([coded[p] for p in part]), strict=True))
        self.cache.update((p, np.array(self.merge(raw), "<u4").tobytes()) for p, raw in coded.items() if len(raw) > _SHORT)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        joined = "\n".join(texts)
        if not joined:
            return [b""] * len(texts)
        kinds = codepoint_classes()[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
        edges = np.cumsum([len(t) + 1 for t in texts])[:-1] - 1
        kinds[edges] = EDGE
        at = np.flatnonzero(token_starts(kinds))
        cuts = np.searchsorted(at, edges)
        at = at.tolist()
        pieces = list(map(joined.__getitem__, map(slice, at, [*at[1:], len(joined)])))
        self._learn(pieces)
        ids = list(map(self.cache.__getitem__, pieces))
        return [b"".join(ids[a:b]) for a, b in zip([0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> np.ndarray:
        """Byte offsets in the text at which the tokens end."""
        return np.cumsum([len(self.pieces[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a worker; it outlives the batches."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``ids`` array<int>, ``ends`` array<bigint> (the byte offset
    at which each token ends).  A null text is empty; an empty one has no ids.  The
    vocabulary must be at ``path`` on every executor.  Other columns are ignored."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for keys, coded in _coded(batches, bpe):
            yield pa.RecordBatch.from_arrays(
                [keys, _id_lists(coded), pa.array([bpe.offsets(x) for x in coded], pa.list_(pa.int64()))], ["id", "ids", "ends"]
            )

    return _keyed(docs, id_col, text_col).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, ids array<int>, ends array<bigint>").withColumnRenamed("id", id_col)


def _id_lists(coded: list[bytes]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and ``bytes``: what the ids stand for.  Null ids give no bytes."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            out = [bpe.decode(np.asarray(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "bytes"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"id {dict(encoded.dtypes)[id_col]}, bytes binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document row: id, n_tokens, digests of the ids and of the bytes decoded from
    them, and, if asked for, the ids.  Null texts count as empty; repeated rows give repeated results."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for keys, coded in _coded(batches, bpe):
            ids = [_id_lists(coded)] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(x) // 4 for x in coded], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in coded], pa.string()),
                    *ids,
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + len(ids)],
            )

    return _keyed(docs, id_col, text_col).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids).withColumnRenamed("id", id_col)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _coded(batches: Iterator[pa.RecordBatch], bpe: Encoder) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for batch in batches:
        texts = batch.column("text")
        sizes = np.array(pa.compute.binary_length(texts).to_pylist(), np.int64)
        for lo, hi in blocks(sizes, _BLOCK):
            yield batch.column("id").slice(lo, hi - lo), bpe.encode(texts.slice(lo, hi - lo).to_pylist())
