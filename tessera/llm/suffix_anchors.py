"""Where two texts can share a long string: anchors chosen by content.

Of the k-grams inside a window of ``length`` bytes the one with the least hash is the window's
anchor (the leftmost of equal ones), so equal windows have equal anchors at equal places.
Consecutive windows with one anchor form a region; a region's hash and its anchor's decide
most of the work without comparing bytes.
"""

from __future__ import annotations

import numpy as np

from .common import Powers, blocks, mix, prefix_sums, word_bounds

GRAM = 64
_POSITION_BITS = 24
_BLOCK = 1 << 20
_BYTES, _AGAIN, _LETTERS = Powers(0x9E3779B97F4A7C15), Powers(0xA0761D6478BD642F), Powers(0xE7037ED1A0B428DB)
_IS_WORD = np.ones(256, bool)
_IS_WORD[9:14] = _IS_WORD[32] = False


def _sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys, from running minima of blocks of that width."""
    n = len(keys)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets): each word of each text as a 64-bit hash; words are what white space parts."""
    starts, ends = word_bounds(_IS_WORD[data], offsets)
    out, at = np.zeros(len(starts), np.uint64), np.searchsorted(starts, offsets)
    for lo, hi in blocks(np.diff(offsets), _BLOCK):
        a, b = at[lo], at[hi]
        base = int(offsets[lo])
        total, down = prefix_sums(data[base : offsets[hi]].astype(np.uint64) + np.uint64(1), _LETTERS)
        out[a:b] = mix((total[ends[a:b] - base] - total[starts[a:b] - base]) * down[starts[a:b] - base])
    return out, at


def regions(data: np.ndarray, length: int, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Regions of one text or of a part of it: start and number of windows, place of the anchor in
    the region, hashes of anchor and region (``region`` and ``more``, of independent bases)."""
    if len(data) < length:
        return {k: np.zeros(0, np.int64) for k in ("start", "windows", "at", "anchor", "region", "more")}
    symbols = data.astype(np.uint64) + np.uint64(1)
    total, down = prefix_sums(symbols, _BYTES)
    grams = mix((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    mask = np.uint64((1 << _POSITION_BITS) - 1)
    keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    place = (_sliding_minimum(keys, length - gram + 1) & mask).astype(np.int64)
    cut = np.flatnonzero(np.diff(place)) + 1
    start = np.concatenate([[0], cut])
    end = np.concatenate([cut, [len(place)]])
    anchor = place[start]
    stop = end - 1 + length
    whole = mix((total[stop] - total[start]) * down[start])
    again, back = prefix_sums(symbols, _AGAIN)
    more = mix((again[stop] - again[start]) * back[start])
    shape = mix(((end - start) * 100_003 + anchor - start).astype(np.uint64))
    return {"start": start, "windows": end - start, "at": anchor - start, "anchor": grams[anchor].view(np.int64), "region": (mix(whole) ^ shape).view(np.int64), "more": (mix(more) ^ shape).view(np.int64)}


def text_regions(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM):
    """Yields (row, regions) for each text of a buffer; a text over the block size is read in parts
    that overlap by ``length - 1`` bytes, so that no window is lost or seen twice."""
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for lo in range(a, max(b - length + 1, a), _BLOCK):
            part = regions(data[lo : min(lo + _BLOCK + length - 1, b)], length, gram)
            part["start"] = part["start"] + (lo - a)
            yield row, part


__all__ = ["regions", "text_regions", "word_symbols"]
