"""5-word shingle sets of whole texts, as sorted 64-bit hashes.

Works on the bytes of an Arrow batch with numpy: words are runs of non white
space with A-Z lower-cased; each gets a polynomial hash from prefix sums, and
five in a row are combined.  A text with one to four words is one shingle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
SLICE = 1 << 20
_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_R = 0x9E3779B97F4A7C15 | 1
_state: dict = {}


def _tables(length: int):
    """Byte values, white space flags, powers of the base and its inverse."""
    if not _state:
        rnd = np.random.RandomState(5)
        values = rnd.randint(0, 1 << 32, 256).astype(np.uint64) << np.uint64(32) | rnd.randint(0, 1 << 32, 256).astype(np.uint64)
        values[65:91] = values[97:123]
        ws = np.zeros(256, bool)
        ws[[32, *range(9, 14)]] = True
        _state.update(values=values, ws=ws, pow=np.ones(1, np.uint64), inv=np.ones(1, np.uint64))
    if len(_state["pow"]) < length:
        n = max(length, SLICE + 1)
        for name, base in (("pow", _R), ("inv", pow(_R, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _state[name] = np.cumprod(steps)
    return _state["values"], _state["ws"], _state["pow"], _state["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        values, _, up, down = _tables(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        # the length in words that differ only by it: part of the hash
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def _sets_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    ws = _tables(1)[1]
    blank = ws[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    h = _word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)  # of each document's words
    k = np.uint64(0xD6E8FEB86659FD93)
    if len(h) >= WORDS:
        five = h[:len(h) - WORDS + 1].copy()
        for j in range(1, WORDS):
            five = five * k + h[j:len(h) - WORDS + 1 + j]
        five = mix(five)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            out.append(np.unique(five[a:b - WORDS + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64) + np.uint64(b - a)
            for x in h[a:b]:
                one = one * k + x
            out.append(mix(one))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(text: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of a string array without nulls."""
    text = text.cast(pa.large_string())
    _, offsets, data = text.buffers()
    if not len(text):
        return
    offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
            part = offsets[at:to + 1]
            for row, s in enumerate(_sets_of(data[part[0]:part[-1]], part - part[0]), at):
                yield row, s
            at = to
