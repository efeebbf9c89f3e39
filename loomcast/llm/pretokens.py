"""Vectorised splitting of UTF-8 text into the matches of the byte-level BPE pattern.

The matches tile the text, so a batch of texts and the array of their matches share one byte buffer; only start offsets
are computed. The rules below restate the pattern by classes of code points (letter, number, space, other):
a run of one class is a match and takes a single U+0020 before it along; of a longer run of spaces before
something, the last stays behind; an apostrophe that starts a match takes s, t, m, d, re, ve or ll along.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """Class of each code point, by the regex library's Unicode tables."""
    classes = np.zeros(0x110000, np.uint8)
    points = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            classes[m.start() : m.end()] = kind
    return classes


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte; the bytes of one code point have its class."""
    table = code_point_classes()
    kinds = table[:256].copy()
    kinds[128:] = OTHER
    out = kinds[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b0 = data[lead].astype(np.uint32)
        last = len(data) - 1
        b1, b2, b3 = (data[np.minimum(lead + k, last)].astype(np.uint32) & 0x3F for k in (1, 2, 3))
        size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
        point = np.where(size == 2, (b0 & 0x1F) << 6 | b1, np.where(size == 3, (b0 & 0x0F) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        kind = table[np.minimum(point, 0x10FFFF)]
        out[lead] = kind
        for k in (1, 2, 3):
            more = size > k
            out[lead[more] + k] = kind[more]
    return out


def starts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every match, ascending; ``offsets`` are those of the texts, none of whose matches crosses another's."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    kinds = byte_classes(data)
    edge = np.empty(n, bool)  # where a run of one class, or a text, begins
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    edge |= text_start[:n]

    runs = np.flatnonzero(edge)
    ends = np.append(runs[1:], n)
    kind = kinds[runs]
    start = edge  # turned into the matches' starts in place
    # Spaces before something in the same text: the last code point is split off, or joins what follows if it is U+0020.
    blank = np.flatnonzero((kind == SPACE) & ~text_start[ends])
    last = ends[blank] - 1
    plain = data[last] == 0x20
    joined = ends[blank[plain]]
    start[joined] = False
    start[last[plain]] = True
    for at, begin in zip(last[~plain], runs[blank[~plain]], strict=True):
        while at > begin and data[at] & 0xC0 == 0x80:
            at -= 1
        start[at] = True
    # Contractions: a run of just an apostrophe that no U+0020 joined.
    mark = np.flatnonzero((kind == OTHER) & (data[runs] == 0x27) & (ends - runs == 1) & start[runs])
    mark = mark[(mark + 1 < len(runs)) & ~text_start[ends[mark]]]
    if len(mark):
        mark = mark[kind[mark + 1] == LETTER]
        at, stop = ends[mark], ends[np.minimum(mark + 1, len(runs) - 1)]
        first = data[at]
        second = np.where(at + 1 < stop, data[np.minimum(at + 1, n - 1)], 0)
        size = np.where(np.isin(first, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        size[((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))] = 2
        size[(first == ord("l")) & (second == ord("l"))] = 2
        took = size > 0
        start[at[took]] = False
        rest = at[took] + size[took]
        start[rest[rest < stop[took]]] = True
    return np.flatnonzero(start)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The matches as a binary array over ``data``, and how many precede each text (n + 1 counts)."""
    starts = starts_of(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    cut = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(data))]), bounds
