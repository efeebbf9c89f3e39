"""Range asymmetric numeral system with a static table, in lanes that interleave within a block.

State 64 bits, at least 2**31; renormalised by 32-bit words; frequencies sum to 2**20. Lane j of a block has its ids
j, j + LANES, ...; all lanes take a step at once. The words of a block stand in the order in which its decoder reads
them, lane by lane within a step. A checkpoint is the decoder's state before a step and its place among the words;
the parts between checkpoints are decoded side by side.
"""

from __future__ import annotations

import numpy as np

BITS, LANES, STEPS = 20, 1024, 128  # a checkpoint every STEPS steps
LOW, WORD = np.uint64(1 << 31), np.uint64(32)


class Table:
    """Frequencies of ids, scaled to 2**BITS; every id that occurs keeps at least 1."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.float64)
        seen = counts > 0
        if seen.sum() > 1 << BITS:
            raise ValueError("more ids than slots")
        scaled = np.zeros(len(counts), np.int64)
        if seen.any():
            room = (1 << BITS) - int(seen.sum())
            scaled[seen] = 1 + np.floor(counts[seen] * (room / counts.sum())).astype(np.int64)
            scaled[int(np.argmax(counts))] += (1 << BITS) - int(scaled.sum())
        self.frequency = scaled.astype(np.uint64)
        self.begin = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.id_of = np.repeat(np.arange(len(counts), dtype=np.int32), scaled)
        self.common = int(np.argmax(counts)) if seen.any() else 0


def encode(table: Table, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, states, places): row k of ``states`` is the decoder's state at checkpoint k, ``places[k]`` its word."""
    steps = -(-len(ids) // LANES)
    padded = np.full(steps * LANES, table.common, np.int64)
    padded[: len(ids)] = ids
    f, c = (a[padded].reshape(steps, LANES) for a in (table.frequency, table.begin))
    if len(ids) and not f.all():
        raise ValueError("an id has no frequency")
    x = np.full(LANES, LOW, np.uint64)
    out, states, counts = [], [], []
    limit = f << np.uint64(63 - BITS)
    for t in range(steps - 1, -1, -1):
        full = x >= limit[t]
        out.append(x[full].astype(np.uint32))
        np.right_shift(x, WORD, out=x, where=full)
        q = x // f[t]
        x += (q << np.uint64(BITS)) - q * f[t] + c[t]
        if t % STEPS == 0:
            states.append(x.copy())
            counts.append(len(out))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    sizes = np.cumsum([0, *(len(o) for o in out[::-1])])
    places = np.array([sizes[steps - k] for k in counts[::-1]], np.int64)
    return words, np.array(states[::-1], np.uint64).reshape(-1, LANES), places


def decode(table: Table, words: np.ndarray, states: np.ndarray, places: np.ndarray, n: int, first: int = 0) -> np.ndarray:
    """The ids of a block from checkpoint ``first`` on; ``n``: ids of the whole block."""
    steps = -(-n // LANES)
    parts = len(places) - first
    if parts <= 0 or n == 0:
        return np.zeros(0, np.int32)
    x = states[first:].copy()
    at = places[first:].copy()
    ids = np.zeros((parts, STEPS, LANES), np.int32)
    mask = np.uint64((1 << BITS) - 1)
    left = np.minimum(STEPS, steps - (first + np.arange(parts)) * STEPS)  # steps of each part; only the last has fewer
    for t in range(STEPS):
        live = int((left > t).sum())
        if not live:
            break
        y = x[:live]
        slot = y & mask
        s = table.id_of[slot]
        ids[:live, t] = s
        y = table.frequency[s] * (y >> np.uint64(BITS)) + slot - table.begin[s]
        need = y < LOW
        rows, lanes = np.nonzero(need)
        each = np.bincount(rows, minlength=live)
        starts = np.cumsum(each) - each
        spot = at[rows] + np.arange(len(rows)) - starts[rows]
        y[rows, lanes] = y[rows, lanes] << WORD | words[spot].astype(np.uint64)
        at[:live] += each
        x[:live] = y
    flat = ids.reshape(-1, LANES)[: steps - first * STEPS]
    return flat.ravel()[: n - first * STEPS * LANES]
