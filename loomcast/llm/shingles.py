"""Word shingles of texts as hashes, and their TF-IDF weights.

Words are runs of ASCII letters and digits and of all bytes from 0x80 on, A-Z lower-cased. A shingle is ``size``
consecutive words; a text of fewer words, but not none, has one shingle of them all.
"""

from __future__ import annotations

import numpy as np

from .common import order_within, ranges, runs_of

SIZE = 5
#: Shingles in fewer than this share of the texts all weigh the same. An edited word's shingles are in one text; without a
#: bound they outweigh those of a group of near copies more and more as the corpus grows, though all shares stay alike.
FLOOR = 1e-3
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first 0 to 8 bytes of eight, by their number.
_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: One for each independent hash of a word. Eight bytes at a time are mixed with their place, so that no words collide by design.
_SEEDS = np.random.default_rng(23).integers(0, 1 << 64, 2, np.uint64)
#: Shingles of the texts that are sampled together and of a step of these; see :func:`weighted_samples`.
_RUN, _BLOCK, _ENOUGH = 1 << 15, 1024, 6.0
_STIR = [(np.uint32(factor), np.uint32(shift)) for factor, shift in ((0x85EBCA6B, 16), (0xC2B2AE35, 15), (0x9E3779B1, 16))]


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, independent: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """``independent`` (1 or 2) 64-bit hashes of each word, and how many words precede each text (n + 1 counts)."""
    n = len(data)
    word = _WORD[data]
    begin, stop = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begin[inner], stop[inner - 1] = word[inner], word[inner - 1]
    start = np.flatnonzero(begin)
    if not len(start):
        return [np.zeros(0, np.uint64)] * independent, np.zeros(len(offsets), np.int64)
    size = np.flatnonzero(stop) + 1 - start
    padded = np.zeros(n + 8, np.uint8)
    np.take(_LOWER, data, out=padded[:n])
    eight = np.ndarray(n + 1, "<u8", padded, 0, (1,))  # the 8 bytes from each place on
    far = np.flatnonzero(size > 8)
    pieces = (size[far] + 7) // 8 - 1
    first = np.cumsum(pieces) - pieces
    place = ranges(np.ones(len(far), np.int64), pieces)
    at = np.repeat(start[far], pieces) + 8 * place
    rest = eight[at] & _BYTES[np.minimum(np.repeat((start + size)[far], pieces) - at, 8)]
    head = eight[start] & _BYTES[np.minimum(size, 8)]
    out = []
    with np.errstate(over="ignore"):
        for seed in _SEEDS[:independent]:
            h = mix(head ^ mix(size.astype(np.uint64) * _BASE + seed))
            if len(far):
                h[far] = mix(h[far] + np.add.reduceat(mix(rest ^ mix(place.astype(np.uint64) * _BASE ^ seed)), first))
            out.append(h)
    return out, np.searchsorted(start, offsets)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the sequence of words of each text (n x 16 bytes), and whether it has any."""
    words, bounds = word_hashes(data, offsets, 2)
    n = np.diff(bounds)
    out, some = np.zeros((len(n), 2), np.uint64), n > 0
    place = ranges(np.zeros(len(n), np.int64), n).astype(np.uint64)
    with np.errstate(over="ignore"):
        for k, own in enumerate(words):
            if len(own):
                out[some, k] = np.add.reduceat(mix(own + (place + np.uint64(1)) * _BASE), bounds[:-1][some])
            out[:, k] = mix(out[:, k] + n.astype(np.uint64))
    return out.view(np.uint8).reshape(len(n), 16), some


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, n + 1 offsets) of each text's distinct shingles, hashes ascending."""
    (words,), bounds = word_hashes(data, offsets)
    n = np.diff(bounds)
    short = (n > 0) & (n < size)
    count = np.where(short, 1, np.maximum(n - size + 1, 0))
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(size, np.uint64)])
        h = np.zeros(len(words), np.uint64)
        for k in range(size):
            h = h * _BASE + padded[k : k + len(words)]
        for i in np.flatnonzero(short):
            s = np.uint64(0)
            for w in words[bounds[i] : bounds[i + 1]]:
                s = s * _BASE + w
            h[bounds[i]] = s + np.uint64(n[i])
        all_ = mix(h[ranges(bounds[:-1], count)])
    own = np.repeat(np.arange(len(n)), count)
    order = order_within(own, all_)
    all_, own = all_[order], own[order]
    new = np.ones(len(all_), bool)
    new[1:] = (all_[1:] != all_[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    return all_[first], np.diff(np.append(first, len(all_))), np.searchsorted(own[first], np.arange(len(n) + 1))


def weights(total: int, counts: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """Term frequency times 1 + ln(documents / document frequency), the frequency at least ``FLOOR`` of all documents."""
    return (1 + np.log(max(total, 1) / np.clip(frequencies, max(1, FLOOR * total), max(total, 1)))) * counts


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (ascending hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both)) if len(a[0]) or len(b[0]) else 0.0


def weighted_samples(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, bands: int, rows: int, usual: float = 1.0) -> np.ndarray:
    """Improved consistent weighted sampling: a hash for each text and band, of ``rows`` samples each.

    A shingle has a grid of ln z, r ~ Gamma(2, 1) apart, at a uniform offset, and c ~ Gamma(2, 1), all drawn by hashing
    shingle and sample. z is the grid's first point above ln w, and t its number. A sample is the shingle of smallest
    ln c - ln z and its t. Texts take the same sample with a probability that is their weighted Jaccard similarity.

    The draws are arranged so that few shingles need them all. From ln ``usual`` it is g to the grid's next point (number 0),
    and g and r - g are Exp(1) each; c splits in the same way into a = c exp(-g) and c - a. So c / z is a / usual
    for a weight of ``usual``, no less for smaller ones, and at least a exp(g - r) / w for all. In a text of weight W
    the smallest c / z is hardly ever above ``_ENOUGH`` / W: what cannot be below by its first 32 bits (a's and
    r - g's first 16) is left out, and where nothing is below, all of the text's shingles are looked at. The choice of
    ``usual`` changes the draws, not their law: it must be one for all texts that are compared.
    """
    k = bands * rows
    seeds = mix(np.arange(1, k + 1, dtype=np.uint64) * _BASE)
    out = np.zeros((len(offsets) - 1, bands), np.uint64)
    low, sixteen, unit = np.uint32(0xFFFF), np.uint32(16), 2.0**-16
    space = np.empty((2, k * _BLOCK), np.uint32)

    def bits(seeds, high, low, space):
        """32 bits of each shingle (the halves of its hash) and sample."""
        z, more = space
        np.bitwise_xor(high, seeds, out=z)
        for i, (factor, shift) in enumerate(_STIR):
            if i == 1:
                z ^= low
            z *= factor
            np.right_shift(z, shift, out=more)
            z ^= more
        return z

    for first, end in runs_of(offsets, _RUN):
        cut, n = offsets[first : end + 1] - offsets[first], end - first
        h, w = hashes[offsets[first] : offsets[end]], weights[offsets[first] : offsets[end]]
        if not len(h):
            continue
        size = np.diff(cut)
        own = np.repeat(np.arange(n), size)
        whole = np.bincount(own, w, n)
        halves = (h >> np.uint64(32)).astype(np.uint32), h.astype(np.uint32)
        most = _ENOUGH / whole[own]
        best, which, ts = np.full(n * k, np.inf), np.zeros(n * k, np.int64), np.zeros(n * k, np.int64)

        def settle(j, x):
            """Samples j of shingles x, as they are in full."""
            z = bits(seeds[j].astype(np.uint32), halves[0][x], halves[1][x], np.empty((2, len(x)), np.uint32))
            more = mix(h[x] ^ seeds[j])
            fine = (more & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            a = -np.log1p(-((z >> sixteen) + ((fine >> sixteen) + 0.5) * unit) * unit)
            rest = -np.log(((z & low) + ((fine & low) + 0.5) * unit) * unit)
            g = np.log1p(-np.log(((more >> np.uint64(32)) + 0.5) * 2.0**-32) / a)
            t = np.floor((np.log(w[x] / usual) - g) / (g + rest)) + 1
            value = np.log(a / usual) - (g + rest) * t
            at = own[x] * k + j
            np.minimum.at(best, at, value)
            hit = np.flatnonzero(value == best[at])[::-1]
            which[at[hit]], ts[at[hit]] = x[hit], t[hit]

        with np.errstate(over="ignore"):
            found = []
            for heavy in (False, True):
                columns = np.flatnonzero((w > usual) == heavy)
                limit = (most * w * 2.0**32).astype(np.float32) if heavy else (np.minimum(-np.expm1(-most * usual) * 2.0**16, 65535).astype(np.uint32) << sixteen) | low
                for s in range(0, len(columns), _BLOCK):
                    x = columns[s : s + _BLOCK]
                    z = bits(seeds.astype(np.uint32)[:, None], halves[0][x], halves[1][x], space[:, : k * len(x)].reshape(2, k, len(x)))
                    near = (z >> sixteen).astype(np.float32) * (z & low).astype(np.float32) <= limit[x] if heavy else z <= limit[x]
                    j, at = np.divmod(np.flatnonzero(near), len(x))
                    found.append((j, x[at]))
            settle(*(np.concatenate(y) for y in zip(*found, strict=True)))
            # A little below the bound, for what rounding may have left out.
            i, j = np.nonzero((np.exp(best.reshape(n, k)) > 0.999 * _ENOUGH / np.maximum(whole, 1e-300)[:, None]) & (size > 0)[:, None])
            if len(i):
                settle(np.repeat(j, size[i]), ranges(cut[i], size[i]))
            samples = mix(h[which] + ts.view(np.uint64) * _BASE).reshape(n, bands, rows)
            made = np.zeros((n, bands), np.uint64)
            for row in range(rows):
                made = mix(made * _BASE + samples[:, :, row])
        made[size == 0] = 0
        out[first:end] = made
    return out
