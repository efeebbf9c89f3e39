"""Byte-level BPE by a rank queue under a hierarchical bitmap, and back to bytes.

``RankQueue`` keeps one bucket for each merge rank; a bucket holds positions in linked lists of symbols. Three levels of
64-bit words mark the buckets that have entries, so that find-first-set on three words gives the lowest rank. Entries
are never removed when a merge makes them invalid; they are skipped when their bucket comes up (the pair that now starts
at the position has another rank). All pre-tokens of a batch share the queue: merges of different pre-tokens don't
touch, so that a bucket is merged with array operations over all of them, leftmost first where pairs overlap. A merge may
make a pair of lower rank than its own, which then comes before the pre-token's other pairs of the bucket. These wait if
the pre-token is short; a longer one (over ``LONG`` bytes) goes on by itself, one merge at a time, through a queue of the same kind
whose buckets are heaps of positions (:func:`merge_one`). So the work grows with bytes and merges, times a logarithm at
most, also for a pre-token of megabytes.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import ranges, runs_of, text_bytes
from .pretokens import pieces

#: Bytes of a pre-token from which it is merged by itself once a merge has made a pair of lower rank.
LONG = 64
#: Bytes of text taken apart at a time, and tokens looked up at a time: both take tens of bytes of scratch for each.
PART_BYTES, PART_TOKENS = 1 << 20, 1 << 18


class Vocabulary:
    """The bytes of all tokens, by id."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths


class Ranks(Vocabulary):
    """A vocabulary by rank: the rank of a token is its id, and a pair's rank is that of its concatenation."""

    def __init__(self, tokens: list[bytes]):
        super().__init__(tokens)
        self.tokens, self.rank = tokens, {t: i for i, t in enumerate(tokens)}
        self.size = len(tokens)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        keys, values, early = [], [], set()
        for t, r in self.rank.items():
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    values.append(r)
                    early.update(x for x in (a, b) if x > r)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]
        #: Tokens that can form a pair of lower rank than their own: after such a merge the queue has to look back at once.
        self.early = frozenset(early)
        small = self.byte[:, None].astype(np.int64) * self.size + self.byte[None, :]
        self.byte_pair = self.pair(small.ravel()).reshape(256, 256)

    def pair_rank(self, key: int) -> int:
        """Rank of one pair ``left * size + right``; -1 if it has none."""
        return self.rank.get(self.tokens[key // self.size] + self.tokens[key % self.size], -1)

    def pair(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair ``left * size + right``; -1 where it has none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.int32(-1))


def tokens_in(path: str) -> list[bytes]:
    """Reads a rank file: a line for each token, base64 and rank, ranks gapless from 0."""
    with open(path, "rb") as f:
        found = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in f if line.strip()))
    if [r for r, _ in found] != list(range(len(found))):
        raise ValueError("ranks must be gapless from 0")
    return [t for _, t in found]


@lru_cache(maxsize=4)
def ranks_of(path: str) -> Ranks:
    return Ranks(tokens_in(path))


@lru_cache(maxsize=4)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(tokens_in(path))


class RankQueue:
    """Buckets by rank, with a three-level bitmap over the buckets."""

    def __init__(self):
        self.buckets: dict[int, list] = {}
        self.low: dict[int, int] = {}
        self.mid: dict[int, int] = {}
        self.top = 0

    def bucket(self, r: int) -> list:
        """The bucket of rank ``r``, opened if it is not there."""
        found = self.buckets.get(r)
        if found is None:
            found = self.buckets[r] = []
            word, block = r >> 6, r >> 12
            self.low[word] = self.low.get(word, 0) | 1 << (r & 63)
            self.mid[block] = self.mid.get(block, 0) | 1 << (word & 63)
            self.top |= 1 << block
        return found

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        if not len(positions):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cut = np.flatnonzero(np.diff(ranks)) + 1
        edges = [0, *cut.tolist(), len(ranks)]
        for r, a, b in zip(ranks[edges[:-1]].tolist(), edges, edges[1:], strict=False):
            self.bucket(r).append(positions[a:b])

    def lowest(self) -> int | None:
        """The lowest rank that has a bucket."""
        if not self.top:
            return None
        block = (self.top & -self.top).bit_length() - 1
        bits = self.mid[block]
        word = block << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def close(self, r: int) -> list:
        """Takes the bucket of rank ``r`` out."""
        word, block = r >> 6, r >> 12
        self.low[word] &= ~(1 << (r & 63))
        if not self.low[word]:
            self.mid[block] &= ~(1 << (word & 63))
            if not self.mid[block]:
                self.top &= ~(1 << block)
        return self.buckets.pop(r)


def merge_one(ranks: Ranks, symbol: list[int], pair: list[int]) -> list[int]:
    """The tokens of one pre-token, merged pair by pair: lowest rank first, then leftmost. ``pair``: rank of the pair that
    starts at each symbol, -1 where it has none."""
    n, size, find = len(symbol), ranks.size, ranks.pair_rank
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    queue = RankQueue()
    for i, r in enumerate(pair):
        if r >= 0:
            queue.bucket(r).append(i)  # ascending, so that each bucket is a heap
    while (r := queue.lowest()) is not None:
        heap = queue.buckets[r]
        while heap:
            i = heapq.heappop(heap)
            if pair[i] != r:
                continue  # stale
            gone = after[i]
            then, prior = after[gone], before[i]
            symbol[i], symbol[gone], pair[gone] = r, -1, -1
            after[i] = then
            pair[i] = -1 if then < 0 else find(r * size + symbol[then])
            if then >= 0:
                before[then] = i
            lower = False
            for k in (i, prior):
                if k == prior:
                    if prior < 0:
                        break
                    pair[k] = find(symbol[k] * size + r)
                new = pair[k]
                if new >= 0:
                    heapq.heappush(queue.bucket(new), k)
                    lower |= new < r
            if lower:
                break
        if not heap:
            queue.close(r)
    return [s for s in symbol if s >= 0]


def merge_all(ranks: Ranks, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens, concatenated, and n + 1 offsets. ``data`` holds their bytes, cut at ``offsets``."""
    n = len(data)
    symbol = ranks.byte[data]
    after = np.arange(1, n + 1, dtype=np.int64)
    before = np.arange(-1, n - 1, dtype=np.int64)
    after[offsets[1:][np.diff(offsets) > 0] - 1] = -1
    before[offsets[:-1][np.diff(offsets) > 0]] = -1
    alive = np.ones(n, bool)
    pair = np.full(n, -1, np.int32)  # rank of the pair that starts here
    open_ = np.flatnonzero(after >= 0)
    pair[open_] = ranks.byte_pair[data[open_], data[np.minimum(open_ + 1, n - 1)]]
    queue = RankQueue()
    first = np.flatnonzero(pair >= 0)
    queue.push(first, pair[first])

    def rank_of(left, right):
        """Rank of each pair of symbols; none where either is missing (-1)."""
        return np.where((left >= 0) & (right >= 0), ranks.pair(left.astype(np.int64) * ranks.size + right), np.int32(-1))

    def before_lower(at, r):
        """Those of ``at`` that are merged before a pair of lower rank comes up in their pre-token."""
        gone = after[at]
        prior = before[at]
        # What stands to the left has been merged already if the pair before ends there.
        merged = np.zeros(len(at), bool)
        merged[1:] = gone[:-1] == prior[1:]
        left = np.where(merged, r, np.where(prior >= 0, symbol[prior], -1))
        right = np.where(after[gone] >= 0, symbol[after[gone]], -1)
        made = np.stack([rank_of(left, np.full(len(at), r)), rank_of(np.full(len(at), r), right)])
        lower = ((made >= 0) & (made < r)).any(0)
        if not lower.any():
            return at
        own = np.searchsorted(offsets, at, "right") - 1
        hit = np.flatnonzero(lower)
        texts, one = np.unique(own[hit], return_index=True)
        stop = np.full(len(offsets), n, np.int64)  # of each pre-token: the leftmost merge that makes a lower pair
        stop[texts] = at[hit[one]]
        return at[at <= stop[own]]

    while (r := queue.lowest()) is not None:
        found = queue.close(r)
        at = found[0] if len(found) == 1 else np.concatenate(found)
        at = at[pair[at] == r]  # the rest is stale
        if not len(at):
            continue
        if len(at) > 1:
            at = np.sort(at)
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        every = at
        if len(at) > 1:  # of pairs that overlap, every other one
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            if chained.any():
                k = np.arange(len(at))
                at = at[((k - np.maximum.accumulate(np.where(chained, 0, k))) & 1) == 0]
        if r in ranks.early:
            now = before_lower(at, r)
            if len(now) < len(at):
                wait = np.setdiff1d(every, now, assume_unique=True)
                own = np.searchsorted(offsets, wait, "right") - 1
                long = np.unique(own[offsets[own + 1] - offsets[own] > LONG])
                for k in long.tolist():
                    a, b = int(offsets[k]), int(offsets[k + 1])
                    live = a + np.flatnonzero(alive[a:b])
                    ids = merge_one(ranks, symbol[live].tolist(), pair[live].tolist())
                    alive[a:b], pair[a:b] = False, -1
                    alive[a : a + len(ids)] = True
                    symbol[a : a + len(ids)] = ids
                at = now[pair[now] == r]
                wait = wait[pair[wait] == r]
                queue.push(wait, pair[wait])
                if not len(at):
                    continue
            else:
                at = now
        gone = after[at]
        then = after[gone]
        symbol[at] = r
        alive[gone] = False
        pair[gone] = -1
        after[at] = then
        before[then[then >= 0]] = at[then >= 0]
        prior = before[at]
        left = np.concatenate([at[then >= 0], prior[prior >= 0]])
        pair[at] = -1
        if len(left):
            right = after[left]
            new = ranks.pair(symbol[left].astype(np.int64) * ranks.size + symbol[right])
            pair[left] = new
            some = new >= 0
            queue.push(left[some], new[some])
    counts = np.concatenate([[0], np.cumsum(alive)])
    return symbol[alive], counts[offsets]


class Memo:
    """Ids of the pre-tokens met so far in this Python worker, in flat arrays: found by a hash, compared byte by byte.

    It only saves work: a pre-token that it lacks is encoded. One over ``longest`` bytes is not kept; at ``most`` pre-tokens
    it starts afresh. Both bound its memory (about 100 bytes for each), whatever the texts are like.
    """

    #: A random number for each byte at each place; a word's hash is their sum.
    PLACES = 64
    TABLE = np.random.default_rng(7).integers(0, 1 << 64, (PLACES, 256), np.uint64)

    def __init__(self, encode, most: int = 1_000_000, longest: int = PLACES):
        self.encode, self.most, self.longest = encode, most, min(longest, self.PLACES)
        self.clear()

    def clear(self) -> None:
        self.key, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # ascending by key
        self.rows = self.text_used = self.used = 0
        self.text, self.start, self.size = np.zeros(1 << 14, np.uint8), np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.uint8)
        self.flat, self.begin, self.length = np.zeros(1 << 14, np.int32), np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.uint8)

    def known(self, data: np.ndarray, offsets: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Row of each word; -1 of those that are not kept."""
        row = np.full(len(key), -1, np.int64)
        if not self.rows:
            return row
        at = np.minimum(np.searchsorted(self.key, key), self.rows - 1)
        same = np.flatnonzero(self.key[at] == key)
        found = self.row[at[same]]
        fits = self.size[found] == size[same]
        same, found = same[fits], found[fits]
        if len(same):
            n = size[same]
            differs = data[ranges(offsets[same], n)] != self.text[ranges(self.start[found], n)]
            equal = ~np.logical_or.reduceat(differs, np.cumsum(n) - n)
            row[same[equal]] = found[equal]
        return row

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(begin, length) in ``flat`` of each of the distinct non-empty ``words``; good until the next call."""
        if self.rows > self.most:
            self.clear()
        elif len(self.flat) > 8 * self.most:  # what a very long pre-token took
            self.flat = self.flat[: self.used].copy()
        data, offsets = text_bytes(words)
        size = np.diff(offsets)
        short = np.flatnonzero(size <= self.longest)
        key = np.zeros(len(size), np.uint64)
        if len(short):
            n = size[short]
            bytes_ = data if len(short) == len(size) else data[ranges(offsets[short], n)]
            key[short] = np.add.reduceat(self.TABLE.ravel()[ranges(np.zeros(len(n), np.int64), n) * 256 + bytes_], np.cumsum(n) - n)
        row = np.full(len(size), -1, np.int64)
        row[short] = self.known(data, offsets[short], n, key[short]) if len(short) else -1
        begin, length = self.begin[row].astype(np.int64), self.length[row].astype(np.int64)
        miss = np.flatnonzero(row < 0)
        if len(miss):
            miss = miss[np.argsort(size[miss] > self.longest, kind="stable")]  # those to keep come first
            n = size[miss]
            raw = data[ranges(offsets[miss], n)]
            ids, cut = self.encode(raw, np.concatenate([[0], np.cumsum(n)]))
            self.flat = self.room(self.flat, self.used + len(ids))
            self.flat[self.used : self.used + len(ids)] = ids
            begin[miss], length[miss] = self.used + cut[:-1], np.diff(cut)
            kept = int((n <= self.longest).sum())
            self.keep(key[miss[:kept]], raw[: int(n[:kept].sum())], n[:kept], begin[miss[:kept]], length[miss[:kept]])
            self.used += int(cut[kept])
        return begin, length

    def keep(self, key: np.ndarray, raw: np.ndarray, size: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        """Adds words; of those that share a hash, one."""
        if not len(key):
            return
        new, one = np.unique(key, return_index=True)
        at = np.searchsorted(self.key, new)
        fresh = np.ones(len(new), bool) if not self.rows else self.key[np.minimum(at, self.rows - 1)] != new
        first, last = self.rows, self.rows + int(fresh.sum())
        one, n = one[fresh], size[one[fresh]]
        self.key, self.row = np.insert(self.key, at[fresh], new[fresh]), np.insert(self.row, at[fresh], np.arange(first, last))
        self.text = self.room(self.text, self.text_used + int(n.sum()))
        self.text[self.text_used : self.text_used + int(n.sum())] = raw[ranges((np.cumsum(size) - size)[one], n)]
        for name, values in (("start", self.text_used + np.cumsum(n) - n), ("size", n), ("begin", begin[one]), ("length", length[one])):
            array = self.room(getattr(self, name), last)
            array[first:last] = values
            setattr(self, name, array)
        self.rows, self.text_used = last, self.text_used + int(n.sum())

    @staticmethod
    def room(array: np.ndarray, n: int) -> np.ndarray:
        """``array`` with room for ``n``."""
        return array if n <= len(array) else np.concatenate([array, np.zeros(max(len(array) // 2, n - len(array)), array.dtype)])

    def ids(self, data: np.ndarray, offsets: np.ndarray, split=pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, concatenated, and their n + 1 offsets.

        Texts are taken apart some at a time, so that scratch arrays don't grow with all of them; the words that they
        have between them are found, and those not yet known encoded, at once.
        """
        total, parts = np.zeros(len(offsets), np.int64), []
        for first, end in runs_of(offsets, PART_BYTES):
            words, bounds = split(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
            if len(words):
                coded = words.dictionary_encode()
                parts.append((first, end, bounds, coded.indices.to_numpy(), coded.dictionary))
        if not parts:
            return np.zeros(0, np.int32), total
        sizes = [len(p[-1]) for p in parts]
        coded = pa.concat_arrays([p[-1] for p in parts]).dictionary_encode()
        parts = [p[:-1] for p in parts]
        begin, length = self.find(coded.dictionary)
        own = np.split(coded.indices.to_numpy(), np.cumsum(sizes)[:-1])
        for (first, end, bounds, which), row in zip(parts, own, strict=True):
            cut = np.concatenate([[0], np.cumsum(length[row][which])])
            total[first + 1 : end + 1] = np.diff(cut[bounds])
        np.cumsum(total, out=total)
        out, used = np.empty(total[-1], np.int32), 0
        for (_, _, _, which), row in zip(parts, own, strict=True):
            for at in range(0, len(which), PART_TOKENS):
                some = row[which[at : at + PART_TOKENS]]
                made = self.flat[ranges(begin[some], length[some])]
                out[used : used + len(made)] = made
                used += len(made)
        return out, total


@lru_cache(maxsize=4)
def memo_of(path: str) -> Memo:
    """The worker's memo for a rank file. A pre-token that is a token as a whole is that token."""
    ranks = ranks_of(path)

    def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, cut = data.tobytes(), offsets.tolist()
        whole = np.fromiter((ranks.rank.get(raw[a:b], -1) for a, b in zip(cut, cut[1:], strict=False)), np.int32, len(cut) - 1)
        todo = np.flatnonzero(whole < 0)
        size = offsets[todo + 1] - offsets[todo]
        ids, own = merge_all(ranks, data[ranges(offsets[todo], size)], np.concatenate([[0], np.cumsum(size)]))
        count = np.ones(len(whole), np.int64)
        count[todo] = np.diff(own)
        out = np.concatenate([[0], np.cumsum(count)])
        flat = np.empty(out[-1], np.int32)
        flat[out[:-1][whole >= 0]] = whole[whole >= 0]
        flat[ranges(out[todo], count[todo])] = ids
        return flat, out

    return Memo(encode)


def decode(ranks: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the token sequences cut at ``offsets``, and their own n + 1 offsets."""
    total = np.concatenate([[0], np.cumsum(ranks.lengths[ids])])
    out = np.empty(total[-1], np.uint8)
    for at in range(0, len(ids), PART_TOKENS):
        some = ids[at : at + PART_TOKENS]
        out[total[at] : total[at + len(some)]] = ranks.flat[ranges(ranks.starts[some], ranks.lengths[some])]
    return out, total[offsets]
