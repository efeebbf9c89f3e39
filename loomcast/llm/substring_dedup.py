"""Operator 7: removal of repeated substrings by a depth-limited radix sort of suffixes.

A suffix counts only through its first ``depth`` bytes (its window). All suffixes can't be moved: at 8 bytes each they
would outweigh the text many times over. So suffixes are grouped by an anchor first: the leftmost position of smallest
hash among the ``gram``-byte substrings of the window. Equal windows have equal anchors at equal offsets, and about one
position in 35 is an anchor. Windows whose anchor's bytes occur once in the corpus can't repeat and are done.

The rest go to tasks by anchor hash, as segments around anchors, and are sorted there: passes over 8-byte digits, most
significant first, each pass splitting only groups of two or more, through ``depth`` bytes. Equal groups that remain are
exactly the repeated windows; all but the earliest of a group (smaller document, then earlier start) are removed.

Groups of copies and shared passages of any size: a map task sends each anchor hash once, and segments that are alike
once (the others it holds repeat its earliest one, and are decided there). So a hash arrives at most once from a task, and
a segment likewise.

Defined cases: null and empty texts have no bytes. A null doc_id sorts after all others. Rows alike in doc_id and text are
one document (neither repeats the other) and come back as often as they occur; rows that share only doc_id are ordered by
a hash of their text. Texts under ``depth`` bytes stay whole. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, order_within, parts_of, ranges, slices, text_bytes

DEPTH, GRAM = 100, 32
#: Anchors that a map task compares among themselves before it sends them on, and windows that are sorted at a time.
HELD_ANCHORS, SORTED_WINDOWS = 1 << 21, 1 << 20


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` (a power of two) bytes from each position on, where they all exist."""
    h = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64)[data]
    base, width = np.uint64(0x9E3779B97F4A7C15), 1
    while width < gram:
        h = h[:-width] * base + h[width:] if len(h) > width else h[:0]
        base, width = base * base, width * 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, gram: int = GRAM):
    """(position, hash, first window start, last window start) of each anchor, positions in ``data``, ascending."""
    none = np.zeros(0, np.int64)
    width = depth - gram + 1  # grams of a window
    with np.errstate(over="ignore"):
        h = gram_hashes(data, gram)
    if len(h) < width:
        return none, np.zeros(0, np.uint64), none, none
    best, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        right = best[step:]
        left, n = best[: len(right)], len(right)
        take = right < left
        at = np.where(take, at[step:], at[:n])
        best = np.where(take, right, left)
        span += step
    size = np.maximum(np.diff(offsets) - depth + 1, 0)
    starts = ranges(offsets[:-1], size)  # of windows within one text
    owner = np.repeat(np.arange(len(size)), size)
    pick = at[starts]
    if not len(pick):
        return none, np.zeros(0, np.uint64), none, none
    change = np.flatnonzero((pick[1:] != pick[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate([[0], change])
    last = np.append(change, len(pick)) - 1
    position = pick[first].astype(np.int64)
    return position, h[position], starts[first], starts[last]


def shared_positions(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """(_row, pos): anchors whose bytes occur more than once, by a hash of doc_id and text."""

    def run(only_known: bool):
        def emit(rows, pos, h):
            if not rows:
                return None
            rows, pos, h = np.concatenate(rows), np.concatenate(pos), np.concatenate(h)
            order = np.argsort(h)
            s = h[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            if only_known:
                same[:-1] |= same[1:]
                pick = order[same]
            else:
                pick = order[~same]
            return pa.RecordBatch.from_arrays([pa.array(h[pick].view(np.int64)), pa.array(rows[pick]), pa.array(pos[pick].astype(np.int32))], names=["h", "_row", "pos"])

        def each(batches):
            rows, pos, hashes, n = [], [], [], 0
            for batch in batches:
                keys = batch.column(0).to_numpy()
                for first, end, data, offsets in slices(batch.column(1)):
                    p, h, _, _ = anchors(data, offsets, depth, gram)
                    own = np.searchsorted(offsets, p, "right") - 1
                    rows.append(keys[first:end][own])
                    pos.append(p - offsets[own])
                    hashes.append(h)
                    n += len(p)
                    if n >= HELD_ANCHORS:
                        yield emit(rows, pos, hashes)
                        rows, pos, hashes, n = [], [], [], 0
            if n:
                yield emit(rows, pos, hashes)

        return each

    texts = docs.select("_row", "_text")
    schema = "h bigint, _row bigint, pos int"
    # What a task meets twice is shared for certain; each task sends a hash once to be compared with the other tasks'.
    known = texts.mapInArrow(run(True), schema).select("_row", "pos")
    once = texts.mapInArrow(run(False), schema).repartition(parts_of(docs), "h").sortWithinPartitions("h")

    def met_again(batches):
        """Rows in order of h go by; the last one of a batch waits for the next unless it is settled."""
        last, waiting = None, None
        for batch in batches:
            h = batch.column(0).to_numpy()
            if not len(h):
                continue
            same = np.concatenate([[last is not None and h[0] == last], h[1:] == h[:-1]])
            if same[0] and waiting is not None:
                yield waiting
            shared = same.copy()
            shared[:-1] |= same[1:]
            rows = batch.select(["_row", "pos"])
            yield rows.filter(pa.array(shared))
            last, waiting = h[-1], None if shared[-1] else rows.slice(len(h) - 1, 1)

    return known.unionByName(once.mapInArrow(met_again, "_row bigint, pos int"))


def repeated(buffer: np.ndarray, starts: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """True for each window that equals one before it in ``starts``: most-significant-digit passes by 8 bytes."""
    out = np.zeros(len(starts), bool)
    v = np.concatenate([buffer, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        v = (v[:-width] << np.uint64(8 * width)) | v[width:]
    digits = [*range(0, depth - 7, 8)]
    if digits[-1] != depth - 8:
        digits.append(depth - 8)
    first = v[starts]
    order = np.argsort(first)
    new = np.ones(len(order), bool)
    new[1:] = first[order][1:] != first[order][:-1]

    def compact(order, new):
        """Without the groups of one."""
        alone = new & np.append(new[1:], True)
        return order[~alone], new[~alone]

    order, new = compact(order, new)
    for j in digits[1:]:
        if not len(order):
            break
        d = v[starts[order] + j]
        group = np.cumsum(new) - 1
        differs = np.zeros(len(order), bool)
        differs[1:] = (d[1:] != d[:-1]) & ~new[1:]
        if differs.any():
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[differs]] = True
            inside = np.flatnonzero(mixed[group])
            sort = order_within(np.cumsum(np.diff(group[inside], prepend=group[inside[0]]) != 0), d[inside])
            order[inside], d[inside] = order[inside][sort], d[inside][sort]
            new[1:] |= d[1:] != d[:-1]
            order, new = compact(order, new)
    if len(order):  # of each group, all but the earliest
        head = np.flatnonzero(new)
        out[order] = True
        out[np.minimum.reduceat(order, head)] = False
    return out


def later_copies(docs: DataFrame, doc: str, depth: int) -> DataFrame:
    """_row of each document whose whole text an earlier one has: all of it repeats."""
    long = docs.filter(F.octet_length("_text") >= depth)
    named = long.select(_order(doc), "_row", F.xxhash64("_text").alias("_t"), F.xxhash64(F.lit(1), F.col("_text")).alias("_t2"))
    first = named.groupBy("_t", "_t2").agg(F.min(F.struct("_doc", "_row")).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    return named.join(first, ["_t", "_t2"]).filter(F.struct("_doc", "_row") > F.col("_first")).select("_row").distinct()


def _order(doc: str):
    return F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)).alias("_doc")


def removed_ranges(docs: DataFrame, doc: str, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """(_row, _doc, start, stop): byte ranges to remove; they may overlap. ``docs``: ``doc``, _row, _text."""
    parts = parts_of(docs)
    copies = later_copies(docs, doc, depth).withColumn("_copy", F.lit(True))
    at = shared_positions(docs, depth, gram).groupBy("_row").agg(F.collect_set("pos").alias("_at")).join(copies, "_row", "left")
    at = at.select("_row", F.when(F.col("_copy"), F.array().cast("array<int>")).otherwise(F.col("_at")).alias("_at"), F.coalesce("_copy", F.lit(False)).alias("_copy"))
    texts = docs.join(at, "_row").select(_order(doc), "_row", "_text", "_at", "_copy")

    def batch_of(key, who, row, start, more, segment):
        columns = [pa.array(key), pa.array(who), pa.array(row), pa.array(start.astype(np.int32)), pa.array(more.astype(np.int32)), segment]
        return pa.RecordBatch.from_arrays(columns, names=["key", "_doc", "_row", "start", "more", "segment"])

    def decided(who, row, start, more):
        return batch_of(row, who, row, start, more, pa.nulls(len(row), pa.binary()))

    def cut(batches):
        done = set()
        known: dict = {}
        for batch in batches:
            doc, row, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            flat, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            bounds = bounds - bounds[0]
            copy = batch.column(4).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in slices(batch.column(2)):
                whole = np.flatnonzero(copy[first:end])
                if len(whole):
                    yield decided(doc[first + whole], row[first + whole], np.zeros(len(whole), np.int64), np.diff(offsets)[whole] - depth)
                p, h, lo, hi = anchors(data, offsets, depth, gram)
                own = np.searchsorted(offsets, p, "right") - 1
                wanted = flat[bounds[first] : bounds[end]].astype(np.int64) + np.repeat(offsets[:-1], np.diff(bounds[first : end + 1]))
                keep = np.isin(p, wanted)
                fresh = np.ones(end - first, bool)  # rows alike in doc_id and text are one document
                for i in range(end - first):
                    name = (int(doc[first + i]), int(row[first + i]))
                    fresh[i] = name not in done
                    done.add(name)
                keep &= fresh[own]
                p, h, lo, hi, own = (x[keep] for x in (p, h, lo, hi, own))
                rank = np.empty(end - first, np.int64)  # of the slice's texts, by document
                rank[np.lexsort((row[first:end], doc[first:end]))] = np.arange(end - first)
                order = np.argsort(rank[own] << 32 | p)
                p, h, lo, hi, own = (x[order] for x in (p, h, lo, hi, own))
                raw = data.tobytes()
                segments = [raw[a : b + depth] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                # Alike segments of this task: the earliest is sent, the others repeat it.
                sent = np.ones(len(p), bool)
                names = list(zip(doc[first:end][own].tolist(), row[first:end][own].tolist(), (lo - offsets[own]).tolist(), strict=True))
                for k, (key, segment, name) in enumerate(zip(h.tolist(), segments, names, strict=True)):
                    mark = (key, hashlib.blake2b(segment, digest_size=16).digest())
                    before = known.get(mark)
                    if before is None:
                        known[mark] = name
                    elif before < name:
                        sent[k] = False
                    else:  # a slice that came earlier holds a later document, which was sent already; so is this one
                        known[mark] = name
                if len(known) > 400_000:
                    known.clear()
                start = lo - offsets[own]
                who, key = doc[first:end][own], row[first:end][own]
                late = np.flatnonzero(~sent)
                if len(late):  # ranges of one document that follow each other become one
                    late = late[np.lexsort((start[late], own[late]))]
                    new = np.ones(len(late), bool)
                    new[1:] = (own[late[1:]] != own[late[:-1]]) | (lo[late[1:]] != hi[late[:-1]] + 1)
                    tail = late[np.append(new[1:], True)]
                    late = late[new]
                    yield decided(who[late], key[late], start[late], hi[tail] - lo[late])
                go = np.flatnonzero(sent)
                yield batch_of(h.view(np.int64)[go], who[go], key[go], start[go], (hi - lo)[go], pa.array([segments[i] for i in go.tolist()], pa.binary()))

    schema = "key bigint, _doc bigint, _row bigint, start int, more int, segment binary"
    # Segments of one key follow each other, in order of document and start; the task holds a run of whole keys at a time.
    sent = texts.mapInArrow(cut, schema).repartition(parts, "key").sortWithinPartitions("key", "_doc", "_row", "start")

    def give(doc, row, start, stop):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(row), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["_doc", "_row", "start", "stop"])

    def repeats(doc, row, start, more, segments):
        """Ranges of ``segments``, in order of document, that repeat an earlier one's bytes."""
        data = text_bytes(segments)[0]
        count = more.astype(np.int64) + 1
        begin = np.cumsum(count + depth - 1) - (count + depth - 1)
        k = np.flatnonzero(repeated(data, ranges(begin, count), depth))
        if len(k):
            own = np.repeat(np.arange(len(count)), count)
            step = ranges(np.zeros(len(count)), count)
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1] + 1) | (own[k[1:]] != own[k[:-1]])
            a, b = k[new], k[np.append(new[1:], True)]
            yield give(doc[own[a]], row[own[a]], start[own[a]] + step[a], start[own[a]] + step[b] + depth)

    def sort(batches):
        held, windows, last = [], 0, None

        def done():
            columns = [pa.concat_arrays(c) for c in zip(*held, strict=True)]
            held.clear()
            yield from repeats(*(c.to_numpy() for c in columns[:4]), columns[4])

        for batch in batches:
            _, who, row, start, more, segment = batch.columns
            settled = np.flatnonzero(segment.is_null().to_numpy(zero_copy_only=False))
            if len(settled):
                d, r, a, n = (c.to_numpy()[settled] for c in (who, row, start, more))
                yield give(d, r, a, a + n + depth)
            part = batch.filter(segment.is_valid())
            key = part.column(0).to_numpy()
            if not len(key):
                continue
            change = np.flatnonzero(np.concatenate([[last is not None and key[0] != last], key[1:] != key[:-1]]))
            total = np.cumsum(part.column(4).to_numpy().astype(np.int64) + 1)
            at = 0
            while at < len(key):  # up to the first change of key at which there are enough windows
                before = int(total[at - 1]) if at else 0
                enough = at if windows >= SORTED_WINDOWS else int(np.searchsorted(total, before + SORTED_WINDOWS - windows)) + 1
                k = int(np.searchsorted(change, enough))
                stop = int(change[k]) if k < len(change) else len(key)
                if stop > at:
                    held.append([c.slice(at, stop - at) for c in part.columns[1:]])
                    windows += int(total[stop - 1]) - before
                if k < len(change):
                    yield from done()
                    windows = 0
                at = stop
            last = key[-1]
        if held:
            yield from done()

    return sent.mapInArrow(sort, "_doc bigint, _row bigint, start int, stop int")


def dedup(df: DataFrame, depth: int = DEPTH, gram: int = GRAM, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary: the bytes that stay) for each row."""
    docs = df.select(F.col(doc), F.xxhash64(doc, text).alias("_row"), F.col(text).alias("_text"))
    marks = removed_ranges(docs, doc, depth, gram).groupBy("_row").agg(F.collect_list(F.struct("_doc", "start", "stop")).alias("_cut"))
    # Joined on the same key as before, so that the shuffled texts are used again.
    own = F.filter("_cut", lambda c: c["_doc"] == F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)))
    joined = docs.join(marks, "_row", "left").select(doc, "_text", own.alias("_cut"))

    def keep(batches):
        for batch in batches:
            lists = batch.column(2)
            for first, end, data, offsets in slices(batch.column(1)):
                # +1 where a range starts and -1 where it stops; bytes under a sum of 0 stay
                edge = np.zeros(len(data) + 1, np.int32)
                cuts = lists.slice(first, end - first)
                flat = cuts.flatten()
                own = np.repeat(np.arange(end - first), [0 if x is None else x for x in cuts.value_lengths().to_pylist()])
                np.add.at(edge, flat.field("start").to_numpy() + offsets[own], 1)
                np.add.at(edge, flat.field("stop").to_numpy() + offsets[own], -1)
                gone = np.cumsum(edge[:-1]) > 0
                total = np.concatenate([[0], np.cumsum(gone)])
                runs = gone.copy()
                runs[1:] &= ~gone[:-1]
                head = offsets[:-1][np.diff(offsets) > 0]
                runs[head] = gone[head]
                spans = np.concatenate([[0], np.cumsum(runs)])
                removed = np.diff(total[offsets])
                stay = offsets - total[offsets]
                kept = data[~gone]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(np.diff(offsets)), pa.array(removed), pa.array(np.diff(spans[offsets])),
                     pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(stay.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])],
                    names=[doc, "n_bytes", "n_removed", "n_spans", "kept"],
                )

    kind = dict(df.dtypes)[doc]
    return joined.mapInArrow(keep, f"`{doc}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
