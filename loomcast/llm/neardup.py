"""Operator 1: near-duplicate documents by weighted MinHash (improved consistent weighted sampling) over TF-IDF shingles.

1. Nodes. Documents of one sequence of words (by two independent 64-bit hashes) become one node, whatever their number; each
   task sends a node's text once. Nodes are dealt into chunks of about ``CHUNK_BYTES`` and stored by chunk.
2. Document frequencies are exact, for all shingles; weights tell them apart from ``shingles.FLOOR`` of all documents up. A chunk asks for its distinct shingles' frequencies, in one row for each
   range of hashes (sorted, as differences); a range adds up all chunks' counts and answers each in the same order. So a
   shingle comes once from a chunk, however many documents have it, and neither text nor keys travel with frequencies.
3. Samples. Each node gets ``bands`` hashes of ``rows`` weighted samples each.
4. Buckets. Nodes that share a band's hash are candidates. A first round compares every node with one leader of each of
   its buckets (that with most copies), the next with the others of its bucket, or, in buckets of more than ``wide``
   nodes, of a random part of about ``FEW``; only pairs of different classes are compared. So a round costs a bounded
   number of pairs for each node. Pairs are verified by exact weighted Jaccard similarity of the whole texts.
5. Wide buckets that still hold several classes are settled by a prefix join: at similarity s, two texts share a shingle
   among each one's rarest, before which at most the weight that s allows stands unshared. It finds all pairs across
   classes that can be similar and hardly any others; a shingle's largest class is compared with the other classes only.
6. Classes. Verified links make connected components (minimum labels and pointer jumps, each step a stored table). No
   link between different classes' candidates is left out.

Nothing of the corpus's size reaches the driver. Odds to miss a pair of similarity s are (1 - s**rows)**bands: 2e-4 at
0.8, 1e-5 at 0.85.

Defined cases: a null or empty text, or one without words, is a class of its own. Texts of 1 to 4 words have one shingle.
A class is named by its smallest doc_id; a null doc_id takes part and gets its class's name, null if it is alone. Repeated
rows come back repeated, in one class. A very long text is a chunk of its own, all of whose shingles count. Extra columns are not read by
:func:`near_duplicates` and pass through :func:`one_of_each`, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shingles as sh
from .common import delete, discard, documents, give_back, scratch, slices, split_count, stored

SIMILARITY, BANDS, ROWS = 0.8, 16, 4
#: Bytes of text of a chunk, of those whose shingles are added up in one task's group, and of a stored part of all chunks.
CHUNK_BYTES, RANGE_BYTES, PART_BYTES = 2 << 20, 16 << 20, 64 << 20
FEW = 3
#: Nodes that a task remembers to send each text and each count once.
HELD = 100_000


def nodes_of(docs: DataFrame) -> DataFrame:
    """(_doc, _row, node): the 16 bytes that name each row's sequence of words, null without words."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(2)):
                names, some = sh.fingerprints(data, offsets)
                node = pa.array([x.tobytes() if y else None for x, y in zip(names, some.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first), node], names=["_doc", "_row", "node"])

    return docs.select("_doc", "_row", "_text").mapInArrow(run, "_doc bigint, _row bigint, node binary")


def collapsed(docs: DataFrame) -> DataFrame:
    """(node, copies, _doc, _row, _text): rows alike in words as one where a task meets them, with the smallest (_doc, _row).

    ``_text`` is null in rows that only add copies to a node whose text the task has sent.
    """
    names = ["node", "copies", "_doc", "_row", "_text"]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])

    def run(batches):
        held: dict[bytes, list | None] = {}

        def more():
            rows = [(name, v[0], *v[1]) for name, v in held.items() if v]
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)), pa.nulls(len(rows), pa.string())], names=names)
            held.clear()

        for batch in batches:
            docs, rows, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for first, _, data, offsets in slices(texts):
                prints, some = sh.fingerprints(data, offsets)
                fresh = []
                for i in np.flatnonzero(some).tolist():
                    name, low = prints[i].tobytes(), (docs[first + i], rows[first + i])
                    if name not in held:
                        held[name] = None
                        fresh.append((i, name))
                    else:
                        n, least = held[name] or (0, low)
                        held[name] = [n + 1, min(low, least, key=order)]
                if fresh:
                    at = pa.array([first + i for i, _ in fresh])
                    yield pa.RecordBatch.from_arrays([pa.array([x for _, x in fresh], pa.binary()), pa.array([1] * len(fresh), pa.int64()), *(c.take(at) for c in batch.columns)], names=names)
                if len(held) > HELD:
                    yield from more()
        yield from more()
        give_back()

    return docs.select("_doc", "_row", "_text").mapInArrow(run, "node binary, copies bigint, _doc bigint, _row bigint, _text string")


class Chunks:
    """The nodes of a corpus, stored by chunk in as many buckets as tasks, so that work by chunk moves no text."""

    def __init__(self, docs: DataFrame, total_bytes: int):
        spark = docs.sparkSession
        self.parts = max(split_count(spark), -(-total_bytes // PART_BYTES))
        # These two follow the bytes alone: a chunk asks each range at most once.
        chunks = max(64, -(-total_bytes // CHUNK_BYTES))
        self.ranges = max(16, -(-total_bytes // RANGE_BYTES))
        dealt = collapsed(docs).withColumn("chunk", F.pmod(F.xxhash64("node"), F.lit(chunks))).repartition(self.parts, "chunk")
        first = F.min(F.struct(F.col("_doc").isNull(), "_doc", "_row")).alias("_first")
        nodes = dealt.groupBy("chunk", "node").agg(F.sum("copies").alias("copies"), first, F.max("_text").alias("_text"))
        self.spark, self.name, self.path = spark, f"loomcast_{uuid.uuid4().hex}", scratch(spark, "nodes")
        nodes.write.bucketBy(self.parts, "chunk").sortBy("chunk").option("path", self.path).option("compression", "zstd").format("parquet").saveAsTable(self.name)
        self.table = spark.table(self.name)

    def discard(self) -> None:
        self.spark.sql(f"drop table {self.name}")
        delete(self.spark, self.path)


def _differences(x: np.ndarray) -> bytes:
    """Ascending numbers as their differences, each in as many bytes as the largest needs (the first byte says how many)."""
    d = np.diff(x, prepend=np.uint64(0))
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return bytes([width]) + d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    width = raw[0]
    d = np.zeros((len(raw) // width, 8), np.uint8)
    d[:, :width] = np.frombuffer(raw, np.uint8)[1:].reshape(-1, width)
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64)


def _small(x: np.ndarray) -> bytes:
    """Counts in the narrowest type, named by the first byte."""
    kind = next(k for k in "BIQ" if not len(x) or x.max() <= np.iinfo(k).max)
    return kind.encode() + x.astype(kind).tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, chr(raw[0]), offset=1).astype(np.int64)


def chunk_shingles(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, hashes, counts, offsets) of each slice of ``texts``."""
    for first, _, data, offsets in slices(texts):
        yield first, *sh.shingles(data, offsets, size)


def distinct_of(table: pa.Table, size: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of each slice of a chunk; all distinct ones, ascending; the place among these of each; how many documents have each."""
    found = list(chunk_shingles(table.column("_text").combine_chunks(), size))
    copies = table.column("copies").to_numpy()
    every = np.concatenate([h for _, h, _, _ in found])
    times = np.concatenate([np.repeat(copies[first : first + len(cut) - 1], np.diff(cut)) for first, _, _, cut in found])
    order = np.argsort(every)
    every = every[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    head = np.flatnonzero(new)
    place = np.empty(len(every), np.int64)
    place[order] = np.cumsum(new) - 1
    return found, every[head], place, np.add.reduceat(times[order], head)


def frequencies(chunks: Chunks, size: int) -> DataFrame:
    """(chunk, range, dfs): document frequencies of each chunk's distinct shingles in that range of hashes, ascending by hash."""
    n = chunks.ranges
    edges = np.array([(k << 64) // n for k in range(1, n)], np.uint64)

    def ask(table: pa.Table) -> pa.Table:
        give_back()
        _, x, _, times = distinct_of(table, size)
        cut = np.concatenate([[0], np.searchsorted(x, edges), [len(x)]])
        some = np.flatnonzero(np.diff(cut))
        rows = [(int(k), _differences(x[cut[k] : cut[k + 1]]), _small(times[cut[k] : cut[k + 1]])) for k in some]
        which, numbers, counts = zip(*rows, strict=True)
        return pa.table([pa.array([table.column("chunk")[0].as_py()] * len(rows), pa.int64()), pa.array(which, pa.int32()), pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())], names=["chunk", "range", "xs", "times"])

    def answer(table: pa.Table) -> pa.Table:
        give_back()
        asked = [_numbers(x.as_py()) for x in table.column("xs")]
        each = np.array([len(x) for x in asked])
        x, times = np.concatenate(asked), np.concatenate([_counts(t.as_py()) for t in table.column("times")])
        del asked
        order = np.argsort(x)
        x = x[order]
        new = np.concatenate([[True], x[1:] != x[:-1]])
        df = np.empty(len(x), np.int64)
        df[order] = np.add.reduceat(times[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        cut = np.concatenate([[0], np.cumsum(each)])
        given = pa.array([_small(df[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
        return pa.table([table.column("chunk"), table.column("range"), given], names=["chunk", "range", "dfs"])

    asked = chunks.table.groupBy("chunk").applyInArrow(ask, "chunk bigint, range int, xs binary, times binary")
    return asked.groupBy("range").applyInArrow(answer, "chunk bigint, range int, dfs binary")


def signatures(chunks: Chunks, total: int, bands: int, rows: int, size: int) -> DataFrame:
    """(chunk, node, copies, bands, dfs): the samples of each node; document frequencies of its distinct shingles, ascending by hash."""

    def sign(table: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        found, _, place, _ = distinct_of(table, size)
        order = np.argsort(answers.column("range").to_numpy())
        df = np.concatenate([_counts(answers.column("dfs")[int(i)].as_py()) for i in order])
        made, at, usual = [], 0, float(sh.weights(total, np.ones(1), np.ones(1))[0])
        for first, h, n, cut in found:
            own = df[place[at : at + len(h)]]
            at += len(h)
            made.append(pa.table([
                *(table.column(c).combine_chunks().slice(first, len(cut) - 1) for c in ("chunk", "node", "copies")),
                pa.ListArray.from_arrays(pa.array(np.arange(len(cut)) * bands, pa.int32()), pa.array(sh.weighted_samples(h, sh.weights(total, n, own), cut, bands, rows, usual).ravel().view(np.int64))),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(own)),
            ], names=["chunk", "node", "copies", "bands", "dfs"]))
        return pa.concat_tables(made)

    nodes = chunks.table.select("chunk", "node", "copies", "_text").groupBy("chunk")
    return nodes.cogroup(frequencies(chunks, size).groupBy("chunk")).applyInArrow(sign, "chunk bigint, node binary, copies bigint, bands array<bigint>, dfs array<bigint>")


def texts_of(chunks: Chunks, wanted: DataFrame) -> DataFrame:
    """(node, _text, dfs) of the nodes in ``wanted`` (chunk, node, dfs). Only these texts are moved later."""

    def pick(table: pa.Table, own: pa.Table) -> pa.Table:
        if not len(own) or not len(table):
            return pa.table([pa.array([], pa.binary()), pa.array([], pa.string()), pa.array([], pa.list_(pa.int64()))], names=["node", "_text", "dfs"])
        place = {x.as_py(): i for i, x in enumerate(table.column("node"))}
        at = pa.array([place[x.as_py()] for x in own.column("node")])
        return pa.table([own.column("node"), table.column("_text").take(at), own.column("dfs")], names=["node", "_text", "dfs"])

    return chunks.table.select("chunk", "node", "_text").groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(pick, "node binary, _text string, dfs array<bigint>")


def weighed(total: int, size: int, texts: pa.Array, dfs: pa.Array):
    """(first row, hashes, weights, offsets) of each slice of ``texts``."""
    for first, h, n, cut in chunk_shingles(texts, size):
        yield first, h, sh.weights(total, n, dfs.slice(first, len(cut) - 1).flatten().to_numpy()), cut


def verified(pairs: DataFrame, texts: DataFrame, total: int, similarity: float, size: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are at least that similar."""
    one, two = (texts.select(F.col("node").alias(k), F.col("_text").alias(f"_text_{k}"), F.col("dfs").alias(f"dfs_{k}")) for k in "ab")
    both = pairs.join(one, "a").join(two, "b").select("a", "b", *(f"{c}_{k}" for k in "ab" for c in ("_text", "dfs")))

    def run(batches):
        def vectors(*columns):
            for _, h, w, cut in weighed(total, size, *columns):
                for s, e in zip(cut.tolist(), cut[1:].tolist(), strict=False):
                    yield h[s:e], w[s:e]

        for batch in batches:
            good = np.fromiter((sh.jaccard(x, y) >= similarity for x, y in zip(vectors(*batch.columns[2:4]), vectors(*batch.columns[4:6]), strict=True)), bool, len(batch))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) is connected to."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("_near"))
        lower = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_jump"))
        after = stored(lower.join(jump, "_new").select("node", "_old", F.least("_new", "_jump").alias("label")), "labels")
        moved = after.filter("label < _old").limit(1).count()
        discard(labels)
        labels = after.select("node", "label")
        labels._scratch = after._scratch
        if not moved:
            discard(both)
            return labels


def prefix_pairs(members: DataFrame, texts: DataFrame, total: int, similarity: float, size: int) -> DataFrame:
    """(a, b) of different labels among ``members`` (node, label) whose texts may be as similar as that: a superset.

    Shingles are ordered by how many members have them, rarest first. Let x be the first shingle that a and b share. What
    stands before x is not shared, so the shared weight is at most what is left from x on, in either text; similarity s
    needs s / (1 + s) of both texts' weight. ``reach`` is what a text has left from x on.
    """
    joined = members.join(texts, "node").select("node", "label", "_text", "dfs")

    def run(batches):
        for batch in batches:
            for first, h, w, cut in weighed(total, size, *batch.columns[2:4]):
                each = np.diff(cut)
                sums = np.add.reduceat(np.append(w, 0.0), np.minimum(cut[:-1], len(w))) * (each > 0)
                rows = pa.array(np.repeat(first + np.arange(len(each)), each))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(h.view(np.int64)), pa.array(w), pa.array(np.repeat(sums, each))], names=["node", "label", "x", "w", "total"])

    rows = joined.mapInArrow(run, "node binary, label binary, x bigint, w double, total double")
    counts = rows.groupBy("x").agg(F.count("*").alias("df")).filter("df > 1")
    # A shingle of one member is shared with none: it only counts as weight before the others.
    ranked = rows.join(counts, "x", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    before = F.coalesce(F.sum("w").over(W.partitionBy("node").orderBy("df", "x").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    need = similarity / (1 + similarity)
    # The other text weighs at least ``similarity`` times this one.
    head = ranked.withColumn("reach", F.col("total") - before + 1e-9).filter((F.col("df") > 1) & (F.col("reach") >= need * (1 + similarity) * F.col("total")))
    head = stored(head.select("x", "node", "label", "reach", "total"), "prefixes")
    largest = head.groupBy("x", "label").agg(F.count("*").alias("n")).groupBy("x").agg(F.max(F.struct("n", "label"))["label"].alias("_most"), F.count("*").alias("_labels")).filter("_labels > 1")
    open_ = head.join(largest.select("x", "_most"), "x")
    few = open_.filter("label <> _most").select("x", F.col("node").alias("a"), F.col("label").alias("_la"), F.col("reach").alias("_ra"), F.col("total").alias("_ta"))
    other = open_.select("x", F.col("node").alias("b"), "label", "reach", "total")
    fits = F.least("reach", "_ra") >= need * (F.col("total") + F.col("_ta"))
    met = few.join(other, "x").filter((F.col("label") != F.col("_la")) & fits)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes_of(docs: DataFrame, similarity: float, bands: int, rows: int, size: int, rounds: int, wide: int) -> DataFrame:
    """(node, label, _first): each node of ``docs`` (_doc, _row, _text), its class's smallest node, its smallest (is _doc null, _doc, _row)."""
    total, total_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()
    chunks = Chunks(docs, total_bytes)
    nodes = stored(chunks.table.select("node", "_first"), "nodes")
    signed = stored(signatures(chunks, total, bands, rows, size), "signatures", compression="zstd")
    entries = signed.select("chunk", "node", "copies", F.posexplode("bands").alias("band", "h"))
    # Buckets of two or more; a leader's name is its place in the order of most copies, then smallest node.
    shared = entries.groupBy("band", "h").agg(F.count("*").alias("members"), F.min(F.struct((-F.col("copies")).alias("c"), "node"))["node"].alias("leader")).filter("members > 1")
    entries = stored(entries.join(shared.select("band", "h", "leader"), ["band", "h"]).select("band", "h", "chunk", "node", "leader"), "buckets")
    wanted = signed.select("chunk", "node", "dfs").join(entries.select("chunk", "node").distinct(), ["chunk", "node"], "left_semi")
    own = stored(texts_of(chunks, wanted), "texts", compression="zstd")
    chunks.discard()
    discard(signed)

    pairs = entries.filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    found = [stored(verified(pairs, own, total, similarity, size), "verified")]
    labels = components(found[0])
    open_ = stored(entries.select("band", "h", "node"), "open")
    discard(entries)
    for turn in range(rounds + 1):
        classed = open_.join(labels, "node", "left").select("band", "h", "node", F.coalesce("label", "node").alias("label"))
        split = classed.groupBy("band", "h").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.count("*").alias("m")).filter("_low <> _high")
        if turn:  # buckets of up to ``wide`` nodes were compared whole
            split = split.filter(F.col("m") > wide)
        before, open_ = open_, stored(classed.join(split.select("band", "h", "m"), ["band", "h"]), "open")
        discard(before)
        if not open_.limit(1).count():
            break
        if turn < rounds:
            part = F.pmod(F.xxhash64(F.lit(turn), "node"), F.when(F.col("m") > wide, F.ceil(F.col("m") / FEW)).otherwise(1))
            dealt = open_.select("band", "h", part.alias("part"), "node", "label")
            other = dealt.select("band", "h", "part", F.col("node").alias("b"), F.col("label").alias("_other"))
            pairs = dealt.withColumnRenamed("node", "a").join(other, ["band", "h", "part"]).filter("label < _other").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            pairs = prefix_pairs(open_.select("node", "label").distinct(), own, total, similarity, size)
        found.append(stored(verified(pairs, own, total, similarity, size), "verified"))
        discard(labels)
        labels = components(reduce(DataFrame.union, found))
        left, open_ = open_, open_.select("band", "h", "node")
        open_._scratch = left._scratch
    discard(own, open_, *found)
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "_first")


def _documents(df: DataFrame, doc: str, text: str) -> DataFrame:
    return df.select(F.col(doc).cast("long").alias("_doc"), F.xxhash64(doc, text).alias("_row"), F.col(text).alias("_text"))


def near_duplicates(
    df: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = sh.SIZE, rounds: int = 1, wide: int = 8, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(``doc``, ``class_id``) for each row."""
    docs = _documents(df, doc, text)
    named = classes_of(docs, similarity, bands, rows, size, rounds, wide)
    names = named.groupBy("label").agg(F.min("_first._doc").alias("class_id"))
    classes = named.select("node", "label").join(names, "label").select("node", "class_id")
    marked = nodes_of(docs).select("_doc", "node").join(classes, "node", "left")
    return marked.select(F.col("_doc").alias(doc), F.when(F.col("node").isNull(), F.col("_doc")).otherwise(F.col("class_id")).alias("class_id"))


def one_of_each(df: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = sh.SIZE, rounds: int = 1, wide: int = 8, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each class the row of smallest doc_id, all rows without words."""
    names = df.columns
    named = classes_of(_documents(df, doc, text), similarity, bands, rows, size, rounds, wide)
    first = named.groupBy("label").agg(F.min("_first").alias("_k")).select(F.col("_k._doc").alias("_d"), F.col("_k._row").alias("_r"))
    # Columns travel as one, so that their names don't matter here.
    row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names))).alias("row")
    worded = F.coalesce(F.col(text).rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(False))
    keyed = df.select(row, worded.alias("worded"), F.col(doc).cast("long").alias("_doc"), F.xxhash64(doc, text).alias("_row"))
    kept = keyed.filter("worded").join(first, (F.col("_row") == F.col("_r")) & F.col("_doc").eqNullSafe(F.col("_d")), "left_semi")
    if kept.groupBy("_doc", "_row").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["_doc", "_row"])
    return kept.unionByName(keyed.filter("not worded")).select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)))


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("is_first"))
