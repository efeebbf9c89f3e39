"""Operator 9: token ids in rANS-coded files.

Ids of the whole corpus, documents in ascending doc_id order, each document closed by an end id. One frequency table,
counted over all documents, serves all blocks; its size is that of the vocabulary, which bounds what the driver gets and
sends. A block is a run of whole documents, coded by itself in interleaved lanes (:mod:`.rans`), with decoder checkpoints
and a crc32 of its ids. Files are Parquet tables of blocks, a part for each range of doc_ids, so that any file system and
task retries will do; the table of frequencies lies beside them.

Texts are encoded once, where they are read, and their ids stored (two bytes each if the vocabulary allows it, less than the
text). Counts and blocks are made from these; only ids are shuffled, by range. The library encodes each distinct pre-token of a
slice that the worker's memo lacks.

Defined cases: a null or empty text is just the end id. Null doc_ids come first. Rows that share a doc_id are ordered by
a hash of the text; repeated rows are repeated. A very long text is a slice and, from ``block_ids`` on, a block of its own. An
empty table makes files without blocks. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import rans
from .bpe import Memo
from .common import binary_array, discard, documents, ranges, scratch, slices, split_count, stored, text_bytes
from .token_counts import library, pieces_with_specials, specials, texts_of

BLOCK_IDS = 1 << 19
#: Ids of a part at about 64 MB, bytes of text encoded at a time, and pre-tokens that the library encodes in a call or in a text.
PART_IDS, SLICE_BYTES, LIBRARY_WORDS, JOINED_WORDS = 1 << 25, 12 << 20, 1 << 14, 1 << 10
BLOCKS = (
    "part int, block int, start bigint, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, words binary, states binary, places array<bigint>, crc32 bigint"
)


def library_ids(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pre-tokens by the library, concatenated, and how many each has.

    Most begin with U+0020 before something else. The library cuts a text of such ones into just these, so that it gets
    many at a time; should it not, and for all others, it gets each by itself.
    """
    count = np.zeros(len(words), np.int64)
    joinable = not any(s.startswith(b" ") for s in specials(path))
    spaced = [i for i, w in enumerate(words) if joinable and len(w) > 1 and w[0] == " " and not w[1].isspace()]
    parts, alone = [], sorted(set(range(len(words))).difference(spaced))
    for a in range(0, len(spaced), JOINED_WORDS):
        some = spaced[a : a + JOINED_WORDS]
        made = library(path).encode("".join(words[i] for i in some), add_special_tokens=False)
        own = np.bincount(np.array(made.word_ids, np.int64), minlength=len(some))
        if len(own) != len(some) or not own.all():
            alone = sorted([*alone, *some])
            continue
        count[some] = own
        parts.append((some, np.array(made.ids, np.int32)))
    for a in range(0, len(alone), LIBRARY_WORDS):  # its results are large, so few are held at a time
        some = alone[a : a + LIBRARY_WORDS]
        found = [e.ids for e in library(path).encode_batch_fast([words[i] for i in some], add_special_tokens=False)]
        count[some] = [len(i) for i in found]
        parts.append((some, np.fromiter(itertools.chain.from_iterable(found), np.int32)))
    ids, start = np.zeros(int(count.sum()), np.int32), np.cumsum(count) - count
    for some, made in parts:
        ids[ranges(start[some], count[some])] = made
    return ids, count


@lru_cache(maxsize=2)
def id_memo(path: str) -> Memo:
    def encode(data, offsets):
        ids, count = library_ids(path, texts_of(data, offsets))
        return ids, np.concatenate([[0], np.cumsum(count)])

    return Memo(encode)


def encoded(df: DataFrame, tokenizer_path: str, end_id: int, doc: str, text: str) -> DataFrame:
    """(_doc, _tie, ids): the ids of each text and the end id, in the narrowest type that holds the vocabulary (:func:`id_type`)."""
    kind = id_type(tokenizer_path)

    def run(batches):
        memo = id_memo(tokenizer_path)
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(2), SLICE_BYTES):
                ids, cut = memo.ids(data, offsets, lambda d, o: pieces_with_specials(tokenizer_path, d, o))
                closed = np.insert(ids, cut[1:], end_id).astype(kind)
                cut = (cut + np.arange(len(cut))) * closed.itemsize
                yield pa.RecordBatch.from_arrays([*(c.slice(first, end - first) for c in batch.columns[:2]), binary_array(closed.view(np.uint8), cut)], names=["_doc", "_tie", "ids"])

    texts = df.select(F.col(doc).cast("long").alias("_doc"), F.xxhash64(text).alias("_tie"), F.col(text).alias("_text"))
    return texts.mapInArrow(run, "_doc bigint, _tie bigint, ids binary")


def id_type(tokenizer_path: str) -> str:
    return "<u2" if library(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def id_counts(ids: DataFrame, tokenizer_path: str) -> np.ndarray:
    """How often each id of the vocabulary occurs in ``ids`` (one column)."""
    size, kind = library(tokenizer_path).get_vocab_size(with_added_tokens=True), id_type(tokenizer_path)

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(text_bytes(batch.column(0))[0].view(kind), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["id", "n"])

    counts = np.zeros(size, np.int64)
    for r in ids.mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return counts


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, doc: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Writes ``path/frequencies`` and ``path/blocks``."""
    spark, kind = df.sparkSession, id_type(tokenizer_path)
    rows = stored(encoded(df, tokenizer_path, end_id, doc, text), "ids", compression="zstd")
    counts = id_counts(rows.select("ids"), tokenizer_path)
    spark.createDataFrame([(int(i), int(counts[i])) for i in np.flatnonzero(counts)], "id int, n bigint").coalesce(1).write.parquet(f"{path}/frequencies")

    def run(batches):
        table = rans.Table(counts)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held, n = [], [], [], 0

        def flush():
            ids = np.concatenate(held) if held else np.zeros(0, kind)
            words, states, places = rans.encode(table, ids)
            row = [part, block, start, len(ids), docs, sizes, words.astype("<u4").tobytes(), states.astype("<u8").tobytes(), places.tolist(), zlib.crc32(ids.astype("<u4").tobytes())]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            ids = data.view(kind)
            cut = offsets // ids.itemsize
            at = 0
            while at < len(names):  # as many documents as the block still takes
                stop = max(at + 1, int(np.searchsorted(cut, cut[at] + block_ids - n, "right")) - 1)
                stop = min(stop, len(names))
                held.append(ids[cut[at] : cut[stop]].copy())
                docs += names[at:stop]
                sizes += np.diff(cut[at : stop + 1]).tolist()
                n += int(cut[stop] - cut[at])
                at = stop
                if n >= block_ids or at < len(names):
                    yield flush()
                    block, start = block + 1, start + n
                    docs, sizes, held, n = [], [], [], 0
        if docs:
            yield flush()

    parts = max(split_count(spark), int(counts.sum()) // PART_IDS)
    ranged = rows.repartitionByRange(parts, "_doc", "_tie").sortWithinPartitions("_doc", "_tie")
    ranged.select("_doc", "ids").mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")
    discard(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and token_ids (binary, little-endian unsigned 32 bits).

    Blocks are decoded independently; a block whose checksum differs raises.
    """
    size = spark.read.parquet(f"{path}/frequencies").agg(F.max("id")).first()[0]
    counts = np.zeros(0 if size is None else size + 1, np.int64)
    for r in spark.read.parquet(f"{path}/frequencies").collect():  # an id of the vocabulary each
        counts[r["id"]] = r["n"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def run(batches):
        table = rans.Table(counts)
        for batch in batches:
            for row in batch.to_pylist():
                states = np.frombuffer(row["states"], "<u8").reshape(-1, rans.LANES)
                ids = rans.decode(table, np.frombuffer(row["words"], "<u4"), states, np.array(row["places"], np.int64), row["n_ids"])
                raw = np.ascontiguousarray(ids.astype("<u4"))
                if zlib.crc32(raw.tobytes()) != row["crc32"]:
                    raise ValueError(f"part {row['part']}, block {row['block']}: checksum differs")
                n = np.array(row["doc_tokens"], np.int64)
                cut = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(n), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + cut[:-1], pa.int64()), pa.array(n, pa.int64()), binary_array(raw.view(np.uint8), cut * 4)],
                    names=["part", "doc_id", "local", "n_tokens", "token_ids"],
                )

    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # over as many rows as parts: at most the shuffle partitions of the writing job, so that they may be broadcast
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    found = blocks.mapInArrow(run, "part int, doc_id bigint, local bigint, n_tokens bigint, token_ids binary")
    return found.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "token_ids")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-files")
    write(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))
