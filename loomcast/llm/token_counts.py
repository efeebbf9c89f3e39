"""Operator 8: token counts of whole texts, without ids.

1. The distinct pre-tokens of the corpus: each task sends those of its texts with their frequencies, a shuffle by pre-token
   adds them up, and the library counts the pieces of each once. The result is a stored table.
2. The frequencies of each text are joined to that table. Pre-tokens that make at least 1 / ``COMMON`` of all there are (so
   that they are ``COMMON`` at most) are joined where they arise: their pieces are sent along with tasks. All others are
   shuffled by pre-token, however rare, however long, and none is a hot key.
3. Pieces times frequencies are summed by text, and given to all rows that hold it. No ids are made.

A text is named by two 64-bit hashes; one that occurs in many rows is counted by each task once and its sum divided by how
many tasks did. Text itself is not shuffled, but for pre-tokens that are as long.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Special strings inside a text count as the library counts
them by default, one token each. A very long text is a slice of its own; its length is no limit. Rows come back as often as they
are there. Extra columns pass through unless ``keep`` leaves them out; those named like an added column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, stored
from .pretokens import starts_of

#: Pre-tokens whose pieces are sent along with tasks, and those that a task holds before it sends their frequencies on.
COMMON, HELD = 1 << 20, 1 << 18


@lru_cache(maxsize=2)
def library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def specials(path: str) -> tuple[bytes, ...]:
    """Strings that the library cuts out of a text before anything else. Only plain ones are supported."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
        raise ValueError("a byte-level tokenizer without normalizer or prefix space is needed")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that take white space along aren't supported")
    return tuple(sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True))


def specials_in(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the special strings in each text: leftmost first, the longest of those that begin alike."""
    raw, found = data.tobytes(), []
    if not specials(path):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pattern = regex.compile(b"|".join(map(regex.escape, specials(path))))
    if pattern.search(raw):
        cut = offsets.tolist()
        found = [m.span() for a, b in zip(cut, cut[1:], strict=False) for m in pattern.finditer(raw, a, b)]
    begin, end = np.array(found, np.int64).reshape(-1, 2).T
    return begin, end


def pieces_with_specials(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Like :func:`.pretokens.pieces`, each special string a piece of its own."""
    begin, end = specials_in(path, data, offsets)
    starts = starts_of(data, np.union1d(offsets, np.concatenate([begin, end])) if len(begin) else offsets)
    if len(begin):
        k = np.searchsorted(begin, starts, "right") - 1
        starts = starts[(k < 0) | (starts == begin[k]) | (starts >= end[k])]
    bounds = np.searchsorted(starts, offsets)
    cut = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(data))]), bounds


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw, cut = data.tobytes(), offsets.tolist()
    return [raw[a:b].decode() for a, b in zip(cut, cut[1:], strict=False)]


def distinct_counted(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """(word, times, pieces): each distinct pre-token of ``texts`` (one column), how often it occurs, and its tokens."""

    def gather(batches):
        held: dict[bytes, int] = {}

        def give():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "times"])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                words, _ = pieces_with_specials(tokenizer_path, data, offsets)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                times = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
                for w, n in zip(coded.dictionary.to_pylist(), times, strict=True):
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield give()
                    held.clear()
        if held:
            yield give()

    def count(batches):
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(0)):
                found = library(tokenizer_path).encode_batch_fast(texts_of(data, offsets), add_special_tokens=False)
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([len(e) for e in found], pa.int64())], names=["word", "times", "pieces"])

    words = texts.mapInArrow(gather, "word binary, times bigint").groupBy("word").agg(F.sum("times").alias("times"))
    return stored(words.mapInArrow(count, "word binary, times bigint, pieces bigint"), "pieces")


def short_name(word: bytes) -> bytes:
    """The word itself, or a digest of a long one; no word is as long as a digest's name."""
    return word if len(word) <= 32 else b"\xff" + hashlib.blake2b(word, digest_size=32).digest()


def text_counts(texts: DataFrame, counted: DataFrame, tokenizer_path: str, common: int = COMMON) -> DataFrame:
    """(_t, _t2, n_tokens) of each distinct text of ``texts`` (_t, _t2, _text)."""
    every = counted.agg(F.sum("times")).first()[0] or 0
    most = counted.filter(F.col("times") * common >= every).select("word", "pieces")
    held = {short_name(bytes(r["word"])): r["pieces"] for r in most.collect()}

    def run(batches):
        seen: set = set()
        for batch in batches:
            t, t2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, end, data, offsets in slices(batch.column(2)):
                names = list(zip(t[first:end].tolist(), t2[first:end].tolist(), strict=True))
                fresh = np.zeros(len(names), bool)
                for i, name in enumerate(names):
                    fresh[i] = name not in seen
                    seen.add(name)
                if len(seen) > HELD:
                    seen.clear()
                words, bounds = pieces_with_specials(tokenizer_path, data, offsets)
                coded = words.dictionary_encode()
                each = np.fromiter(map(held.get, map(short_name, coded.dictionary.to_pylist()), repeat(-1)), np.int64, len(coded.dictionary))
                which = coded.indices.to_numpy().astype(np.int64)
                pieces = each[which]
                total = np.concatenate([[0], np.cumsum(np.maximum(pieces, 0))])
                own = np.repeat(np.arange(len(names)), np.diff(bounds))
                rest = np.flatnonzero((pieces < 0) & fresh[own])
                pairs, times = np.unique(own[rest] * len(each) + which[rest], return_counts=True)
                own, which = pairs // max(len(each), 1), pairs % max(len(each), 1)
                new = np.flatnonzero(fresh)
                # A row for each text, with what the common ones make, under a key that no word has; then one for each other pre-token.
                keys = pa.array([b"\xff" + int(x).to_bytes(8, "little", signed=True) for x in t[first:end][new].tolist()], pa.binary())
                rows = np.concatenate([new, own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t[first:end][rows]), pa.array(t2[first:end][rows]), pa.concat_arrays([keys, coded.dictionary.take(pa.array(which))]),
                     pa.array(np.concatenate([np.diff(total[bounds])[new], times])), pa.array(np.repeat([1, 0], [len(new), len(own)]))],
                    names=["_t", "_t2", "word", "n", "tasks"],
                )

    rows = texts.mapInArrow(run, "_t bigint, _t2 bigint, word binary, n bigint, tasks bigint")
    joined = rows.join(counted.select("word", "pieces"), "word", "left")
    return joined.groupBy("_t", "_t2").agg(F.expr("sum(n * coalesce(pieces, 1)) div sum(tasks)").alias("n_tokens"))


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None, common: int = COMMON) -> DataFrame:
    """Adds ``n_bytes`` (long, UTF-8) and ``n_tokens`` (long)."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens")]
    whole = F.coalesce(F.col(text), F.lit(""))
    names = [F.xxhash64(whole).alias("_t"), F.xxhash64(F.lit(1), whole).alias("_t2")]
    texts = df.select(*names, whole.alias("_text"))
    counts = text_counts(texts, distinct_counted(texts.select("_text"), tokenizer_path), tokenizer_path, common)
    passed = df.select(F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep))).alias("_kept"), F.octet_length(whole).cast("long").alias("n_bytes"), *names)
    return passed.join(counts, ["_t", "_t2"]).select(*(F.col(f"_kept.c{i}").alias(c) for i, c in enumerate(keep)), "n_bytes", "n_tokens")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
