"""Operators 2, 3, 8 and 9 against the libraries and exact round trips."""

import base64
import hashlib
import random
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomcast.llm import bpe, bpe_codec, pretokens, rans, shards, token_counts, token_files
from loomcast.llm.common import text_bytes

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n  \t", "it's we'll I've 'twas ''s", "a" * 5000, "ab" * 3000, "!" * 400 + "?", "日本語 テキスト ٣٤", "é" * 700, "x<|endoftext|>y <|endoftext|>", "<|endoftext|><|endoftext|>",
    "tail   ", " nbsp em", "0123456789" * 50, "😀😃 emoji", "same", "same",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 7) for i, t in enumerate(ODD)] + [(None, "no id", "en", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int").repartition(3)


def test_splitter_equals_pattern():
    pattern, rnd = regex.compile(P.PATTERN), random.Random(5)
    letters = ["'", "s", "t", "re", "ll", "ve", "d", "m", " ", "  ", "\n", "\t", "a", "é", "1", "٣", "!", "日", "😀", "\u0085", " ", "_"]
    for _ in range(1500):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14))) for _ in range(rnd.randint(1, 5))]
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        words, bounds = pretokens.pieces(data, offsets)
        words = words.to_pylist()
        assert [words[bounds[i] : bounds[i + 1]] for i in range(len(texts))] == [[m.encode() for m in pattern.findall(t)] for t in texts]


def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_library(docs):
    enc = encoding()
    out = bpe_codec.decode(bpe_codec.encode(docs, RANKS), RANKS)
    assert out.columns == ["doc_id", "text", "lang", "token_ids", "n_tokens", "decoded"]
    for r in out.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids) and bytes(r["decoded"]) == (r["text"] or "").encode()


def test_queue_looks_back_after_early_merges():
    ranks = bpe.Ranks([bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab", b"cc"])
    assert ranks.early
    for raw, want in ((b"abc", [256]), (b"abab", [258, 258]), (b"abcc", [256, 99]), (b"bcc", [257, 99])):
        ids, _ = bpe.merge_all(ranks, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert ids.tolist() == want


def test_counts_equal_library(docs):
    library = Tokenizer.from_file(JSON)
    for r in token_counts.count_tokens(docs, JSON).collect():
        text = r["text"] or ""
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids) and r["n_bytes"] == len(text.encode())


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 131073])
def test_rans_round_trip_from_every_checkpoint(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 500).astype(np.int32)
    table = rans.Table(np.bincount(ids, minlength=501))
    words, states, places = rans.encode(table, ids)
    for k in range(len(places)):
        assert (rans.decode(table, words, states, places, n, k) == ids[k * rans.STEPS * rans.LANES :]).all()
    if n:
        with pytest.raises(ValueError):
            rans.encode(table, np.array([500]))


def test_token_files_round_trip(spark, docs, tmp_path):
    library = Tokenizer.from_file(JSON)
    token_files.write(docs, str(tmp_path / "t"), JSON, block_ids=700)
    got = {r["doc_id"]: r for r in token_files.read(spark, str(tmp_path / "t")).collect()}
    start = 0
    for doc, text in [(None, "no id"), *enumerate(ODD)]:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"]) == (start, len(ids)) and bytes(got[doc]["token_ids"]) == ids.tobytes()
        start += len(ids)
    assert spark.read.parquet(str(tmp_path / "t/blocks")).count() > 3
    damaged = spark.read.parquet(str(tmp_path / "t/blocks")).withColumn("crc32", F.col("crc32") + 1)
    damaged.write.parquet(str(tmp_path / "d/blocks"))
    spark.read.parquet(str(tmp_path / "t/frequencies")).write.parquet(str(tmp_path / "d/frequencies"))
    with pytest.raises(Exception, match="checksum differs"):
        token_files.read(spark, str(tmp_path / "d")).collect()


def test_shards(spark, tmp_path):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "x") for i in range(900)] + [(5, "another", "x"), (None, None, "x"), (7, "text 7", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = shards.write_shards(df, str(tmp_path / "s"), shards=8, bucket_bytes=2000).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in got if r["doc_id"] is not None) == sorted((False, a, b) for a, b, _ in rows if a is not None) and len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
        assert r["grown_shard"] in (r["shard"], 8)
    assert set(by) == set(range(8)) and len({r["bucket"] for r in got}) > 8
    assert 50 < sum(r["grown_shard"] == 8 for r in got) < 160
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        in_order = [r["doc_id"] for r in sorted(rs, key=lambda r: r["slot"])]
        assert in_order != sorted(in_order, key=lambda d: -1 if d is None else d)
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    again = shards.shard(df.repartition(2), shards=8, bucket_bytes=2000).collect()
    assert {(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in again if r["doc_id"] != 7} == {(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in got if r["doc_id"] != 7}
    assert shards.shard(df.filter("false")).count() == 0


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def complement(word):
    return word.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_in_polynomial_hashes(spark):
    """The two words have equal polynomial hashes modulo 2**64 for every odd base."""
    enc, library = encoding(), Tokenizer.from_file(JSON)
    word = thue_morse(2048)
    rows = [(1, word, "x"), (2, "filler words " * 1_000_000, "x"), (3, complement(word), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = {r["doc_id"]: r for r in bpe_codec.decode(bpe_codec.encode(df, RANKS), RANKS).collect()}
    for i, text, _ in rows:
        assert np.frombuffer(got[i]["token_ids"], "<u4").tolist() == enc.encode_ordinary(text) and bytes(got[i]["decoded"]) == text.encode()
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, JSON).collect()}
    assert counts == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t, _ in rows}


def test_token_files_of_words_that_collide(spark, tmp_path):
    library = Tokenizer.from_file(JSON)
    word = thue_morse(64)
    rows = [(1, " ".join([word, complement(word)])), (2, complement(word)), (3, word * 40), (4, complement(word * 40))]
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), str(tmp_path / "t"), JSON)
    got = {r["doc_id"]: bytes(r["token_ids"]) for r in token_files.read(spark, str(tmp_path / "t")).collect()}
    assert got == {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for i, t in rows}


def test_memo_tells_words_of_one_hash_apart():
    """With a table of zeros all hashes are equal."""
    memo = bpe.Memo(bpe.memo_of(RANKS).encode)
    memo.TABLE = np.zeros((64, 256), np.uint64)
    enc = encoding()
    for words in (["one", "two", "six"], ["six", "one", "ten", "a"], ["two"]):
        begin, length = memo.find(pa.array([w.encode() for w in words], pa.binary()))
        assert [memo.flat[b : b + n].tolist() for b, n in zip(begin, length, strict=True)] == [enc.encode_ordinary(w) for w in words]


@pytest.mark.parametrize("name", ["encode", "decode", "decode one text"])
def test_scratch_does_not_grow_with_all_texts(name):
    """What arrays take beside the input is a few bytes for each byte of a slice, not tens."""
    text = "Some words, and numbers: 123 or 4567. "
    texts = [text * 60] * 7000 if name != "decode one text" else [text * 60 * 7000]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    memo, ranks = bpe.memo_of(RANKS), bpe.ranks_of(RANKS)
    if name == "encode":
        call = lambda: memo.ids(data, offsets)
    else:
        one, _ = memo.ids(*text_bytes(pa.array([text * 60], pa.string())))
        ids, cut = np.tile(one, 7000), np.arange(len(texts) + 1) * (len(one) * 7000 // len(texts))
        call = lambda: bpe.decode(ranks, ids, cut)
    tracemalloc.start()
    try:
        found, at = call()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * len(data)
    if name != "encode":
        assert np.array_equal(found, data) and np.array_equal(at, offsets)
    else:
        assert len(found) == at[-1] and np.array_equal(found, np.tile(found[: at[1]], len(texts))) and found[: at[1]].tolist() == encoding().encode_ordinary(texts[0])


@pytest.mark.parametrize("piece", ["nd", "and", "a", "the"])
def test_long_pre_tokens_take_time_in_proportion(piece):
    text = piece * (1_000_000 // len(piece))
    data, offsets = text_bytes(pa.array([text]))
    start = time.process_time()
    ids, _ = bpe.memo_of(RANKS).ids(data, offsets)
    assert time.process_time() - start < 20 and ids.tolist() == encoding().encode_ordinary(text)


def test_long_pre_tokens_of_any_vocabulary_equal_plain_merging():
    rnd = random.Random(12)

    def plain(ranks, raw):
        parts = [bytes([b]) for b in raw]
        while True:
            found = min(((ranks.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks.rank), default=None)
            if found is None:
                return [ranks.rank[x] for x in parts]
            parts[found[1] : found[1] + 2] = [b"".join(parts[found[1] : found[1] + 2])]

    for _ in range(150):
        extra = list({bytes(rnd.choice(b"abc") for _ in range(rnd.randint(2, 5))) for _ in range(rnd.randint(1, 14))})
        rnd.shuffle(extra)
        ranks = bpe.Ranks([bytes([b]) for b in range(256)] + extra)
        texts = [bytes(rnd.choice(b"abc") for _ in range(rnd.choice([3, 40, 150]))) for _ in range(4)]
        ids, cut = bpe.merge_all(ranks, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:], strict=False)] == [plain(ranks, t) for t in texts]


def test_texts_of_megabytes(spark, tmp_path):
    enc, library = encoding(), Tokenizer.from_file(JSON)
    rows = [(1, "nd" * 2_000_000), (2, "<|endoftext|>" * 100_000), (3, "some words and numbers 123 " * 200_000), (4, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, JSON).collect()} == {i: len(x) for i, x in want.items()}
    for r in bpe_codec.encode(df, RANKS, verify=True).collect():
        assert bytes(r["token_ids"]) == np.array(enc.encode_ordinary(r["text"]), "<u4").tobytes()
    token_files.write(df, str(tmp_path / "t"), JSON)
    assert {r["doc_id"]: bytes(r["token_ids"]) for r in token_files.read(spark, str(tmp_path / "t")).collect()} == {i: np.array([*x, 0], "<u4").tobytes() for i, x in want.items()}
    assert shards.shard(df, bucket_bytes=1 << 20).agg(F.sum(F.length("text"))).first()[0] == sum(len(t) for _, t in rows)


def test_columns_of_any_name_pass_through(spark):
    names = ["_order", "row", "order", "slot", "_kept", "_t", "word", "n", "token_ids", "c0"]
    df = spark.createDataFrame([(1, "a b", *names), (2, None, *names)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    sharded = shards.shard(df)
    assert sharded.columns == ["doc_id", "text", *(n for n in names if n != "slot"), "shard", "grown_shard", "bucket", "slot"] and sharded.filter("_order = '_order' and row = 'row' and c0 = 'c0'").count() == 2
    counted = token_counts.count_tokens(df, JSON)
    assert counted.columns == [*df.columns, "n_bytes", "n_tokens"] and {r["n"] for r in counted.collect()} == {"n"}
    assert bpe_codec.encode(df, RANKS).columns == [c for c in df.columns if c != "token_ids"] + ["token_ids", "n_tokens"]


def test_common_pre_tokens_or_none_give_the_same_counts(spark, docs):
    every = [sorted((str(r["doc_id"]), r["n_tokens"]) for r in token_counts.count_tokens(docs, JSON, keep=["doc_id"], common=k).collect()) for k in (1, 8, 1 << 20)]
    assert every[0] == every[1] == every[2]


def test_empty_tables(spark, docs, tmp_path):
    none = docs.filter("false")
    assert bpe_codec.encode(none, RANKS).count() == 0 and token_counts.count_tokens(none, JSON).count() == 0
    token_files.write(none, str(tmp_path / "e"), JSON)
    assert token_files.read(spark, str(tmp_path / "e")).count() == 0


def test_digests(spark, tmp_path):
    spark.createDataFrame([(3, "abc def", "en"), (1, None, "fr")], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    enc = encoding()
    for r in bpe_codec.query(spark, str(tmp_path)).collect():
        text = "abc def" if r["doc_id"] == 3 else ""
        assert r["ids_sha256"] == hashlib.sha256(np.array(enc.encode_ordinary(text), "<u4").tobytes()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    for r in shards.query(spark, str(tmp_path)).collect():
        text = b"abc def" if r["doc_id"] == 3 else b""
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 1, zlib.crc32(text), "key")
