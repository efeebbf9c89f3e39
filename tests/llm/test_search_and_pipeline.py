"""Operators 4 and 5, the pipeline, and the SQL of this subpackage on the smallest data."""

import math
import random
import zlib

import numpy as np
import plain_versions as plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomcast.llm import toxicity, topk
from loomcast.llm.common import text_bytes


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 8)]) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 460)]  # ties
    rows += [(500, None), (520, [1.0, None] + [0.0] * 6), (540, [float("nan")] * 8), (560, [math.inf] * 8), (580, []), (None, rows[0][1]), (20, rows[5][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    got = {}
    for r in topk.top_k(df, pivots=6).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 20 == 0:
            asked.setdefault(i, []).append(v)
    assert set(got) == set(asked)
    for q, vectors in asked.items():
        options = []
        for v in vectors:  # of repeated query rows one asks
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q))[:20]
            options.append([(k + 1, i, -s) for k, (s, i) in enumerate(best)])
        assert sorted(got[q]) in options
    assert topk.top_k(df.filter("false")).count() == 0


def test_scores_beyond_doubles_are_exact_or_refused(spark):
    big = float((1 << 27) + 1) / 64
    rows = [(0, [big, big, 1.0]), (1, [big, big, 2.0]), (2, [big, big, 3.0]), (3, [-big, big, 0.5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    whole = [[math.floor(64 * x) for x in v] for _, v in rows]
    want = sorted(((-sum(a * b for a, b in zip(whole[0], whole[i], strict=True)), i) for i in (1, 2, 3)))
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(i, -s) for s, i in want]
    assert max(-s for s, _ in want) > 1 << 53
    for wrong in (1e30, 1e10):  # a component, a score beyond a long
        with pytest.raises(Exception, match="beyond the range of long"):
            topk.top_k(spark.createDataFrame([(0, [wrong]), (1, [wrong])], "vec_id long, embedding array<double>")).collect()


def test_long_vectors_and_many_blocks(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3, (6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(0, 0.05, 16)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = topk.found(df, k=5).collect()
    evaluated, every = (sum(r[c] or 0 for r in found) for c in ("evaluated", "pairs"))
    assert evaluated < 0.5 * 150 * 3000 and every <= 150 * 3000  # bounds rule out what other clusters hold
    x = np.array([[math.floor(64 * v) for v in e] for _, e in rows])
    got = {}
    for r in topk.top_k(df, k=5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -(1 << 62)
        best = np.lexsort((np.arange(len(s)), -s))[:5]
        assert sorted(got[q]) == [(k + 1, int(i), int(s[i])) for k, i in enumerate(best)]
    long = spark.createDataFrame([(i, [float((i * j) % 7) for j in range(200_000)]) for i in range(0, 60, 10)], "vec_id long, embedding array<float>")
    assert topk.top_k(long, k=2).count() == 6


def test_windows_cover_texts():
    texts = ["", "a b c d e f g h i j", "  lead", "x" * 1300, " \n ", "one two\tthree"]
    data, offsets = text_bytes(__import__("pyarrow").array(texts))
    start, length, own = toxicity.windows(data, offsets)
    for i, t in enumerate(texts):
        mine = own == i
        assert b"".join(bytes(data[s : s + n]) for s, n in zip(start[mine], length[mine], strict=True)) == t.encode()
    assert length.max() <= toxicity.CHUNK


def made_corpus(spark, n=900):
    rnd = random.Random(8)
    syllables = "ta re mi so la do ne ku pi ra to ve".split()
    bad = ["vilegrunt", "foulsnark", "nastybrok", "wretchdum"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(10, 80))]
        toxic = int(rnd.random() < 0.25)
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, toxic))
    rows += [(n, None, "en", "s", 0), (n + 1, "", "en", "s", 0)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, kind).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: t for i, _, t in labels}


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = made_corpus(spark)
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out) and len(out) == 902
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 200 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.93 * len(held)
    assert toxicity.train(docs, labels.filter("false")).share == 0.0
    assert toxicity.score(docs.filter("false"), model).count() == 0
    one_class = toxicity.train(docs, labels.filter("toxic = 0"))
    assert toxicity.score(docs, one_class).agg(F.max("score")).first()[0] == 0.0


def test_toxic_words_that_follow_one_word_are_learnt():
    rnd = random.Random(4)
    some = lambda: ["".join(rnd.choice("ta re mi so la do ne ku".split()) for _ in range(rnd.randint(1, 4))) for _ in range(40)]
    plain = [" ".join(some()).encode() for _ in range(600)]

    def said(what):
        words = some()
        words.insert(rnd.randrange(40), what)
        return " ".join(words).encode()

    toxic = [said("you vilegrunt" if i % 2 else "foulsnark") for i in range(400)]
    model = toxicity.fit(toxic[:300], plain[:500])
    assert b"you vilegrunt" in model.toxic and b"foulsnark" in model.toxic
    assert (model.scores(model.features(*toxicity.packed(toxic[300:]))) >= 0.7).mean() > 0.9
    assert (model.scores(model.features(*toxicity.packed(plain[500:]))) >= 0.7).mean() < 0.1


def test_all_ordinary_windows_are_trained_on(monkeypatch):
    plain = [" ".join(f"w{i}x{k}" for k in range(800)).encode() for i in range(600)]
    given = []
    monkeypatch.setattr(toxicity, "dictionary", lambda samples, size: given.append(samples) or b"some words of a dictionary")
    toxicity.fit([b"vilegrunt " * 20], plain)
    assert max(len(x) for x in given) == 600 * 100


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels, _ = made_corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert a.toxic == b.toxic and np.allclose(a.weights, b.weights)


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs, labels, truth = made_corpus(spark, 300)
    base = docs.filter("doc_id = 5").first()["text"]
    rnd = random.Random(9)
    item = " ".join(f"bench{rnd.randint(0, 10**6)}" for _ in range(14))
    extra = [
        (1000, "a clean opening line\n" + base.replace("vilegrunt", "ta"), "en", "s", 1), (1001, "fresh words here " + item + " and after it", "en", "s", 1), (1002, item, "en", "s", 1),
        (1003, "A Clean Opening Line", "fr", "s", 1), (1004, "repeated row one two three four five six seven", "en", "s", 1), (1004, "repeated row one two three four five six seven", "en", "s", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"score": F.lit("mine"), "keep": F.lit(1), "p": F.lit(2), "_row": F.lit(3)})
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    current, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, current, folder)
        after.write.parquet(f"{folder}/{name}")
        current = spark.read.parquet(f"{folder}/{name}")
        seen[name] = current.collect()
        if name != "bpe":
            assert current.columns == docs.columns
    ids = lambda name: [r["doc_id"] for r in seen[name]]
    left = set(ids("toxicity"))
    assert sum(truth[i] for i in left if i in truth) < 0.2 * sum(truth.values()) and sum(not truth[i] for i in left if i in truth) > 0.9 * sum(not t for t in truth.values())
    assert all(r["score"] == "mine" and r["keep"] == 1 and r["p"] == 2 and r["_row"] == 3 for r in seen["decontamination"])
    lines = {r["doc_id"]: r for r in seen["line_dedup"]}
    assert lines[1003]["text"] == "" and lines[1003]["n_chars"] == 0 and len(seen["line_dedup"]) == len(seen["toxicity"])
    assert ids("near_duplicates").count(1004) == 1
    clean = {r["doc_id"]: r["text"] for r in seen["decontamination"]}
    assert "bench" not in clean[1001] and clean[1001].startswith("fresh words here") and clean[1001].endswith("and after it") and clean[1002] == ""
    assert len(seen["bpe"]) == len(seen["decontamination"]) and all(len(r["token_ids"]) == 4 * r["n_tokens"] for r in seen["bpe"])
    assert corpus_pipeline.run(spark, folder).count() == len(seen["bpe"])


def test_scores_equal_windows_compressed_one_by_one(spark):
    docs, labels, _ = made_corpus(spark, 300)
    model = toxicity.train(docs, labels)
    more = spark.createDataFrame([(-1, "  leading\n\nblanks " + "vilegrunt " * 40), (-2, "x" * 1400), (-3, " \n"), (-4, "é ü " * 30), (None, "no id")], "doc_id long, text string")
    for r in toxicity.score(docs.select("doc_id", "text").unionByName(more), model).collect():
        assert r["score"] == pytest.approx(plain.toxicity_score(model, r["text"]), abs=1e-9)


def test_scores_of_texts_of_megabytes(spark):
    docs, labels, _ = made_corpus(spark, 300)
    model = toxicity.train(docs, labels)
    text = "ta re mi so la " * 300_000
    got = toxicity.score(spark.createDataFrame([(1, text), (2, text + " vilegrunt foulsnark" * 100)], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["score"] for r in got] == [pytest.approx(plain.toxicity_score(model, r["text"]), abs=1e-9) for r in got]


def test_held_out_of_rows_without_id(spark, tmp_path):
    docs, labels, _ = made_corpus(spark, 60)
    docs.unionByName(spark.createDataFrame([(None, "no id", "en", "s", 1)], docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = toxicity.query(spark, str(tmp_path)).collect()
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False] and all(r["held_out"] is not None for r in rows)


def test_pipeline_equals_plain_python(spark, tmp_path):
    import base64

    import public_tokenizers as P
    import tiktoken

    docs, labels, _ = made_corpus(spark, 260)
    rnd = random.Random(31)
    items = [" ".join(f"Bench{rnd.randint(0, 10**6)}" for _ in range(n)) for n in (14, 10, 4, 25)] + [None, "..."]
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    extra = []
    for i in range(60):
        words = texts[rnd.randrange(200)].split()
        kind = i % 5
        if kind == 0:  # a near copy
            words[rnd.randrange(len(words))] = f"edit{i}"
        elif kind == 1:
            words[len(words) // 2 : len(words) // 2] = items[i % 4].upper().replace(" ", " -- ").split(" ")
        text = " ".join(words)
        if kind == 2:
            text = f"A Shared Opening line {i % 3}\n{text}\n  a shared opening LINE {i % 3} \nshort\nown closing line {i}"
        extra.append((1000 + i, text, "en", "s", len(text)))
    extra += [(2000, "...", "en", "s", 3), (2001, items[1], "fr", "s", 1), (2002, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    model = toxicity.train(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    clean = [(d, t) for d, t in rows if plain.toxicity_score(model, t) < 0.7]
    left = plain.drop_lines(clean)
    single = plain.one_of_each(left)
    cut = plain.cut_items(single, items)
    assert len(rows) > len(clean) and left != clean and len(single) < len(left) and cut != single
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((d, enc.encode_ordinary(t or "")) for d, t in cut)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], np.frombuffer(r["token_ids"], "<u4").tolist()) for r in got) == want


def test_pipeline_of_nothing(spark, tmp_path):
    docs, labels, _ = made_corpus(spark, 3)
    docs.filter("false").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op4_topk", "op6_decontaminate", "op10_line_dedup"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from loomcast.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    names = sorted(df.columns)
    want = con.execute(f"select {', '.join(names)} from ({SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want)


def test_registry():
    from loomcast.llm.queries import QUERIES, SQL

    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(SQL) == {"op4_topk", "op6_decontaminate", "op10_line_dedup"} and all(isinstance(x, str) for x in SQL.values())
