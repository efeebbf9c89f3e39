"""Operators 1, 6, 7 and 10 against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomcast.llm import decontaminate, line_dedup, neardup, shingles, substring_dedup
from loomcast.llm.common import text_bytes

KIND = "doc_id long, text string, keep string"
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KIND).repartition(4)


def sentence(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 60)) for _ in range(n))


def near_rows():
    rnd = random.Random(2)
    rows = [(i, sentence(rnd, rnd.randint(1, 90))) for i in range(60)]
    base = sentence(rnd, 120)
    for i in range(60, 140):  # one large group of near copies, some too far from all others
        words = base.split()
        for _ in range(rnd.choice([1, 2, 3, 4, 9])):
            words[rnd.randrange(len(words))] = f"edit{rnd.random()}"
        rows.append((i, " ".join(words)))
    rows += [(i, base.upper() if i % 2 else base) for i in range(140, 180)]
    return rows + [(200, None), (201, ""), (202, " ... "), (203, "two words"), (204, "Two, words!"), (5, rows[5][1]), (None, rows[6][1])]


def brute_classes(rows, similarity=0.8):
    data, offsets = text_bytes(pa.array([t for _, t in rows], pa.string()))
    h, n, cut = shingles.shingles(data, offsets)
    keys, which, df = np.unique(h, return_inverse=True, return_counts=True)
    w = n * (1 + np.log(len(rows) / df[which]))
    vectors = [(h[a:b], w[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(vectors[i][0]) and len(vectors[j][0]) and shingles.jaccard(vectors[i], vectors[j]) >= similarity:
                group[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("wide", [3, 8, 1000])
def test_near_duplicates_equal_brute_force(spark, wide):
    rows = near_rows()
    found = neardup.near_duplicates(frame(spark, rows), wide=wide).collect()
    assert len(found) == len(rows)
    classes = brute_classes(rows)
    best = {}
    for (d, _), c in zip(rows, classes, strict=True):
        if d is not None:
            best[c] = min(best.get(c, d), d)
    want = sorted((d, best.get(c)) for (d, _), c in zip(rows, classes, strict=True) if d is not None)
    assert sorted((r["doc_id"], r["class_id"]) for r in found if r["doc_id"] is not None) == want
    assert [r["class_id"] for r in found if r["doc_id"] is None] == [6]


def test_shared_passages_weigh_less_than_own_words(spark):
    """Six of 300 texts share 90 shingles and have 10 of their own: 0.82 alike if all weigh the same, 0.77 by document frequency."""
    rnd = random.Random(6)
    new = lambda n: " ".join(f"w{rnd.randint(0, 10**9)}" for _ in range(n))
    passage = new(94)
    rows = [(i, f"{passage} {new(10)}") for i in range(6)] + [(i, new(20)) for i in range(6, 300)]
    found = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in found) == [(i, i) for i in range(300)]


def test_near_copies_in_a_group_of_a_large_corpus(spark):
    """120 of 20,000 texts are one text with 2 of its 120 words changed, 0.84 alike if all shingles weigh the same."""
    rnd = random.Random(21)
    base = [f"base{i}" for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(20)]
    for i in range(20, 120):
        words = list(base)
        words[10 + i % 8 * 5], words[65 + i % 9 * 5] = f"a{i}", f"b{i}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(f"w{rnd.randint(0, 10**9)}" for _ in range(8))) for i in range(120, 20_000)]
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == [(i, 0 if i < 120 else i) for i in range(20_000)]


def test_similarity_in_groups_of_equal_share_does_not_fall_with_the_corpus():
    """A text and its copy with 2 of 120 words changed, in a group of near copies that is 0.6 % of all texts, from 10,000 to 300 million."""
    a, b = np.arange(116), np.concatenate([np.arange(10, 116), np.arange(200, 210)])
    found = []
    for total in (10_000, 300_000, 3_000_000, 300_000_000):
        found.append(shingles.jaccard(*((x.astype(np.uint64), shingles.weights(total, np.ones(len(x)), np.where(x < 200, total * 6 // 1000, 1))) for x in (a, b))))
    assert max(found) - min(found) < 1e-9 and min(found) >= neardup.SIMILARITY


def test_one_of_each_stays(spark):
    rows = near_rows()
    kept = neardup.one_of_each(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "keep"]
    ids = sorted(r["doc_id"] for r in kept.collect())
    classes = brute_classes(rows)
    first = {}
    for (d, t), c in zip(rows, classes, strict=True):
        if t and re.search("[a-zA-Z]", t):
            first[c] = min(first.get(c, 1 << 60), d if d is not None else 1 << 60)
    assert ids == sorted([*first.values(), 200, 201, 202])
    assert neardup.near_duplicates(frame(spark, rows).filter("false")).count() == 0


def test_repeated_rows_without_words_stay(spark):
    rows = [(1, "..."), (1, "..."), (2, "one two three"), (2, "one two three"), (3, " "), (3, " ")]
    assert sorted(r["doc_id"] for r in neardup.one_of_each(frame(spark, rows)).collect()) == [1, 1, 2, 3, 3]


def test_words_that_collide_in_polynomial_hashes_are_no_copies(spark):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word + "!"), (4, "x" * 130), (5, "x" * 66), (6, "x" * 2 + "y" + "x" * 127)]
    found = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in found) == [(1, 1), (2, 2), (3, 1), (4, 4), (5, 5), (6, 6)]


def test_near_copies_of_megabytes(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(300_000)]
    other = list(base)
    for i in range(0, len(other), 100):
        other[i] = f"edit{i}"
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(200_000))), (4, "short text")]
    found = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in found) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_recall_at_the_threshold(spark):
    """Pairs of texts by twos, from just over the threshold up; nearly all must be found."""
    rnd = random.Random(15)
    rows = []
    for k in range(300):
        words = [f"p{k}x{i}" for i in range(200)]
        other = list(words)
        for i in rnd.sample(range(len(words)), rnd.choice([1, 2, 3])):
            other[i] = f"e{k}x{i}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    classes = brute_classes(rows)
    linked = [k for k in range(300) if classes[2 * k] == classes[2 * k + 1]]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert len(linked) > 200 and sum(got[2 * k] == got[2 * k + 1] for k in linked) >= 0.99 * len(linked)
    assert all(got[2 * k] != got[2 * k + 1] for k in set(range(300)) - set(linked))


@pytest.mark.parametrize("name", ["d", "_r", "_row", "_doc", "row", "worded", "c0", "label"])
def test_columns_of_any_name_pass_through(spark, name):
    df = spark.createDataFrame([(1, "one two three four five six", "m"), (2, "one two three four five six", "n"), (3, None, "o")], f"doc_id long, text string, `{name}` string")
    assert sorted((r["doc_id"], r[name]) for r in neardup.one_of_each(df).collect()) == [(1, "m"), (3, "o")]
    marked = line_dedup.with_bitmaps(df)
    assert marked.columns == [*df.columns, "keep", "n_dropped"] and sorted(r[name] for r in marked.collect()) == ["m", "n", "o"]
    found = decontaminate.contamination(df, spark.createDataFrame([(1, "one two")], "item_id long, text string"), keep=("text", name))
    assert sorted((r[name], len(r["spans"])) for r in found.collect()) == [("m", 1), ("n", 1), ("o", 0)]


def test_documents_of_very_many_lines(spark):
    lines = [f"line number {i}" for i in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(reversed(lines))), (3, "\n".join(["own line of three", *lines[:5]]))]
    marked = line_dedup.with_bitmaps(frame(spark, rows)).withColumn("kept", line_dedup.kept_text(F.col("text"), F.col("keep")))
    got = {r["doc_id"]: (r["n_dropped"], r["kept"]) for r in marked.select("doc_id", "n_dropped", "kept").collect()}
    assert got == {1: (0, rows[0][1]), 2: (200_000, ""), 3: (5, "own line of three")}


def test_benchmark_in_texts_of_megabytes(spark):
    item = " ".join(f"bench{i}" for i in range(30))
    body = " ".join(f"w{i}" for i in range(400_000))
    rows = [(1, f"{body} {item} {body}"), (2, body), (3, " ".join([item] * 20_000))]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontaminate.contamination(frame(spark, rows), bench, keep=("text",)).withColumn("clean", decontaminate.without_spans(F.col("text"), F.col("spans")))
    got = {r["doc_id"]: (len(r["spans"]), r["n"]) for r in found.select("doc_id", "spans", F.length("clean").alias("n")).collect()}
    assert got == {1: (1, 2 * len(body) + 1), 2: (0, len(body)), 3: (1, 0)}


def test_repeats_in_texts_of_megabytes(spark):
    rnd = random.Random(8)
    a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(1_000_000)) for _ in range(2))
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in substring_dedup.dedup(frame(spark, [(1, a), (2, b + a[1000:900_000] + b[:5000])])).collect()}
    assert got[1] == (0, 0, a.encode()) and got[2] == (904_000, 1, b.encode())


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(1, 1 << 62, 300, np.uint64))
    other = base.copy()
    other[:45] = rng.integers(1, 1 << 62, 45, np.uint64)
    other = np.sort(other)
    w = np.ones(300)
    s = shingles.weighted_samples(np.concatenate([base, other]), np.concatenate([w, w]), np.array([0, 300, 600]), 3000, 1)
    assert abs((s[0] == s[1]).mean() - shingles.jaccard((base, w), (other, w))) < 0.04


def test_samples_need_few_draws_and_leave_none_out(monkeypatch):
    """Most shingles of a text are ruled out by 32 bits; what is then taken is what all draws give."""
    rng = np.random.default_rng(4)
    sizes = [0, 1, 1, 5, 300, 0, 2000, 700, 40_000, 300]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    h = np.concatenate([np.sort(rng.integers(1, 1 << 62, n, np.uint64)) for n in sizes])
    drawn, floor = [], np.floor
    monkeypatch.setattr(np, "floor", lambda x, *more, **named: (drawn.append(np.size(x)), floor(x, *more, **named))[1])
    for w in (np.ones(len(h)), np.where(rng.random(len(h)) < 0.1, rng.uniform(0.1, 30, len(h)), 1.0)):
        monkeypatch.setattr(shingles, "_ENOUGH", 6.0, raising=False)
        drawn.clear()
        s = shingles.weighted_samples(h, w, offsets, 16, 4)
        assert sum(drawn) < 0.1 * 64 * len(h)
        for enough in (0.01, 1e9):  # all draws of nearly all texts, and of all
            monkeypatch.setattr(shingles, "_ENOUGH", enough)
            assert (shingles.weighted_samples(h, w, offsets, 16, 4) == s).all()
        assert not s[0].any() and not s[5].any() and s[np.array(sizes) > 0].all()


@pytest.mark.parametrize("usual", [0.5, 1.0, 7.0])
def test_samples_agree_whatever_the_weights(usual):
    rng = np.random.default_rng(5)
    both = np.sort(rng.integers(1, 1 << 62, 300, np.uint64))
    a, b = (np.sort(rng.choice(300, 260, replace=False)) for _ in range(2))
    weigh = lambda x: np.where(x % 3 == 0, 1.0, np.where(x % 3 == 1, 7.0, rng.uniform(0.2, 20, len(x))))
    wa, wb = weigh(a), weigh(b)
    similar = shingles.jaccard((both[a], wa), (both[b], wb))
    for rows in (1, 2):
        s = shingles.weighted_samples(np.concatenate([both[a], both[b]]), np.concatenate([wa, wb]), np.array([0, 260, 520]), 10_000, rows, usual)
        assert abs((s[0] == s[1]).mean() - similar**rows) < 0.02


def test_words_are_told_apart_by_every_byte_and_their_length():
    words = ["a", "aa", "A" * 8, "a" * 9, "a" * 16, "a" * 17, "b" + "a" * 16, "a" * 8 + "b" + "a" * 8, "a" * 16 + "b", "é", "éa", "a" * 200, "a" * 199 + "b"]
    texts = [f"{w} , {w.upper() if w.isascii() else w}" for w in words] + ["", "..", words[0] + "-" + words[1]]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    found, cut = shingles.word_hashes(data, offsets, 2)
    assert np.diff(cut).tolist() == [2] * len(words) + [0, 0, 2]
    for h in found:
        assert (h[: 2 * len(words) : 2] == h[1 : 2 * len(words) : 2]).all() and len(set(h.tolist())) == len(words)
        assert h[-2:].tolist() == [h[0], h[2]]
    assert not np.isin(*found).any()


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        own = words_of(t)
        k = min(10, len(own))
        if not k:
            continue
        spans = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in spans:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(words), sorted(hit), sorted(found)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 3])
def test_contamination_equals_brute_force(spark, broadcast_bytes):
    rnd = random.Random(4)
    items = [(i, sentence(rnd, n)) for i, n in enumerate([30, 12, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 11, 25])] + [(20, None), (21, "..."), (22, "Épsilon ÉPSILON zz9"), (0, "repeated id alpha1 beta2")]
    rows = [(200, None), (201, ""), (202, "--"), (203, items[0][1].upper()), (204, "x, " + items[1][1].replace(" ", "  -- ") + "\ny"), (205, "épsilon ÉPSILON ZZ9")]
    for i in range(60):
        words = sentence(rnd, rnd.randint(1, 60)).split()
        for _ in range(rnd.randint(0, 2)):
            own = rnd.choice(items[:14])[1].split()
            a = rnd.randrange(len(own))
            at = rnd.randrange(len(words) + 1)
            words[at:at] = own[a : a + rnd.randint(1, 20)]
        rows.append((i, " ".join(words)))
    rows.append(rows[-1])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), bench, keep=("text",), broadcast_bytes=broadcast_bytes).collect()
    assert len(got) == len(rows)
    assert any(r["spans"] for r in got)
    for r in got:
        n, hit, found = brute_hits(r["text"], items)
        assert r["n_words"] == n and [p for s in r["spans"] for p in range(s["start"], s["stop"])] == hit and r["item_ids"] == found
    cut = decontaminate.contamination(frame(spark, rows), bench, keep=("text",)).withColumn("clean", decontaminate.without_spans(F.col("text"), F.col("spans"))).filter("text is not null")
    for r in cut.collect():
        _, hit, _ = brute_hits(r["text"], items)
        assert words_of(r["clean"]) == [w for i, w in enumerate(words_of(r["text"])) if i not in set(hit)]
    assert decontaminate.contamination(frame(spark, rows).filter("false"), bench).count() == 0
    assert decontaminate.contamination(frame(spark, rows), bench.filter("false")).filter("size(spans) = 0").count() == len(rows)


def test_substrings_equal_brute_force(spark):
    rnd = random.Random(3)
    parts = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(3, 60))) for _ in range(40)]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20)))) for i in range(60)]
    rows += [(200, None), (201, ""), (202, "a" * 900), (203, "ab" * 300), (204, "a" * 333), (205, rows[3][1]), (206, rows[3][1]), (3, rows[3][1]), (None, rows[4][1])]
    seen, want = set(), []
    for d, t in sorted(rows, key=lambda r: (1 << 60 if r[0] is None else r[0])):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        again = [x for x in want if x[0] == d and d == 3]
        if again:
            want.append(again[0])
            continue
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        want.append((d, len(raw), sum(gone), sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1])), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in substring_dedup.dedup(frame(spark, rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert substring_dedup.dedup(frame(spark, rows).filter("false")).count() == 0


def test_lines_equal_brute_force(spark):
    rnd = random.Random(6)
    pool = [f"  Common Line number {i}\t" for i in range(12)] + ["short", "", "Éa tied line É", "ten chars!"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.6 else f"own line {i} {rnd.random()}" for _ in range(rnd.randint(1, 80)))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, rows[0][1]), (203, rows[0][1]), (204, "COMMON LINE NUMBER 3"), (7, "common line number 3\nelse entirely new"), (None, "common line number 4")]
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    order = lambda d: 1 << 60 if d is None else d
    owner, many = {}, {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                owner[key(x)] = min(owner.get(key(x), 1 << 61), order(d))
                many.setdefault(key(x), set()).add(order(d))
    want = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(many.get(key(x), ())) < 2 or owner[key(x)] == order(d)]
        want.append((order(d), len(lines) - len(kept), "\n".join(kept)))
    for salts in (1, 64):
        marked = line_dedup.with_bitmaps(frame(spark, rows), salts=salts).withColumn("kept", line_dedup.kept_text(F.col("text"), F.col("keep"))).collect()
        assert sorted((order(r["doc_id"]), r["n_dropped"], r["kept"]) for r in marked) == sorted(want)
    assert line_dedup.with_bitmaps(frame(spark, rows).filter("false")).count() == 0


def test_line_digest(spark, tmp_path):
    spark.createDataFrame([(1, "a line of text\nb"), (2, "A LINE OF TEXT ")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in line_dedup.query(spark, str(tmp_path)).collect()}
    assert (got[1]["n_dropped"], got[2]["n_dropped"], got[2]["n_lines"]) == (0, 1, 1) and got[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
