"""Operator 6: benchmark decontamination, by DataFrame functions only.

A window is 10 consecutive words of a benchmark item, or the whole of a shorter one. The set of item n-grams is broadcast
(its bytes are checked first; a larger set is joined by a salted shuffle instead), and the token windows of each text are
scanned: any window of w words covers an aligned run of m = (w + 1) // 2 words, so only every m-th run of a text is looked up.
Each hit is verified by the full windows around it, word for word. Text never leaves its row; only hits are grouped, by
document, so that a passage shared by a third of the corpus makes no hot group. The few documents that are hit are stored,
and join the others by a 128-bit key of doc_id and text: by broadcast if their bytes allow it.

Defined cases: null and empty texts have no words and no hits; so do items. Rows that share doc_id and text are one
document to the scan and come back as many rows. Rows that share only doc_id are told apart. Repeated items count by
their own item_id. A very long text is one row's work, in proportion to its words; so is cutting spans out of it. Extra
columns are not read; those in ``keep`` pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, stored

WINDOW = 10
#: Fixed by the contract: what separates words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that may be broadcast, and parts of a key where a shuffle takes their place.
BROADCAST_BYTES, SALTS = 64 << 20, 32


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; ``lower`` does just that where all is ASCII, and is much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def until(n: Column, function) -> Column:
    """Array of function(0), ..., function(n - 1); empty if n < 1."""
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), function)


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, w, m, words) for each window of each item."""
    found = items.select("item_id", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words")).filter("n > 0")
    found = found.withColumn("w", F.least(F.col("n"), F.lit(window)))
    each = found.select("item_id", "w", F.explode(until(F.col("n") - F.col("w") + 1, lambda i: F.slice("words", i + 1, F.col("w")))).alias("words"))
    return each.withColumn("m", F.expr("(w + 1) div 2")).distinct()


def keys_of(doc: str, text: str) -> list[Column]:
    return [F.xxhash64(doc, text).alias("_key"), F.xxhash64(F.lit(1), F.col(doc), F.col(text)).alias("_key2")]


def met(rows: DataFrame, others: DataFrame, on: list[str], size: Column, broadcast_bytes: int) -> DataFrame:
    """Inner join with ``others``, which are distinct in ``on``: broadcast if their ``size`` adds up to few bytes, or else
    by a shuffle in which each key has ``SALTS`` parts."""
    if (others.agg(F.sum(size)).first()[0] or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(others), on)
    salted = others.withColumn("_salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    return rows.withColumn("_salt", F.pmod("_key2", F.lit(SALTS)).cast("int")).join(salted, [*on, "_salt"]).drop("_salt")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(``_key``, ``_key2``, ``spans``, ``item_ids``) of the documents that have any.

    ``spans``: sorted, disjoint word ranges [start, stop) that are hit. ``item_ids``: sorted as strings.
    """
    windows = windows_of(items, window)
    grams = windows.select("m", F.explode(until(F.col("w") - F.col("m") + 1, lambda i: F.xxhash64(F.slice("words", i + 1, F.col("m"))))).alias("gram")).distinct()
    keyed = windows.select("item_id", "w", F.array_join("words", " ").alias("window")).groupBy("w", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    shapes = sorted((r["m"], r["w"]) for r in windows.select("m", "w").distinct().collect())  # as many as window lengths, at most

    words = words_of(F.col(text))
    run = "array<struct<m:int,p:int,gram:bigint>>"

    def aligned(m: int) -> Column:
        return until(F.expr(f"size(_words) div {m}"), lambda k: F.struct(F.lit(m).alias("m"), (k * m).alias("p"), F.xxhash64(F.slice("_words", k * m + 1, F.lit(m))).alias("gram"))).cast(run)

    # The scan passes on where a run is, never the words, which would be copied for each of the text's runs.
    runs = [aligned(m) for m in sorted({m for m, _ in shapes})] or [F.array().cast(run)]
    rows = docs.select(*keys_of(doc, text), words.alias("_words")).select("_key", "_key2", F.inline(F.concat(*runs)))
    places = met(rows, grams, ["m", "gram"], F.lit(20), broadcast_bytes).groupBy("_key", "_key2").agg(F.collect_set(F.struct("m", "p")).alias("_at"))
    places = stored(places, "places")
    few = (places.agg(F.sum(32 + 8 * F.size("_at"))).first()[0] or 0) <= broadcast_bytes

    def nearby(at: Column, m: int, w: int) -> Column:
        """Windows of w words that cover the run of m words at p."""
        first = F.greatest(F.lit(0), at["p"] - F.lit(w - m))
        count = F.when(at["m"] == m, F.least(at["p"], F.size("_words") - F.lit(w)) - first + 1).otherwise(0)
        return until(count, lambda i: F.struct((first + i).alias("start"), F.lit(w).alias("w"), F.array_join(F.slice("_words", first + i + 1, F.lit(w)), " ").alias("window")))

    tried = F.transform("_at", lambda at: F.concat(*(nearby(at, m, w) for m, w in shapes))) if shapes else F.array().cast("array<array<struct<start:int,w:int,window:string>>>")
    # Of the documents that have a run, once each.
    again = docs.select(*keys_of(doc, text), F.col(text).alias("_text")).join(F.broadcast(places) if few else places, ["_key", "_key2"])
    each = again.select("_key", "_key2", "_at", words_of(F.col("_text")).alias("_words")).select("_key", "_key2", F.inline(F.flatten(tried)))
    found = met(each, keyed, ["w", "window"], F.octet_length("window") + 24 * F.size("ids") + 32, broadcast_bytes)
    grouped = found.groupBy("_key", "_key2").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("w")).alias("stop"))).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"),
    )
    # A span begins and ends where the words that are hit do. A one-element array binds these, which are used many times.
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda x: F.sequence(x["start"], x["stop"] - 1)))))
    begins = lambda at: F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    ends = lambda at: F.filter(at, lambda p, i: F.coalesce(F.get(at, i + 1) != p + 1, F.lit(True)))
    joined = F.get(F.transform(F.array(covered), lambda at: F.zip_with(begins(at), ends(at), lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))), 0)
    return grouped.select("_key", "_key2", joined.alias("spans"), "item_ids")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc``, ``n_words``, ``spans``, ``item_ids`` (see :func:`hits`; empty without any), and ``keep``: one row for each row of ``docs``."""
    marks = stored(hits(docs, items, window, doc, text, broadcast_bytes), "hits")
    size = marks.agg(F.sum(48 + 8 * F.size("spans") + F.aggregate("item_ids", F.lit(0), lambda n, x: n + 24 + F.octet_length(x)))).first()[0] or 0
    keep = tuple(c for c in keep if c not in (doc, "n_words", "spans", "item_ids"))
    # Columns passed on travel as one, so that their names don't matter here.
    passed = F.struct(F.col(doc).alias("doc"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep))).alias("_kept")
    every = docs.select(passed, *keys_of(doc, text), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    joined = every.join(F.broadcast(marks) if size <= broadcast_bytes else marks, ["_key", "_key2"], "left")
    return joined.select(
        F.col("_kept.doc").alias(doc), *(F.col(f"_kept.c{i}").alias(c) for i, c in enumerate(keep)), "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` with the words of ``spans`` cut out, and the separators that follow them. The text is cut into words once."""
    letter, other = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    words = F.regexp_extract_all(text, F.lit(f"{letter}++{other}*+"), F.lit(0))

    def between(words, i):
        """The words after span i - 1 and before span i."""
        start = F.when(i > 0, F.get(spans, i - 1)["stop"]).otherwise(0)
        stop = F.when(i < F.size(spans), F.get(spans, i)["start"]).otherwise(F.size(words))
        return F.slice(words, start + 1, stop - start)

    # A one-element array binds the words, which are used for each span.
    kept = F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: between(w, i))), ""))
    return F.concat(F.regexp_extract(text, f"^{other}*+", 0), F.get(kept, 0))


def query(spark, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
with words as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as win
  from (select item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from words where len(w) > 0)),
docs as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
spots as (
  select r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
  from (select r, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from docs, (select distinct k from windows) where len(w) >= k)),
hits as (select s.r, s.i, s.k, x.item_id from spots s join windows x on s.k = x.k and s.win = x.win),
positions as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + k - 1)) as p from hits) group by r),
items as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join positions using (r) left join items using (r)
"""
