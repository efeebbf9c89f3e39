"""Operator 10: line deduplication, by DataFrame functions only.

A line's key is hashed to 128 bits. Rounds of one operator decide: hashes are range-partitioned, sorted within by hash,
document and position, and a running window passes on the document of each hash's first occurrence; later documents'
lines are dropped. The first round does this within salted parts of a hash (the salt is a hash of the document), so that
a line found in a third of all documents is spread over many tasks; what is left of it is one document for each
salt, and the second round decides between these. No text is shuffled: the result is, for each document that loses lines,
a bitmap of the kept ones, compressed to the 32-line words that aren't all ones.

Defined cases: a null or empty text is one empty line. A key under ``shortest`` code points is never dropped. A null
doc_id sorts after all others. Rows that share a doc_id are one document here: neither makes the other lose lines.
Repeated rows come back repeated. Extra columns pass through. A very long text costs work in proportion to its bytes and
lines, and one row's memory, as does a document of very many lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, parts_of, stored
from .decontaminate import ascii_lower

SHORTEST, SALTS = 10, 64
ONES = (1 << 32) - 1
BROADCAST_BYTES = 64 << 20


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(" \t\n\x0b\f\r")))


def first_documents(lines: DataFrame, by: list[str], parts: int) -> DataFrame:
    """Adds ``_first``: the smallest document among the rows alike in ``by``, streamed in (document, position) order."""
    ranged = lines.repartitionByRange(parts, *by).sortWithinPartitions(*by, "_doc", "pos")
    return ranged.withColumn("_first", F.first("_doc").over(W.partitionBy(*by).orderBy("_doc", "pos").rowsBetween(W.unboundedPreceding, 0)))


def dropped_lines(docs: DataFrame, shortest: int = SHORTEST, salts: int = SALTS, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(``_row``, ``_row2``, ``pos``) of each line to drop; the first two are a 128-bit key of doc_id and text."""
    parts = parts_of(docs)
    # Keys are made before lines are taken apart: beside the generator they would be made anew, of the whole text, for each line.
    whole = docs.select(
        F.xxhash64(doc, text).alias("_row"), F.xxhash64(F.lit(1), F.col(doc), F.col(text)).alias("_row2"),
        F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)).alias("_doc"), F.col(text).alias("_text"),
    )
    lines = whole.select("_row", "_row2", "_doc", F.posexplode(lines_of(F.col("_text"))).alias("pos", "_line"))
    keyed = lines.select("_row", "_row2", "_doc", "pos", line_key(F.col("_line")).alias("_line")).filter(F.char_length("_line") >= shortest)
    hashed = keyed.select("_row", "_row2", "_doc", "pos", F.xxhash64("_line").alias("_h"), F.xxhash64(F.lit(1), F.col("_line")).alias("_h2"), F.pmod(F.xxhash64(F.lit(2), F.col("_doc")), F.lit(salts)).cast("short").alias("_salt"))
    local = first_documents(hashed, ["_h", "_h2", "_salt"], parts)
    left = local.filter("_doc = _first").select("_row", "_row2", "_doc", "pos", "_h", "_h2")
    out = ["_row", "_row2", "pos"]
    return local.filter("_doc <> _first").select(*out).unionByName(first_documents(left, ["_h", "_h2"], parts).filter("_doc <> _first").select(*out))


def keep_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """(``_row``, ``_row2``, ``keep``, ``n_dropped``) of each document that loses lines.

    ``keep`` maps the number of a 32-line word to its bits (bit i: line 32 * word + i stays); words all ones are left out.
    """
    drops = dropped_lines(docs, **options).repartition("_row", "_row2")
    words = drops.groupBy("_row", "_row2", F.expr("pos div 32").cast("int").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 32)")).alias("_bits"))
    return words.groupBy("_row", "_row2").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_word", (F.lit(ONES) - F.col("_bits")).alias("keep"))))).alias("keep"),
        F.sum(F.bit_count("_bits")).cast("long").alias("n_dropped"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The text's kept lines joined again; the text itself where ``keep`` is null.

    The bitmap is spread to one word for every 32 lines up to its last, once a text, so that each line costs one look.
    """
    entries = F.map_entries(keep)
    before = lambda known, i: F.when(i == 0, F.lit(-1)).otherwise(F.get(known, i - 1)["key"])
    spread = lambda known: F.flatten(F.transform(known, lambda e, i: F.concat(F.array_repeat(F.lit(ONES), e["key"] - before(known, i) - 1), F.array(e["value"]))))
    stays = lambda words, i: F.getbit(F.coalesce(F.get(words, F.floor(i / 32).cast("int")), F.lit(ONES)), i % 32) == 1
    # One-element arrays bind what is used many times: the entries, then the words.
    words = F.transform(F.array(entries), spread)
    kept = F.transform(words, lambda w: F.array_join(F.filter(lines_of(text), lambda x, i: stays(w, i)), "\n"))
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.get(kept, 0))


def with_bitmaps(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with ``keep`` (null: all lines stay) and ``n_dropped``; columns of these names are replaced, all others pass through.

    The bitmaps are stored. If their bytes allow it they go to the texts by broadcast; else both meet in a shuffle.
    """
    others = [c for c in docs.columns if c not in ("keep", "n_dropped")]
    marks = stored(keep_bitmaps(docs, doc=doc, text=text, **options), "bitmaps")
    if (marks.agg(F.sum(64 + 24 * F.size("keep"))).first()[0] or 0) <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    keyed = docs.select(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others))).alias("_kept"), F.xxhash64(doc, text).alias("_row"), F.xxhash64(F.lit(1), F.col(doc), F.col(text)).alias("_row2"))
    joined = keyed.join(marks, ["_row", "_row2"], "left")
    return joined.select(*(F.col(f"_kept.c{i}").alias(c) for i, c in enumerate(others)), "keep", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"))


def query(spark, sf_dir: str) -> DataFrame:
    marked = with_bitmaps(documents(spark, sf_dir).select("doc_id", "text"))
    return marked.select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), "n_dropped",
        F.sha2(kept_text(F.col("text"), F.col("keep")).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
with docs as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (select r, doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as p from docs),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
firsts as (select k, min(doc_id) as d from keyed where length(k) >= 10 group by k having count(distinct doc_id) > 1),
marked as (select r, doc_id, line, p, f.d is not null and f.d <> doc_id as gone from keyed left join firsts f using (k))
select any_value(doc_id) as doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by p) filter (where not gone), '')) as kept_sha256
from marked group by r
"""
