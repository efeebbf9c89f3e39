"""A corpus pipeline of five operators: each stage works on all that its predecessor kept.

All stages keep the columns of ``documents``, whatever others there are; the last one replaces the text by its token ids.
Rows without a text count as empty: they are not toxic by what they say, lose no lines, are nobody's copy, hold no passage and have no
tokens. A null doc_id stays. An empty table makes empty tables. Very long texts are worked on whole, one at a time in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm import bpe_codec, decontaminate, line_dedup, neardup, toxicity
from loomcast.llm.common import documents, scratch


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that no name meets an operator's own."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(others))).alias("_others"))


def unpacked(made: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """``docs``' columns again; with another ``text``, n_chars is made to match. Both come of one evaluation."""
    if text is not None:
        made = made.select("doc_id", F.struct(text.alias("text")).alias("_new"), "_others")
    others = {c: f"_others.c{i}" for i, c in enumerate(c for c in docs.columns if c not in ("doc_id", "text"))}
    columns = {c: F.col(others.get(c, c)) for c in docs.columns if c != "text" or text is None}
    if text is not None:
        columns["text"] = F.col("_new.text")
        if "n_chars" in columns:
            columns["n_chars"] = F.coalesce(F.char_length("_new.text"), F.lit(0)).cast("long")
    return made.select(*(columns[c].alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from labelled rows as :mod:`loomcast.llm.toxicity` says.

    Null and empty texts get the score of no evidence. Repeated rows share a fate.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpacked(toxicity.score(packed(docs), model).filter("predicted = 0"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document (smaller doc_id, null last) has go; all documents stay, a null text null.

    Rows of one doc_id are one document and don't take each other's lines.
    """
    marked = line_dedup.with_bitmaps(packed(docs))
    return unpacked(marked, docs, F.when(F.col("keep").isNull(), F.col("text")).otherwise(line_dedup.kept_text(F.col("text"), F.col("keep"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that of smallest doc_id (null last; ties by a hash of the text).

    Of repeated rows one stays. All rows without words stay.
    """
    return unpacked(neardup.one_of_each(packed(docs)), docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out of the texts, with the separators after them; all documents stay."""
    found = decontaminate.contamination(packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=("text", "_others"))
    return unpacked(found, docs, F.when(F.size("spans") == 0, F.col("text")).otherwise(decontaminate.without_spans(F.col("text"), F.col("spans"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``token_ids`` and ``n_tokens`` of what is left in place of the text; the ids are decoded and compared before they leave a task.

    Columns of these two names are replaced, all others stay. A null text has no tokens.
    """
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    others = [c for c in docs.columns if c not in ("text", "token_ids", "n_tokens")]
    return bpe_codec.encode(docs, path, keep=others, verify=True)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_duplicates", drop_near_duplicates), ("decontamination", cut_benchmark), ("bpe", encode)]

#: Compression, hashing and merges have no SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
