"""Operator 3: sharding by a two-pass external shuffle.

Pass 1 scatters the rows into buckets that fit in memory, by seeded hashes of the row; pass 2 shuffles each bucket by
Fisher-Yates and writes it. A row's shard follows the law ``key``: doc_id and shard count alone decide, by a sequence
of seeded questions, so that one more shard takes rows only into itself. A shard is a whole number of buckets, and slots
run through them without gaps.

The number of buckets follows the input's bytes. Text is shuffled once. Which bucket a row is in and where depends on the
row alone, never on order of arrival, so that a lost executor's work is repeated alike.

Defined cases: a null text has no bytes (size 1, crc 0) and stays null; a null doc_id hashes like a key of its own.
Rows that share a doc_id share a shard and are spread over its buckets by text; rows alike in both have neighbouring
buckets' odds but distinct slots. A very long text makes its bucket as much larger. An empty table gives an empty result. Extra columns pass through; those named like an
added column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, scratch, split_count

SHARDS, SEED, BUCKET_BYTES = 8, 20240607, 32 << 20
MOST_TASKS = 100_000
ADDED = ("shard", "grown_shard", "bucket", "slot")


def jump_column(key: Column, shards: int) -> Column:
    """The shard of ``key`` as a column: the last candidate below ``shards`` of a seeded sequence.

    Shard s takes over from an earlier one with odds 1 in s + 1, by a hash of the key and s alone; going from n to n + 1
    shards only asks one more such question, so that rows move into the new shard or stay.
    """
    out = F.lit(0)
    for s in range(1, shards):
        out = F.when(F.pmod(F.xxhash64(F.lit(SEED), key, F.lit(s)), F.lit(s + 1)) == 0, F.lit(s)).otherwise(out)
    return out


def bucketed(df: DataFrame, shards: int, buckets: int, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Pass 1's assignment: ``shard``, ``grown_shard`` (with one more) and ``bucket``, numbered through the shards."""
    spread = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col(doc), F.col(text)), F.lit(buckets)).cast("int")
    return df.withColumns({"shard": jump_column(F.col(doc), shards), "grown_shard": jump_column(F.col(doc), shards + 1)}).withColumn("bucket", F.col("shard") * F.lit(buckets) + spread)


def shard(df: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``df`` and ``shard``, ``grown_shard``, ``bucket``, ``slot``, in shuffled order within each bucket."""
    names = [c for c in df.columns if c not in ADDED]
    total = df.agg(F.sum(F.octet_length(text) + 64)).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    # Columns passed on travel as one, so that their names don't matter here.
    row = F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(names))).alias("row")
    order = F.xxhash64(F.lit(SEED + 2), F.col(doc), F.col(text)).alias("order")
    placed = bucketed(df.select(row, order, F.col(doc).alias("doc"), F.col(text).alias("text")), shards, buckets, "doc", "text").drop("doc", "text")
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    first = F.coalesce(F.sum("rows").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # As many tasks as buckets, within what a driver can plan: the number follows the bytes, and a task shuffles a bucket at a time.
    tasks = max(split_count(df.sparkSession), min(shards * buckets, MOST_TASKS))
    joined = placed.repartition(tasks, "bucket").join(sizes.select("bucket", first.alias("slot")), "bucket").select("row", "order", *ADDED)
    schema = joined.drop("order").schema

    def fisher_yates(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        bucket = int(table.column("bucket")[0].as_py())
        seat = np.argsort(table.column("order").to_numpy(), kind="stable").tolist()
        draws = np.random.Generator(np.random.PCG64([SEED, bucket])).integers(0, np.arange(len(seat), 0, -1)).tolist()
        for k, j in enumerate(draws):
            last = len(seat) - 1 - k
            seat[j], seat[last] = seat[last], seat[j]
        out = table.take(pa.array(seat)).drop_columns(["order"])
        slot = out.column("slot").to_numpy() + np.arange(len(seat))
        return out.set_column(out.schema.get_field_index("slot"), "slot", pa.array(slot, pa.int64())).select(schema.names)

    made = joined.groupBy("bucket").applyInArrow(fisher_yates, schema)
    return made.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)), *ADDED)


def write_shards(df: DataFrame, path: str, **options) -> DataFrame:
    """Writes the shards below ``path``, a folder for each (``shard=N``), and returns them as read back."""
    made = shard(df, **options)
    made.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    read = write_shards(documents(spark, sf_dir).select("doc_id", "text"), scratch(spark, "shards"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return read.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.col("grown_shard").cast("int").alias("grown_shard"), "bucket",
    )
