"""Operator 2: byte-level BPE encoding and decoding of whole texts.

The merges run through the rank queue of :mod:`.bpe`. Both directions are narrow transformations: no shuffle, and each
task holds a slice of rows, so that plans scale with the number of input splits.

Defined cases: a null or empty text has no tokens and decodes to no bytes; null ids likewise. Row order and repeated
rows don't matter. A very long text is a slice of its own; a very long pre-token is merged in time that grows with its
length. Extra columns pass through; one named like an added column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import binary_array, documents, map_text


def encode(df: DataFrame, ranks_path: str, text: str = "text", keep: list[str] | None = None, verify: bool = False) -> DataFrame:
    """Adds ``token_ids`` (binary: little-endian unsigned 32-bit ids) and ``n_tokens`` (long).

    ``verify``: the ids of each slice are decoded at once, and an error is raised unless they give the texts' bytes.
    """

    def run(data, offsets):
        ids, cut = bpe.memo_of(ranks_path).ids(data, offsets)
        if verify:
            again, at = bpe.decode(bpe.ranks_of(ranks_path), ids, cut)
            if not (np.array_equal(again, data) and np.array_equal(at, offsets)):
                raise ValueError("token ids don't decode to their text")
        return [binary_array(ids.astype("<u4").view(np.uint8), cut * 4), pa.array(np.diff(cut), pa.int64())]

    return map_text(df, run, {"token_ids": "binary", "n_tokens": "bigint"}, text, keep)


def decode(df: DataFrame, ranks_path: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of the tokens in ``ids``. An id outside the vocabulary raises."""

    def run(data, offsets):
        found = np.ascontiguousarray(data).view("<u4")
        out, cut = bpe.decode(bpe.vocabulary_of(ranks_path), found, offsets // 4)
        return [binary_array(out, cut)]

    return map_text(df, run, {"decoded": "binary"}, ids, keep)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = encode(documents(spark, sf_dir), path, keep=["doc_id"])
    return decode(coded, path).select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
