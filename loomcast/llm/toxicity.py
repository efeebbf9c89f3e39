"""Operator 5: toxicity by compression distance.

Two dictionaries are trained apart, on whole ordinary texts (by zstandard) and on whole toxic texts: the latter holds the
passages of toxic text, of any words, whose byte runs more toxic texts have than the ordinary ones let expect. Only
copies of a whole text are left out. Texts are cut into windows of whole tokens, and each window is compressed twice: with the
ordinary dictionary, and with the toxic one in front of the ordinary one. What both sides know costs alike that way; with the toxic
dictionary by itself, most of the difference would be ordinary words that only one of two dictionaries happens to hold (figures in
the README). The bytes saved are the window's gain. A document's gains (the highest, the sums of the highest two and four, mean,
shares above two thresholds, and the number of windows) go to a logistic calibration, which makes the score.

Training reads a bounded sample of labelled rows: at most ``sample`` rows of each class, those of smallest hash of
doc_id, no text over ``longest`` bytes; of these, all windows. Scoring covers whole texts of all rows and is narrow: no shuffle.

Defined cases: a null or empty text has no windows and gets the score of no gain. A document with several labels takes
part once for each. If a class lacks rows to train on, every score is the share of toxic labels in the sample (0.0
without any). A very long text is scored whole, a slice by itself; ties in gains don't matter. Repeated rows score alike. A
null doc_id never trains and is not held out. Extra columns pass through; ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_text, ranges

SAMPLE, LONGEST = 3000, 1 << 16
TOKENS, CHUNK = 8, 512  # tokens of a window; bytes at which a longer one is cut
ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 15_000, 3_400, 12
THRESHOLD = 0.7
#: Bytes of a run, bits of the table that counts them, and the longest passage taken as one.
RUN, RUN_BITS, PASSAGE = 6, 22, 64
#: Standard deviations of chance taken off a run's excess: what is surest goes in first, the others while there is room.
DOUBTS = (4.75, 2.0)


def held_out(doc: Column) -> Column:
    return F.crc32(doc.cast("string").cast("binary")) % 3 == 1


def windows(data: np.ndarray, offsets: np.ndarray, tokens: int = TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of each window: runs of ``tokens`` tokens with the white space after them."""
    n = len(data)
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    space = blank[data]
    begin = ~space
    begin[1:] &= space[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begin[first[~space[first]]] = True
    at = np.flatnonzero(begin)
    own = np.searchsorted(offsets, at, "right") - 1
    rank = np.arange(len(at)) - np.searchsorted(own, own)
    start = np.union1d(at[(rank % tokens == 0) & (rank > 0)], first)
    length = np.diff(np.append(start, n))
    if len(length) and length.max() > CHUNK:
        parts = -(-length // CHUNK)
        start = np.repeat(start, parts) + ranges(np.zeros(len(parts)), parts) * CHUNK
        length = np.diff(np.append(start, n))
    return start, length, np.searchsorted(offsets, start, "right") - 1


class Model:
    """Dictionaries and calibration; small, and sent along with the tasks."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None, centre=None, spread=None, share: float = 0.0):
        self.ordinary, self.toxic, self.weights, self.centre, self.spread, self.share = ordinary, toxic, weights, centre, spread, share
        self._compressors = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def compressors(self):
        if self._compressors is None:
            self._compressors = []
            for raw in (self.ordinary, self.toxic + self.ordinary):
                how = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=64, dict_size=len(self.toxic) + len(self.ordinary), write_content_size=0, write_checksum=0, write_dict_id=0)
                known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=how)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how))
        return self._compressors

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        start, length, own = windows(data, offsets)
        out = np.zeros((n, 7))
        if not len(start):
            return out
        cut = zstandard.BufferWithSegments(data.tobytes(), np.column_stack([start, length]).astype("=u8").tobytes())
        plain, toxic = (np.fromiter((len(x) for x in c.multi_compress_to_buffer(cut, threads=1)), np.int64, len(start)) for c in self.compressors())
        gain = (plain - toxic).astype(np.float64)
        order = np.lexsort((-gain, own))
        gain, own = gain[order], own[order]
        count = np.bincount(own, minlength=n)
        rank = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        some = np.maximum(count, 1)
        for k, top in enumerate((1, 2, 4)):
            out[:, k] = np.bincount(own, gain * (rank < top), n)
        out[:, 3] = np.bincount(own, gain, n) / some
        out[:, 4] = np.log(some)
        out[:, 5] = np.bincount(own, gain >= 3, n) / some
        out[:, 6] = np.bincount(own, gain >= 5, n) / some
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.share)
        z = self.weights[0] + (features - self.centre) / self.spread @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def runs(text: bytes) -> np.ndarray:
    """Place in the table of each run of ``RUN`` bytes of ``text``."""
    data = np.frombuffer(text, np.uint8)
    n = len(data) - RUN + 1
    h = np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(RUN if n > 0 else 0):
            h = h * np.uint64(0x100000001B3) + data[k : k + n] + np.uint64(1)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - RUN_BITS)).astype(np.int64)


def texts_with(texts: list[bytes]) -> np.ndarray:
    """For each place of the table, how many texts have such a run."""
    held = np.zeros(1 << RUN_BITS, np.int32)
    for t in texts:
        held[np.unique(runs(t))] += 1
    return held


def toxic_dictionary(toxic: list[bytes], ordinary: list[bytes], size: int) -> bytes:
    """Passages of the toxic texts that hold most of what sets them apart, for each byte; the best are last.

    A passage is a stretch of runs that more toxic texts have than expected, be they words, parts or phrases. Passages
    are taken greedily: what one has brought counts no more for others.
    """
    share = len(toxic) / len(ordinary)
    there, other = texts_with(toxic).astype(np.float64), share * texts_with(ordinary)
    spread = np.sqrt(there + share * other + share + 1)
    taken, room, gone = [], size, np.zeros(1 << RUN_BITS, bool)
    for doubt in DOUBTS:
        excess = np.where(gone, 0.0, np.maximum(there - other - doubt * spread, 0.0))
        found: dict[bytes, float] = {}
        for t in toxic:
            at = runs(t)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], excess[at] > 0, [0]]).astype(np.int8)))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                for s in range(a, b, PASSAGE):
                    e = min(s + PASSAGE, b)
                    passage = t[s : e + RUN - 1]
                    if passage not in found:
                        found[passage] = excess[np.unique(at[s:e])].sum() / len(passage)
        heap = [(-worth, passage) for passage, worth in found.items()]
        heapq.heapify(heap)
        while heap and room > 0:
            _, passage = heapq.heappop(heap)
            at = np.unique(runs(passage))
            worth = -excess[at].sum() / len(passage)
            if worth < 0 and heap and worth > heap[0][0]:
                heapq.heappush(heap, (worth, passage))
            elif worth < 0:
                taken.append(passage)
                room -= len(passage)
                excess[at], gone[at] = 0.0, True
    return b"".join(reversed(taken))[-size:]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size + 1400, samples).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    if not toxic or not ordinary:
        return Model(b"", b"", None, share=float(bool(toxic)))
    data, offsets = packed(ordinary)
    start, length, _ = windows(data, offsets)
    raw = data.tobytes()
    content = toxic_dictionary(toxic, ordinary, TOXIC_BYTES) or dictionary(toxic, TOXIC_BYTES)
    model = Model(dictionary([raw[s : s + n] for s, n in zip(start.tolist(), length.tolist(), strict=True)], ORDINARY_BYTES), content, None)
    x = np.concatenate([model.features(*packed(toxic)), model.features(*packed(ordinary))])
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(ordinary))])
    centre, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / spread]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [1.0] * (len(w) - 1))
    # Classes weigh as they would if a tenth of all rows were toxic, so that scores don't hang on how the sample was drawn.
    rows = np.where(y == 1, 0.1 * len(y) / len(toxic), 0.9 * len(y) / len(ordinary))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        w -= np.linalg.solve((z * (rows * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (rows * (p - y)) + ridge @ w)
    model.weights, model.centre, model.spread = w, centre, spread
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, doc: str = "doc_id", text: str = "text") -> Model:
    """A model from at most ``sample`` rows of each class outside the held-out third."""
    ids = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).filter("_id is not null and _toxic in (0, 1)").filter(~held_out(F.col("_id")))
    drawn = [ids.filter(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample) for c in (0, 1)]
    rows = docs.select(F.col(doc).alias("_id"), F.col(text).alias("_text")).filter(F.octet_length("_text") <= longest)
    # Each row drawn brings one text to the driver: 2 * sample rows bound both the broadcast and what comes back.
    found = rows.join(F.broadcast(drawn[0].unionByName(drawn[1])), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")).collect()
    by = {c: [r["_text"].encode() for r in sorted(found, key=lambda r: r["_id"]) if r["_toxic"] == c and r["_text"]] for c in (0, 1)}
    return fit(by[1], by[0])


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``score`` (double, 0 to 1) and ``predicted`` (int)."""

    def run(data, offsets):
        s = model.scores(model.features(data, offsets))
        return [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())]

    return map_text(df, run, {"score": "double", "predicted": "int"}, text, keep)


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    return train(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def query(spark, sf_dir: str) -> DataFrame:
    scored = score(documents(spark, sf_dir), model_for(spark, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
