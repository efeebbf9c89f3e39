"""Operator 4: exact top-k search by pivot-table elimination.

Vectors are turned to integers, floor(scale * x). The score is the inner product; with an extra coordinate
sqrt(R^2 - |x|^2) for candidates and 0 for queries (R: the largest norm), higher score is smaller Euclidean distance.
Distances to pivots are computed once for each vector and stored with it; |d(q, p) - d(x, p)|, maximal over the pivots, bounds
a candidate's distance from below, and so its score from above.

Candidates are ordered by nearest pivot and distance to it, and stored in blocks with the range of their distances to
each pivot. Queries, a stated set, are dealt in blocks likewise. Each query starts with a floor: its k-th score among the
``seeds`` vectors of smallest hash (a bounded sample, sent along with tasks). Block pairs whose ranges rule out every
query's floor are dropped before anything is moved. In a pair that is left, a query evaluates candidates in order of their bound and
stops when the next one rules out any score that could still enter its k best, ties included, or reach its floor; only rows that reach the
floor go on to the final ranking by query.

Scores are exact: by float64 while they stay below 2**53 (by the vectors' sizes), else by whole numbers; one that a long
can't hold raises.

Defined cases: vectors that are null, empty or hold null, NaN or infinite components take no part; nor do null ids. A component
too large for a long after scaling raises. Ties go to the smaller id. A repeated id is a candidate as often as it occurs, but never
for a query of that id; of repeated query rows the smallest vector asks. Vectors of different lengths don't meet (no score).
Vectors of any length take part; a very long one makes its blocks shorter. An empty table has no result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, stored

K, SCALE, EVERY, PIVOTS, SEEDS = 20, 64, 20, 24, 1024
#: Vectors of a block at most, and components: a block's matrix takes eight bytes of memory for each.
QUERY_BLOCK, CANDIDATE_BLOCK, BLOCK_COMPONENTS = 2048, 1 << 16, 1 << 22
EXACT = 1 << 53


def integers(df: DataFrame, scale: int = SCALE, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, v): usable vectors as arrays of long."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = df.filter(F.col(key).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)

    def whole(c: Column) -> Column:
        scaled = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(scaled) < float(1 << 63), F.floor(scaled)).otherwise(F.raise_error(F.lit("a scaled component is beyond the range of long")).cast("long"))

    return usable.select(F.col(key).cast("long").alias("id"), F.transform(x, whole).alias("v"))


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products (long) of the rows of ``x`` with ``q``, exact."""
    most = x.shape[1] * max(int(x.max(initial=0)), -int(x.min(initial=0))) * max(int(q.max(initial=0)), -int(q.min(initial=0)))
    if most < EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return x.astype(np.int64) @ q.astype(np.int64)
    exact = x.astype(object) @ q.astype(object)
    if len(exact) and (max(exact) >= 1 << 63 or min(exact) < -(1 << 63)):
        raise OverflowError("a score is beyond the range of long")
    return exact.astype(np.int64)


def best_of(k: int, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places of the k highest scores, ties by id."""
    if len(scores) > 4 * k:  # whatever is below the k-th highest is out
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


class Pivots:
    """Pivots of each dimension, the largest norm, and the seeds (ids and vectors) of each dimension."""

    def __init__(self, pivots: dict, radius: float, seeds: dict):
        self.pivots, self.radius, self.seeds = pivots, radius, seeds

    def table(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Distances of lifted vectors to the pivots, which are not lifted; float32."""
        x = x.astype(np.float64)
        p = self.pivots[x.shape[1]]
        norm = (x * x).sum(1)
        lift = 0.0 if query else np.maximum(0.0, self.radius**2 - norm)
        away = (norm + lift)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
        return np.sqrt(np.maximum(0.0, away)).astype("<f4")

    def highest(self, norm: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Scores that no candidate at least ``bound`` away can pass: distance^2 = |q|^2 + R^2 - 2 score.

        The slack covers the rounding of distances to float32 and of norms to float64.
        """
        top = (norm + self.radius**2 - np.square(np.maximum(0.0, bound * (1 - 1e-6) - 1e-5 * (1.0 + self.radius)))) / 2
        return top + 1e-9 * (norm + self.radius**2) + 0.5

    def floors(self, k: int, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Of each query, the k-th highest score among the seeds; the lowest long where there are fewer."""
        out = np.full(len(ids), np.iinfo(np.int64).min)
        s_ids, s = self.seeds[q.shape[1]]
        for a in range(len(ids)):
            scores = products(s[s_ids != ids[a]], q[a])
            if len(scores) >= k:
                out[a] = np.partition(scores, len(scores) - k)[len(scores) - k]
        return out


def placed(vectors: DataFrame, pivots: Pivots, k: int, query: bool) -> DataFrame:
    """(id, v, dim, near, away, floor): each vector with its nearest pivot and, for queries, its floor."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                ids, x = part.column(0).to_numpy(), part.column(1).flatten().to_numpy().reshape(-1, d)
                table = pivots.table(x, query)
                near = table.argmin(1)
                floor = pivots.floors(k, ids, x) if query else np.zeros(len(ids), np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([int(d)] * len(ids)), pa.array(near.astype(np.int32)), pa.array(table[np.arange(len(ids)), near]), pa.array(floor)], names=["id", "v", "dim", "near", "away", "floor"])

    return vectors.select("id", "v").mapInArrow(run, "id bigint, v array<bigint>, dim bigint, near int, away float, floor bigint")


def blocks(rows: DataFrame, pivots: Pivots, size: int, query: bool) -> DataFrame:
    """(dim, ids, matrix, kind, table, low, high, floors, norm): runs of up to ``size`` vectors of one dimension, with their distances to the pivots, the
    least and largest of these for each pivot, floors, and the largest squared norm."""

    def run(batches):
        held: list = []

        def flush():
            ids, x, floors = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            table, small = pivots.table(x, query), narrow(x)
            d = x.shape[1]
            norm = float((x.astype(np.float64) ** 2).sum(1).max())
            columns = [pa.array([d]), pa.array([ids.astype("<i8").tobytes()]), pa.array([small.tobytes()]), pa.array([small.dtype.str]), pa.array([table.tobytes()])]
            columns += [pa.array([v.astype(float).tolist()], pa.list_(pa.float64())) for v in (table.min(0), table.max(0))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([floors.astype("<i8").tobytes()]), pa.array([int(floors.min())]), pa.array([norm])], names=BLOCK_NAMES)

        n = d = 0
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy()
            width = np.diff(at)
            edges = np.flatnonzero(np.diff(width)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(width)], strict=True):
                while a < b:
                    if n and width[a] != d:
                        yield flush()
                        n = 0
                    d = int(width[a])
                    most = max(1, min(size, BLOCK_COMPONENTS // d))
                    stop = min(b, a + most - n)
                    part = batch.slice(a, stop - a)
                    held.append((part.column(0).to_numpy(), part.column(1).flatten().to_numpy().reshape(-1, d), part.column(2).to_numpy()))
                    n, a = n + stop - a, stop
                    if n >= most:
                        yield flush()
                        n = 0
        if n:
            yield flush()

    return rows.select("id", "v", "floor").mapInArrow(run, BLOCK_TYPES)


BLOCK_TYPES = "dim bigint, ids binary, matrix binary, kind string, table binary, low array<double>, high array<double>, floors binary, floor bigint, norm double"
BLOCK_NAMES = [c.split()[0] for c in BLOCK_TYPES.split(", ")]


def search(k: int, pivots: Pivots, q_ids, q, q_table, floors, ids, x, table):
    """Rows (query, id, score) that reach their query's floor, the k best of each at most, and how many candidates were evaluated."""
    norm = np.square(q.astype(np.float64)).sum(1)
    out, evaluated = [], 0
    for a in range(len(q_ids)):
        bound = np.abs(table - q_table[a]).max(1) if table.shape[1] else np.zeros(len(ids), np.float32)
        most = pivots.highest(norm[a], bound.astype(np.float64))
        open_ = np.flatnonzero((most >= floors[a]) & (ids != q_ids[a]))
        order = open_[np.argsort(-most[open_], kind="stable")]
        top_s, top_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, 256
        while at < len(order):
            pick = order[at : at + step]
            if len(top_s) == k and most[pick[0]] < top_s[-1]:
                break  # nothing later reaches the k-th best, not even as a tie
            at, step = at + len(pick), min(2 * step, 1 << 13)
            evaluated += len(pick)
            s = products(x[pick], q[a])
            good = s >= floors[a]
            s, i = np.concatenate([top_s, s[good]]), np.concatenate([top_i, ids[pick[good]]])
            best = best_of(k, i, s)
            top_s, top_i = s[best], i[best]
        out.append((np.full(len(top_s), q_ids[a]), top_i, top_s))
    return [np.concatenate(c) for c in zip(*out, strict=True)], evaluated


def found(df: DataFrame, k: int = K, is_query: Column | None = None, scale: int = SCALE, vector: str = "embedding", key: str = "vec_id", pivots: int = PIVOTS, seeds: int = SEEDS) -> DataFrame:
    """(query_id, vec_id, score, evaluated, pairs): what each block pair gives on; the last two are its candidates evaluated and
    all there were, in one row with a null query_id."""
    spark = df.sparkSession
    vectors = stored(integers(df, scale, vector, key), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0).cast("double"), lambda s, c: s + c.cast("double") * c.cast("double")))
    radius = (vectors.agg(F.max(norm)).first()[0] or 0.0) * (1 + 1e-12)
    dims = [r[0] for r in vectors.select(F.size("v")).distinct().collect()]  # lengths of vectors, few
    chosen, sampled = {}, {}
    for d in dims:
        own = vectors.filter(F.size("v") == d)
        rows = own.select("v").distinct().orderBy(F.xxhash64("v")).limit(pivots).collect()
        chosen[d] = np.array([r[0] for r in rows], np.float64).reshape(-1, d)
        rows = own.orderBy(F.xxhash64(F.lit(1), "v"), "id").limit(min(seeds, max(k + 1, BLOCK_COMPONENTS // d))).collect()
        sampled[d] = (np.array([r["id"] for r in rows], np.int64), np.array([r["v"] for r in rows], np.int64).reshape(-1, d))
    held = Pivots(chosen, radius, sampled)
    asked = vectors.filter(F.col("id") % EVERY == 0 if is_query is None else is_query).groupBy("id").agg(F.min("v").alias("v"))

    # Both numbers of blocks follow the input; while it is small, there are enough pairs of them for all cores.
    n, m = vectors.count(), asked.count()
    cores = spark.sparkContext.defaultParallelism
    q_parts = max(1, -(-m // QUERY_BLOCK))
    c_parts = max(1, -(-n // CANDIDATE_BLOCK), min(-(-n // 2048), -(-2 * cores // q_parts)))

    def laid_out(rows: DataFrame, query: bool, parts: int, size: int) -> DataFrame:
        ordered = placed(rows, held, k, query).repartitionByRange(parts, "dim", "near", "away", "id").sortWithinPartitions("dim", "near", "away", "id")
        return stored(blocks(ordered, held, size, query), "blocks")

    candidates = laid_out(vectors, False, c_parts, CANDIDATE_BLOCK)
    questions = laid_out(asked, True, q_parts, QUERY_BLOCK)
    discard(vectors)
    # A pair of blocks by its ranges alone: no candidate of it is nearer to a query than the gap between them.
    c_range = candidates.select("dim", F.xxhash64("ids", "matrix").alias("c_block"), F.col("low").alias("c_low"), F.col("high").alias("c_high"))
    q_range = questions.select("dim", F.xxhash64("ids", "matrix").alias("q_block"), "low", "high", "floor", "norm")
    gap = F.array_max(F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("c_low", "c_high"), lambda q, c: F.greatest(q["low"] - c["c_high"], c["c_low"] - q["high"], F.lit(0.0))))
    least = F.greatest(F.lit(0.0), F.coalesce(gap, F.lit(0.0)) * (1 - 1e-6) - 1e-5 * (1 + radius))
    top = (F.col("norm") + radius**2 - least * least) / 2 + 1e-9 * (F.col("norm") + radius**2) + 0.5
    pairs = c_range.join(q_range, "dim").filter(top >= F.col("floor")).select("dim", "c_block", "q_block")
    c_whole = candidates.select(F.xxhash64("ids", "matrix").alias("c_block"), *(F.col(c).alias(f"c_{c}") for c in ("ids", "matrix", "kind", "table")))
    q_whole = questions.select(F.xxhash64("ids", "matrix").alias("q_block"), "ids", "matrix", "kind", "table", "floors")
    tasks = max(1, q_parts * c_parts)
    work = pairs.join(q_whole, "q_block").join(c_whole, "c_block").repartition(min(tasks, 64 * max(cores, n // CANDIDATE_BLOCK)), "c_block", "q_block")

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):  # a pair at a time
                r = batch.slice(i, 1).to_pylist()[0]
                d = r["dim"]
                load = lambda c, kind, w: np.frombuffer(r[c], kind).reshape(-1, w)
                w = len(chosen[d])
                q_ids, ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["c_ids"], "<i8")
                (q, v, s), evaluated = search(k, held, q_ids, load("matrix", r["kind"], d), load("table", "<f4", w), np.frombuffer(r["floors"], "<i8"), ids, load("c_matrix", r["c_kind"], d), load("c_table", "<f4", w))
                nothing = pa.nulls(len(q), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64()), nothing, nothing], names=FOUND)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(3)), pa.array([evaluated]), pa.array([len(q_ids) * len(ids)])], names=FOUND)

    return work.mapInArrow(run, ", ".join(f"{c} bigint" for c in FOUND))


FOUND = ["query_id", "vec_id", "score", "evaluated", "pairs"]


def top_k(df: DataFrame, k: int = K, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with other rows' vectors. ``options``: see :func:`found`."""
    rows = found(df, k, **options).filter("query_id is not null")
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda c: cast(floor(64 * cast(c as double)) as bigint)) as x from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.x, c.x), lambda z: cast(z[1] as hugeint) * z[2])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.x) = len(c.x)),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""
