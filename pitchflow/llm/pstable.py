"""Approximate nearest neighbours by inner product with multiprobe p-stable hashing.

Largest inner product becomes least distance by one more component: candidates x / M get sqrt(1 - |x|^2 / M^2), M
the largest norm, queries q / |q| get 0. Each of `TABLES` tables hashes a vector to a bucket by k functions
floor((a x + b) / w) with Gaussian a. A query visits, besides its own bucket, those that perturb some of the k values by one,
in the order of their estimated success: values near a cell's border first (the order of perturbation sets is
made once, from the expected distances; each query's own distances say which values they mean).

Rows are dealt by hash over shards of bounded size, each with its own tables, so k and the number of visits do not grow
with the data, and a bucket that many rows share is spread over all shards. A query goes to each shard once; there, its
tables' candidates are merged and scored exactly. Shards are searched in waves, each `WAVE` times as many as all before,
and a later wave returns only what comes up to the last of a query's best so far.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitchflow.llm.common import staged

TABLES = 6
#: Cell width, in standard deviations of a unit vector's projection.
WIDTH = 2.5
#: Rows of a cell on average, from which the number of functions follows, and the rows of a shard.
BUCKET_ROWS, SHARD_ROWS = 16, 65536
#: Queries that meet a shard in one task, and at once; more of them are dealt over copies of the shard.
QUERY_ROWS, STEP_ROWS = 2048, 64
#: Part of a table's cells (2 ** functions) that a query visits.
PROBED = 0.3
MIN_FUNCTIONS = 4
#: Shards of a wave, against all before it.
WAVE = 3


@lru_cache(maxsize=8)
def probe_order(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets in the order of expected success, as places in a query's sorted distances to the 2 * functions
    borders; the first is empty. Place j and place 2 * functions - 1 - j are the two borders of one cell."""
    m = functions
    z = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    z += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(z[0], (0,))]
    while heap and len(out) < probes:
        cost, places = heapq.heappop(heap)
        if len({min(p, 2 * m - 1 - p) for p in places}) == len(places):
            out.append(places)
        last = places[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - z[last] + z[last + 1], (*places[:-1], last + 1)))
            heapq.heappush(heap, (cost + z[last + 1], (*places, last + 1)))
    return out


@dataclass
class Hashes:
    """The functions of all tables for vectors of `dims` components and largest norm `norm`."""

    dims: int
    functions: int
    probes: int
    norm: float
    seed: int = 6

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        size = (TABLES, self.functions)
        self.a = rng.normal(size=(*size, self.dims + 1))
        self.b = rng.uniform(0, 1, size)
        self.odd = rng.integers(1, 2**62, size) * 2 + 1

    def _places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return vectors @ self.a[table].T / WIDTH + self.b[table]

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        """Candidates, one component longer."""
        scaled = vectors / self.norm
        return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1, keepdims=True)))])

    def buckets(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Bucket of each candidate in a table."""
        with np.errstate(over="ignore"):
            return (np.floor(self._places(self.rows(vectors), table)).astype(np.int64) * self.odd[table]).sum(1)

    def visits(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Buckets that each query visits in a table, the likeliest first."""
        queries = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        places = self._places(np.hstack([queries, np.zeros((len(queries), 1))]), table)
        cells = np.floor(places)
        below = places - cells
        distances = np.hstack([below, 1 - below])  # to the lower borders, to the upper ones
        order = distances.argsort(1, kind="stable")
        steps = np.hstack([-self.odd[table], self.odd[table]])
        with np.errstate(over="ignore"):
            base = (cells.astype(np.int64) * self.odd[table]).sum(1)
            return base[:, None] + steps[order] @ probe_matrix(self.functions, self.probes).T


@lru_cache(maxsize=8)
def probe_matrix(functions: int, probes: int) -> np.ndarray:
    """The sets of `probe_order` as rows of 0 and 1."""
    sets = probe_order(functions, probes)
    out = np.zeros((len(sets), 2 * functions), np.int64)
    for k, places in enumerate(sets):
        out[k, list(places)] = 1
    return out


@lru_cache(maxsize=64)
def hashes(dims: int, rows: int, norm: float) -> Hashes:
    """The functions of a shard with up to `rows` rows."""
    functions = max(MIN_FUNCTIONS, math.ceil(math.log2(max(rows / BUCKET_ROWS, 1))))
    return Hashes(dims, functions, math.ceil(PROBED * 2**functions), norm)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once: an id, and a vector that is not NULL, not empty, not zero and
    has no NULL or non-finite component."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter("vec_id is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("vector", lambda x: x != 0)).dropDuplicates(["vec_id", "vector"])


def _vectors(column) -> np.ndarray:
    """Binary rows (little-endian doubles) as a matrix."""
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def _met(q: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], functions: Hashes) -> np.ndarray:
    """Which rows share a visited bucket with each query, in any table."""
    met = np.zeros((len(q), len(tables[0][1])), bool)
    for table, (buckets, member) in enumerate(tables):
        visits = functions.visits(q, table)
        place = np.minimum(np.searchsorted(buckets, visits), len(buckets) - 1)
        hit = np.zeros((len(q), len(buckets)), bool)
        who, which = np.nonzero(buckets[place] == visits)
        hit[who, place[who, which]] = True
        met |= hit[:, member]
    return met


def _best_of_shard(queries: pd.DataFrame, rows: pd.DataFrame, top: int, whole: bool) -> pd.DataFrame:
    """Of each query, the `top` best rows (ties to the smaller vec_id) in a bucket it visits, or of the whole shard, that
    come up to the query's bound (NULL: none)."""
    out: dict[str, list] = {"dims": [], "query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(rows):
        x, ids = _vectors(rows["vector"]), rows["vec_id"].to_numpy()
        dims, size, norm = (queries[k].iloc[0] for k in ("dims", "shard_rows", "norm"))
        functions = hashes(int(dims), int(size), float(norm))
        tables = [] if whole else [np.unique(functions.buckets(x, t), return_inverse=True) for t in range(TABLES)]
        for at in range(0, len(queries), STEP_ROWS):
            part = queries.iloc[at : at + STEP_ROWS]
            q, query_ids = _vectors(part["vector"]), part["query_id"].to_numpy()
            near = q @ x.T
            if not whole:
                near[~_met(q, tables, functions)] = -np.inf
            near[query_ids[:, None] == ids[None]] = -np.inf
            least = part["bound"].to_numpy(float, na_value=-np.inf)
            if len(x) > top:
                least = np.fmax(least, np.partition(near, len(x) - top, axis=1)[:, len(x) - top])
            # products of matrices are rounded otherwise than sums of rows: a little more is scored exactly
            a, b = np.nonzero((near > -np.inf) & (near >= np.maximum(least - 1e-9 * np.abs(least).clip(1), -1e308)[:, None]))
            # summed row by row, so that equal vectors have equal scores wherever they stand
            score = (q[a] * x[b]).sum(1)
            order = np.lexsort((ids[b], -score, a))
            place = np.arange(len(order)) - np.searchsorted(a[order], a[order])
            keep = order[place < top]
            out["query_id"].append(query_ids[a[keep]])
            out["vec_id"].append(ids[b[keep]])
            out["score"].append(score[keep])
            out["dims"].append(np.full(len(keep), dims, np.int32))
    if not out["score"]:
        return pd.DataFrame({"dims": np.zeros(0, np.int32), "query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    return pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})


_KEY = ["dims", "shard", "chunk"]
_FOUND = "dims int, query_id long, vec_id long, score double"


def _searched(queries: DataFrame, rows: DataFrame, top: int, whole: bool) -> DataFrame:
    """Each query's best rows among all shards, in waves; `whole` compares it with all rows of them."""

    def best(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        return _best_of_shard(q, x, top, whole)

    sizes = queries.groupBy("dims").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("chunks"))
    rows = rows.join(sizes, "dims").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    queries = queries.join(sizes, "dims").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
    shards = queries.agg(F.max("shards")).first()[0] or 0
    found, end = None, 0
    while end < shards:
        begin, end = end, end + max(1, WAVE * end)
        sent = queries.filter(f"shards > {begin}")
        if found is None:
            sent = sent.withColumn("bound", F.lit(None).cast("double"))
        else:
            bounds = found.groupBy("dims", "query_id").agg(F.when(F.count("*") >= top, F.min("score")).alias("bound"))
            sent = sent.join(bounds, ["dims", "query_id"], "left")
        sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(begin), F.least(F.lit(end), "shards") - 1)))
        sent = sent.select(*_KEY, "query_id", "vector", "shard_rows", "norm", "bound")
        wave = rows.filter(f"shard >= {begin} and shard < {end}").select(*_KEY, "vec_id", "vector")
        wave = sent.groupBy(*_KEY).cogroup(wave.groupBy(*_KEY)).applyInPandas(best, _FOUND)
        found = staged(_top(wave if found is None else found.union(wave), top, "dims", "query_id").drop("rank"), "found")
    return found


def _top(found: DataFrame, top: int, *key: str) -> DataFrame:
    """The best answers by key with their rank; an answer met twice counts once, with its larger score."""
    found = found.groupBy(*key, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(f"rank <= {top}").select(*key, "vec_id", "score", "rank")


def nearest(embeddings: DataFrame, top: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row whose vec_id is divisible by `every`, the `top` rows with the largest
    inner product that the search finds, nearest first, ties to the smaller vec_id; all other rows, if fewer.

    Rows as in `usable` take part; those of each vector length are searched by themselves, as no inner product joins two
    lengths. A repeated row counts once, and rows of a query's own id are never its answer; an id with several vectors
    has the best of their answers. Of equal vectors only the `top` + 1 smallest ids are indexed, as no other can be in an
    answer. A query that finds fewer than it should is compared with all rows, shard by shard. An empty table gives no
    row. Other columns are left out.
    """
    data = F.pandas_udf(lambda vectors: vectors.map(lambda v: np.asarray(v, "<f8").tobytes()), "binary")("vector")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    rows = usable(embeddings).select("vec_id", F.size("vector").alias("dims"), F.sqrt(squares).alias("norm"), data.alias("vector"))
    rows = staged(rows, "usable")
    same = Window.partitionBy("dims", "vector").orderBy("vec_id")
    candidates = staged(rows.withColumn("place", F.row_number().over(same)).filter(f"place <= {top + 1}").drop("place", "norm"), "candidates")
    # per length: the largest norm, and the shards of its rows
    lengths = rows.groupBy("dims").agg(F.max("norm").alias("norm"))
    lengths = lengths.join(candidates.groupBy("dims").agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids")), "dims")
    lengths = lengths.withColumn("shards", F.ceil(F.col("n") / SHARD_ROWS).cast("int"))
    lengths = staged(lengths.withColumn("shard_rows", F.ceil(F.col("n") / F.col("shards"))), "lengths")
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")).cast("int").alias("shard")
    index = candidates.join(lengths, "dims").select("dims", shard, "vec_id", "vector")
    queries = rows.filter(F.col("vec_id") % every == 0).drop("norm").withColumnRenamed("vec_id", "query_id").join(lengths, "dims")
    found = _searched(queries, index, top, whole=False)
    if found is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    # a candidate of the query's own id is no answer, so a query in the index should find one less
    met = found.groupBy("dims", "query_id").agg(F.count("*").alias("met"))
    own = candidates.select("dims", F.col("vec_id").alias("query_id"), F.lit(1).alias("own")).distinct()
    short = queries.join(met, ["dims", "query_id"], "left").join(own, ["dims", "query_id"], "left")
    should = F.least(F.lit(top), F.col("ids") - F.coalesce("own", F.lit(0)))
    short = staged(short.filter(F.coalesce("met", F.lit(0)) < should).drop("met", "own"), "short")
    again = _searched(short, index, top, whole=True)
    answers = _top(found if again is None else found.union(again), top, "query_id")
    return answers.select("query_id", "rank", "vec_id", "score")
