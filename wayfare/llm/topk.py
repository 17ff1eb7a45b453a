"""Exact top-k search by pivot-table elimination.

Vectors are integers, the score is the inner product. With one more coordinate that makes all
stored vectors equally long, a larger product is a smaller Euclidean distance, so the triangle
inequality holds: a candidate is at least as far from the query as their distances to any pivot
differ. The index is the table of every vector's distances to many pivots. A query takes the largest
of these bounds for each candidate, evaluates candidates in the order of the bounds and stops
when the next bound can't reach its k-th score any more; the result is exact.

Queries go to the tasks in blocks of bounded size; each task answers a block for its own rows, and the
answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import settle, ship

PIVOTS, PIVOT_SAMPLE, BLOCK_QUERIES = 64, 2000, 1024
EXACT = float(1 << 53)


def quantized(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``q`` (floor(scale * x) of each component). Rows without id, and vectors that are
    null, empty or hold a null or non-finite component, are left out."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (_complete(vectors, id_col, vector_col).where(fine & (F.size(vector_col) > 0))
            .select(F.col(id_col).alias("vec_id"),
                    F.transform(x, lambda v: F.floor(F.lit(scale) * v).cast("double")).alias("q")))


def _complete(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(id_col, vector_col).where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other, one after the other the farthest from those chosen."""
    chosen = [int(np.argmax((vectors**2).sum(1)))]
    distance = ((vectors - vectors[chosen[0]])**2).sum(1)
    while len(chosen) < min(count, len(vectors)) and distance.max() > 0:
        chosen.append(int(np.argmax(distance)))
        distance = np.minimum(distance, ((vectors - vectors[chosen[-1]])**2).sum(1))
    return vectors[chosen]


class Pivots:
    """Pivots among vectors of one length, and the squared norm that all vectors are lifted to."""

    def __init__(self, pivots: np.ndarray, longest: float):
        self.points, self.longest = pivots, longest
        self.norms = (pivots**2).sum(1)
        self.lifts = np.sqrt(np.maximum(longest - self.norms, 0))

    def of_stored(self, vectors: np.ndarray) -> np.ndarray:
        """Distances of lifted vectors to the pivots."""
        norms = (vectors**2).sum(1)
        lifts = np.sqrt(np.maximum(self.longest - norms, 0))
        square = norms[:, None] + self.norms - 2 * vectors @ self.points.T + (lifts[:, None] - self.lifts)**2
        return np.sqrt(np.maximum(square, 0))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        square = (vectors**2).sum(1)[:, None] + self.longest - 2 * vectors @ self.points.T
        return np.sqrt(np.maximum(square, 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pivot_table(rows: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> tuple[DataFrame, dict[int, Pivots]]:
    """Every row with a number of its own and its distances to the pivots, written to the shared folder, and
    the pivots.

    Pivots are chosen among at most about ``sample`` rows; every row is indexed. Vectors of
    different lengths have no product and get tables of their own.
    """
    rows = settle(rows.withColumn("dim", F.size("q")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    told = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.max(F.aggregate("q", F.lit(0.0), lambda a, v: a + v * v)).alias("longest")).collect()
    found = {}
    for dim, n, longest in sorted(told):
        part = F.pmod(F.xxhash64("vec_id", "q"), F.lit(max(1, n // sample)))
        drawn = rows.where((F.col("dim") == dim) & (part == 0)).select("q").limit(2 * sample).toArrow()
        if not len(drawn):
            drawn = rows.where(F.col("dim") == dim).select("q").limit(sample).toArrow()
        # a little longer than the longest, against rounding
        found[dim] = Pivots(choose_pivots(_matrix(drawn["q"].combine_chunks()), pivots), longest * (1 + 1e-9))
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in by_dim(batch):
                away = shared.value[dim].of_stored(_matrix(part.column("q")))
                edges = pa.array(np.arange(0, away.size + 1, away.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("vec_id"), part.column("q"), part.column("dim"),
                     pa.ListArray.from_arrays(edges, pa.array(away.ravel()))], ["row", "vec_id", "q", "dim", "away"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    rows = rows.select("row", "vec_id", "q", "dim")
    return settle(rows.mapInArrow(distances, f"row bigint, vec_id {kind}, q array<double>, dim int, away array<double>"),
                  "pivot-table"), found


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim)) if (dims != dim).any() else batch


class Best:
    """The k best of each query so far: by score, then by id."""

    def __init__(self, queries: int, k: int):
        self.scores, self.ids, self.k = [np.empty(0)] * queries, [np.empty(0, np.int64)] * queries, k

    def least(self, query: int) -> float:
        """What a candidate must reach to be worth a look."""
        own = self.scores[query]
        return own[-1] if len(own) == self.k else -np.inf

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]


def search_rows(best: Best, numbers: np.ndarray, query_rows: np.ndarray, queries: np.ndarray, pivots: Pivots,
                rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, away: np.ndarray) -> int:
    """Offer some rows to queries of the same length, but none to itself; returns how many products were
    evaluated."""
    evaluated = 0
    to_pivots = pivots.of_queries(queries)
    bounds = np.zeros((len(queries), len(ids)), np.float32)
    stored, asked = away.T.astype(np.float32), to_pivots.astype(np.float32)
    for p in range(len(stored)):
        np.maximum(bounds, np.abs(asked[:, p, None] - stored[p]), out=bounds)
    # rounding of the distances must not hide a candidate
    slack = 1e-5 * max(1.0, np.sqrt(pivots.longest) + float(to_pivots.max(initial=0)))
    norms = (queries**2).sum(1)
    exact = max(np.abs(queries).max(initial=0), 1) * max(np.abs(vectors).max(initial=0), 1) * queries.shape[1] < EXACT
    for row, number in enumerate(numbers.tolist()):
        reach = (norms[row] + pivots.longest - np.maximum(bounds[row].astype(np.float64) - slack, 0)**2) / 2
        reach += 1e-6 * max(1.0, pivots.longest)
        left = np.flatnonzero((reach >= best.least(number)) & (rows != query_rows[row]))
        left = left[np.argsort(-reach[left], kind="stable")]
        begin, size = 0, 64
        while begin < len(left) and reach[left[begin]] >= best.least(number):
            now = left[begin:begin + size]
            if exact:
                scores = vectors[now] @ queries[row]
            else:
                scores = np.array([sum(int(a) * int(b) for a, b in zip(v, queries[row])) for v in vectors[now]], object)
            evaluated += len(now)
            worth = scores >= best.least(number)
            if worth.any():
                best.add(number, scores[worth], ids[now[worth]])
            begin, size = begin + size, 2 * size
    return evaluated


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0, pivots: int = PIVOTS,
          block_queries: int = BLOCK_QUERIES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row that fits the condition ``is_query`` (over
    ``vec_id``) the k best of all rows but itself, ties to the smaller id.

    All candidates if there are fewer. Vectors that are null, empty, or hold null or non-finite
    components take no part, nor do rows without id; vectors of another length are no candidates. Rows
    count one by one: of rows that repeat an id each is a query and a candidate of its own, also for the
    others of its id. Other columns are ignored.
    """
    ship(vectors.sparkSession)
    index, found = pivot_table(quantized(vectors, scale, id_col, vector_col), pivots)
    shared = index.sparkSession.sparkContext.broadcast(found)
    queries = index.where(is_query).select("row", "vec_id", "q", "dim")
    blocks = max(1, -(-queries.count() // block_queries))
    parts = [_answers(index, queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).toArrow(), shared, k)
             for i in range(blocks)]
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _answers(index: DataFrame, block: pa.Table, pivots, k: int) -> DataFrame:
    """Each task's k best for a block of queries."""
    asked = index.sparkSession.sparkContext.broadcast(
        [(dim, rows.column("row").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("q")))
         for batch in block.combine_chunks().to_batches() for dim, rows in by_dim(batch)])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids = (np.concatenate([np.empty(0, np.int64), *(x[i] for x in asked.value)]) for i in (1, 2))
        best, first, parts = Best(len(ids), k), 0, {}
        for dim, own, _, matrix in asked.value:
            parts[dim] = np.arange(first, first + len(own)), own, matrix
            first += len(own)
        for batch in batches:
            for dim, rows in by_dim(batch):
                if dim in parts:
                    search_rows(best, *parts[dim], pivots.value[dim], rows.column("row").to_numpy(),
                                rows.column("vec_id").to_numpy(), _matrix(rows.column("q")), _matrix(rows.column("away")))
        counts = [len(x) for x in best.ids]
        if sum(counts):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(ids, counts), pa.int64()), pa.array(np.repeat(numbers, counts), pa.int64()),
                pa.array(np.concatenate(best.ids), pa.int64()),
                pa.array([int(s) for s in np.concatenate(best.scores)], pa.int64())],
                ["query_id", "query", "vec_id", "score"])

    return index.mapInArrow(answer, "query_id bigint, query bigint, vec_id bigint, score bigint")
