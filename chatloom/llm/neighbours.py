"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to a few dimensions by Gaussian (2-stable) random directions. The squared ratio of
projected to true distance then follows a chi-square law, so once the next projected neighbour is
farther than the k-th best true distance times a quantile of that law, a closer vector would with the
wanted probability have been met before, and the search can stop.

Largest inner product becomes nearest distance by one more coordinate that gives all candidates the
same norm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import scratch_dir

PAIRS = "query_id bigint, vec_id bigint, score double"


def chi_square_quantile(p: float, dims: int) -> float:
    """Where the chi-square law with an even number of degrees of freedom reaches ``p``."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


@dataclass(frozen=True)
class Projection:
    """Random directions over the vector and its extra coordinate, and the candidates' common norm."""

    directions: np.ndarray
    norm2: float

    def candidates(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(0.0, self.norm2 - (x * x).sum(1)))
        return x @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.directions[:-1]

    def distance2(self, norm2: np.ndarray | float, score: np.ndarray) -> np.ndarray:
        """Squared distance of query and candidate, from their inner product."""
        return np.maximum(0.0, self.norm2 + norm2 - 2 * score)


@dataclass(frozen=True)
class Cells:
    """The leaves of a kd-tree: splits in breadth-first order, and each leaf's box."""

    axis: np.ndarray
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def locate(self, y: np.ndarray) -> np.ndarray:
        node = np.zeros(len(y), np.int64)
        while len(self.axis) and node.min(initial=len(self.axis)) < len(self.axis):
            inner = node < len(self.axis)
            at = node[inner]
            right = y[inner, self.axis[at]] > self.value[at]
            node[inner] = 2 * at + 1 + right
        return node - len(self.axis)

    def distance2(self, y: np.ndarray) -> np.ndarray:
        """Squared distance of each row to each leaf's box."""
        out = np.zeros((len(y), len(self.low)))
        for d in range(y.shape[1]):
            gap = np.maximum(0, np.maximum(self.low[:, d] - y[:, d, None], y[:, d, None] - self.high[:, d]))
            out += gap * gap
        return out


def build_cells(sample: np.ndarray, leaves: int) -> Cells:
    """A balanced kd-tree over sampled points: the widest axis of a node, split at its median."""
    dims, depth = sample.shape[1], max(0, math.ceil(math.log2(max(1, leaves))))
    axis, value = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    low, high = np.full((2 ** (depth + 1) - 1, dims), -np.inf), np.full((2 ** (depth + 1) - 1, dims), np.inf)
    members = {0: sample}
    for node in range(2**depth - 1):
        points = members.pop(node)
        if len(points):
            axis[node] = np.argmax(points.max(0) - points.min(0))
            value[node] = np.median(points[:, axis[node]])
        right = points[:, axis[node]] > value[node]
        for child, side in ((2 * node + 1, ~right), (2 * node + 2, right)):
            low[child], high[child] = low[node], high[node]
            members[child] = points[side]
        high[2 * node + 1][axis[node]] = low[2 * node + 2][axis[node]] = value[node]
    first = 2**depth - 1
    return Cells(axis, value, low[first:], high[first:])


def scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; the same for equal rows, wherever they lie."""
    return (x * query).sum(1)


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def search_block(
    queries: np.ndarray, own: np.ndarray, bound2: np.ndarray, points: np.ndarray, ids: np.ndarray,
    projection: Projection, k: int, factor: float, step: int = 256, together: int = 64,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id and the best k of a block, as far as they can be among the best of all.

    Projected distances are worked out for some queries ``together``. A query then takes its projected
    neighbours in ascending order, ``step`` at first and twice as many each time, verifies them on the original
    vectors, and stops where the next lies beyond the stopping radius of the k-th best found so far.
    """
    projected = projection.candidates(points)
    squares = (projected * projected).sum(1)
    for start in range(0, len(queries), together):
        part = queries[start : start + together]
        y = projection.queries(part)
        away2 = squares - 2 * (y @ projected.T) + (y * y).sum(1)[:, None]
        for q, query_id, bound, away in zip(part, own[start:], bound2[start:], away2):
            norm2, at, size = float(q @ q), 0, step
            rounding = 1e-12 * math.sqrt(projection.norm2 * norm2)
            near = np.flatnonzero((away <= bound * factor) & (ids != query_id))
            near = near[np.argsort(away[near], kind="stable")]
            got_ids, got = np.empty(0, np.int64), np.empty(0)
            while at < len(near) and away[near[at]] <= bound * factor:
                now = near[at : at + size]
                at, size = at + size, size * 2
                if len(got) == k:  # the exact scores, equal for equal rows, only of what can be among the best
                    now = now[points[now] @ q >= got[-1] - rounding]
                got_ids, got = np.concatenate([got_ids, ids[now]]), np.concatenate([got, scores(points[now], q)])
                keep = best(got_ids, got, k)
                got_ids, got = got_ids[keep], got[keep]
                if len(got) == k:
                    bound = min(bound, float(projection.distance2(norm2, got[-1])))
            yield int(query_id), got_ids, got


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part: id and vector there, all components
    finite, not all zero. Repeated rows count once; of different vectors with one id the smallest stays."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, dims: int = 8, chance: float = 0.98,
    cell_size: int = 4096, most_cells: int = 4096, sample_size: int = 8192, seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest of each row whose id ``every`` divides.

    The tree is built on at most about ``sample_size`` sampled rows; every row is placed in its leaf
    and can be found. The sample also gives each query a first bound, and with it the leaves whose box
    it must visit. A leaf with more rows than ``cell_size``, as equal vectors make one, is dealt over
    several groups, and so are its queries by their own number, so no task holds more than a block of
    either. Rows and the queries' leaves are stored once. Vectors of
    another length than the most frequent one take no part. No rows give an empty result.
    """
    spark = vectors.sparkSession
    rows = _stored(valid_vectors(vectors), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm2")
    )
    top = sizes.orderBy(F.desc("n"), "d").first()
    if top is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    d, n = top["d"], top["n"]
    rows = rows.filter(F.size("v") == d)
    share = max(1, math.ceil(n / sample_size))
    sampled = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(share)) == 0).toArrow().sort_by("vec_id")
    sample = np.array(sampled["v"].to_pylist(), float).reshape(-1, d)
    sample_ids = sampled["vec_id"].to_numpy()
    projection = Projection(np.random.default_rng(seed).standard_normal((d + 1, dims)), float(top["norm2"]))
    cells = build_cells(projection.candidates(sample), min(most_cells, max(1, n // cell_size)))
    factor = chi_square_quantile(chance, dims)
    common = spark.sparkContext.broadcast((projection, cells, sample, sample_ids))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, cells, _, _ = common.value
        for batch in batches:
            x = _matrix(batch["v"], d)
            cell = cells.locate(projection.candidates(x)) if len(x) else []
            yield pa.record_batch([batch["vec_id"], batch["v"], pa.array(cell, pa.int32())], ["vec_id", "v", "cell"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, cells, sample, sample_ids = common.value
        for batch in batches:
            x, ids = _matrix(batch["v"], d), batch["vec_id"].to_numpy()
            out = {"query_id": [], "v": [], "bound2": [], "cell": [], "seeds": []}
            boxes = cells.distance2(projection.queries(x)) if len(x) else []
            for row, own, box in zip(x, ids.tolist(), boxes):
                score = scores(sample, row)
                score[sample_ids == own] = -np.inf
                first = best(sample_ids, score, k)
                first = first[np.isfinite(score[first])]
                bound2 = float(projection.distance2(row @ row, score[first[-1]])) if len(first) == k else np.inf
                visit = np.flatnonzero(box <= bound2 * factor) if np.isfinite(bound2) else np.arange(len(box))
                seeds = [{"vec_id": int(sample_ids[i]), "score": float(score[i])} for i in first]
                for c in [-1, *visit.tolist()]:
                    out["query_id"].append(own)
                    out["v"].append(row if c >= 0 else None)
                    out["bound2"].append(bound2)
                    out["cell"].append(c)
                    out["seeds"].append(seeds if c < 0 else None)
            kinds = [pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int32(),
                     pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))]
            yield pa.record_batch([pa.array(a, t) for a, t in zip(out.values(), kinds)], list(out))

    placed = rows.mapInArrow(place, "vec_id bigint, v array<double>, cell int")
    queries = rows.filter(F.col("vec_id") % every == 0)
    routed = queries.mapInArrow(
        route, "query_id bigint, v array<double>, bound2 double, cell int, seeds array<struct<vec_id: bigint, score: double>>"
    )
    placed, routed = _stored(placed, "placed"), _stored(routed, "routed")
    # How many blocks of rows and of queries each leaf is dealt over; at most most_cells rows.
    held = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    visits = routed.filter("cell >= 0").groupBy("cell").agg(F.count(F.lit(1)).alias("visits"))
    blocks = held.join(visits, "cell").select(
        "cell",
        F.ceil(F.col("n") / (2 * cell_size)).cast("int").alias("row_blocks"),
        F.ceil(F.col("visits") / (4 * cell_size)).cast("int").alias("query_blocks"),
    )
    hashed = lambda c, of: F.pmod(F.xxhash64(c), F.col(of)).cast("int")
    points = (
        placed.join(F.broadcast(blocks), "cell")
        .withColumn("row_block", hashed("vec_id", "row_blocks"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("cell", "row_block", "query_block", "vec_id", "v")
    )
    asking = (
        routed.filter("cell >= 0").join(F.broadcast(blocks), "cell")
        .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .withColumn("query_block", hashed("query_id", "query_blocks"))
        .select("cell", "row_block", "query_block", "query_id", F.col("v").alias("q"), "bound2")
    )

    def search(key: tuple, found: pa.Table, wanted: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        if found.num_rows and wanted.num_rows:
            points, queries = _matrix(found["v"].combine_chunks(), d), _matrix(wanted["q"].combine_chunks(), d)
            own, bound2 = wanted["query_id"].to_numpy(), wanted["bound2"].to_numpy()
            results = search_block(queries, own, bound2, points, found["vec_id"].to_numpy(), common.value[0], k, factor)
            for query_id, ids, score in results:
                for column, values in zip(columns, (np.full(len(ids), query_id), ids, score)):
                    column.append(values)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, columns))))

    keys = ["cell", "row_block", "query_block"]
    found = points.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(search, PAIRS)
    seeds = routed.filter("cell < 0").select("query_id", F.inline("seeds")).select("query_id", "vec_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.unionByName(seeds).dropDuplicates(["query_id", "vec_id"])
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
