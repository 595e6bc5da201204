"""Nearest neighbours by low-dimensional stable projections with a chi-square stopping test.

A projection on m Gaussian directions turns a squared distance d into d times a chi-square variable of m degrees
of freedom. So neighbours in the projection are verified in order of their projected distance r, and the search
may stop when a vector closer than the k-th best distance d found so far would lie within r with the wanted
probability: when chi-square(r * r / (d * d)) reaches it. All distances returned are true ones.

The projected space is cut by a kd-tree into parts, fitted on a bounded sample; every vector is filed in its
part, and parts are cut into blocks of bounded size. A query first searches its own part. The distance found
tells, by the same test, which other parts it must visit. A task holds one block, indexed by a kd-tree of its own,
and lets the queries stream by.

Equal vectors are indexed once, with the k + 1 smallest ids that have them, which is all that k neighbours of
any query can need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import shared_folder


@dataclass(frozen=True)
class Search:
    """``block`` distinct vectors go to a task at most on average. The upper tree has as many parts as that takes, up to ``parts``;
    beyond them a part has several blocks. It is fitted on ``sample`` projected vectors, or ``sample_per_part`` for each part
    if that is more: with the defaults 500,000 of 64 bytes at most."""

    k: int = 10
    dimensions: int = 8
    probability: float = 0.95
    sample: int = 20_000
    sample_per_part: int = 8
    parts: int = 1 << 16
    block: int = 10_000
    seed: int = 5

    def parts_for(self, total: int) -> int:
        return max(1, min(self.parts, -(-total // self.block)))

    def sample_for(self, total: int) -> int:
        return max(self.sample, self.sample_per_part * self.parts_for(total))


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def projection(dimension: int, search: Search) -> np.ndarray:
    return np.random.default_rng(search.seed).standard_normal((dimension, search.dimensions))


# --- trees ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Cuts:
    """A kd-tree of 2 ** depth parts: node i splits at ``at[i]`` in direction ``axis[i]`` into nodes 2i+1 and 2i+2."""

    axis: np.ndarray
    at: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, parts: int) -> Cuts:
        depth = max(0, int(np.ceil(np.log2(max(1, parts)))))
        axis, at = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
        members = {0: np.arange(len(points))}
        for node in range(len(axis)):
            own = members.pop(node)
            if len(own):
                axis[node] = np.argmax(np.ptp(points[own], axis=0))
                at[node] = np.median(points[own, axis[node]])
            right = points[own, axis[node]] > at[node]
            members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
        return cls(axis, at)

    @property
    def parts(self) -> int:
        return len(self.axis) + 1

    def part_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(self.axis) and (node < len(self.axis)).all():
            right = points[np.arange(len(points)), self.axis[node]] > self.at[node]
            node = 2 * node + 1 + right
        return node - len(self.axis)

    def near(self, point: np.ndarray, too_far: Callable[[float], bool]) -> list[int]:
        """The parts whose squared distance from a point is not ``too_far``; subtrees that are so are not entered."""
        out, stack = [], [(0, np.zeros(len(point)))]
        while stack:
            node, gaps = stack.pop()
            if too_far(float((gaps * gaps).sum())):
                continue
            if node >= len(self.axis):
                out.append(node - len(self.axis))
                continue
            axis = self.axis[node]
            side = point[axis] - self.at[node]
            beyond = gaps.copy()
            beyond[axis] = max(beyond[axis], abs(side))
            here, there = (2 * node + 2, 2 * node + 1) if side > 0 else (2 * node + 1, 2 * node + 2)
            stack += [(there, beyond), (here, gaps)]
        return out


class Block:
    """The vectors of a block under a kd-tree of their projections."""

    BUCKET = 64

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], directions: np.ndarray) -> None:
        points = vectors @ directions
        order, bounds = np.arange(len(points)), [0]
        stack = [(0, len(points))]
        while stack:
            lo, hi = stack.pop()
            if hi - lo <= self.BUCKET:
                bounds.append(hi)
                continue
            own = order[lo:hi]
            axis = np.argmax(np.ptp(points[own], axis=0))
            middle = (hi - lo) // 2
            order[lo:hi] = own[np.argpartition(points[own, axis], middle)]
            stack += [(lo + middle, hi), (lo, lo + middle)]
        self.vectors, self.points, self.ids = vectors[order], points[order], [ids[i] for i in order]
        self.bounds = np.array(bounds)
        starts = self.bounds[:-1]
        self.low = np.minimum.reduceat(self.points, starts)
        self.high = np.maximum.reduceat(self.points, starts)

    def search(self, vector: np.ndarray, own: int | None, found: float, directions: np.ndarray, search: Search) -> list[tuple[float, int]]:
        """The nearest (distance, id) of this block; ``found`` is the k-th best distance known from elsewhere."""
        point = vector @ directions
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        near = (gap * gap).sum(axis=1)
        best: list[tuple[float, int]] = []
        limit, done, step = found, 0, 4
        buckets = np.argsort(near, kind="stable")
        while done < len(buckets):
            some = buckets[done : done + step]
            if self._stop(near[some[:1]], limit, search)[0]:
                break
            rows = np.concatenate([np.arange(self.bounds[b], self.bounds[b + 1]) for b in some])
            apart = self.points[rows] - point
            rows = rows[~self._stop((apart * apart).sum(axis=1), limit, search)]
            apart = self.vectors[rows] - vector
            true = np.sqrt((apart * apart).sum(axis=1))
            close = true <= limit
            for distance, row in zip(true[close].tolist(), rows[close].tolist()):
                best += [(distance, i) for i in self.ids[row] if i != own]
            best = sorted(best)[: search.k]
            if len(best) == search.k:
                limit = min(limit, best[-1][0])
            done += step
            step = min(2 * step, 32)
        return best

    @staticmethod
    def _stop(squared: np.ndarray, limit: float, search: Search) -> np.ndarray:
        if not np.isfinite(limit):
            return np.zeros(len(squared), bool)
        if limit == 0:
            # Equal vectors have equal projections.
            return squared > 1e-12
        return chi_square(squared / (limit * limit), search.dimensions) >= search.probability


# --- tables ---------------------------------------------------------------------------------------


def usable(vector: Column, dimension: int) -> Column:
    """Whether a vector takes part: of this dimension, all components finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dimension) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _dimension(vectors: Column, df: DataFrame) -> int | None:
    sizes = df.where(vectors.isNotNull()).groupBy(F.size(vectors).alias("d")).count()
    first = sizes.where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else None


ENTRY = "part int, block int, is_query boolean, id bigint, own bigint, found double, vector array<double>, ids array<bigint>"
HIT = "query_id bigint, own bigint, vec_id bigint, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _searched(directions: np.ndarray, search: Search):
    """Hits from rows in order of part, block and is_query: the vectors of a block, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, vectors, ids, block = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "block")], axis=1)
            query = batch.column("is_query").to_numpy(zero_copy_only=False)
            change = np.ones(batch.num_rows, bool)
            change[1:] = (keys[1:] != keys[:-1]).any(axis=1) | (query[1:] != query[:-1])
            starts = np.flatnonzero(change)
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                some = batch.slice(lo, hi - lo)
                if at != tuple(keys[lo]):
                    at, vectors, ids, block = tuple(keys[lo]), [], [], None
                if not query[lo]:
                    vectors.append(_matrix(some.column("vector")))
                    ids += some.column("ids").to_pylist()
                    continue
                if block is None and vectors:
                    block, vectors = Block(np.concatenate(vectors), ids, directions), []
                if block is None:
                    continue
                hits = [
                    (q, own, i, distance)
                    for vector, q, own, found in zip(
                        _matrix(some.column("vector")), some.column("id").to_pylist(), some.column("own").to_pylist(), some.column("found").to_pylist()
                    )
                    for distance, i in block.search(vector, q, found, directions, search)
                ]
                if hits:
                    columns = zip(*hits)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["query_id", "own", "vec_id", "score"])

    return run


def neighbours(df: DataFrame, is_query: Column, search: Search = Search(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The nearest found of every query row: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Scores are Euclidean distances of the given vectors in double precision; ties go to the smaller id. All rows
    are candidates but those with the query's own id. Vectors take part that have the commonest length, finite
    components and one that is not zero, under an id that is not null. Repeated rows count once; an id with
    several vectors is searched with each, and results of equal ones fall together.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"), is_query.alias("is_query"))
    dimension = _dimension(F.col("vector"), rows)
    folder = f"{shared_folder(spark)}/vectors-{uuid4().hex}"

    def keep(part: DataFrame, name: str) -> DataFrame:
        part.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    fit_for = rows.where(F.col("id").isNotNull() & usable(F.col("vector"), dimension or 0)).dropDuplicates(["id", "vector"])
    fit_for = keep(fit_for.withColumn("own", F.xxhash64("vector")), "rows")
    first = Window.partitionBy("own", "vector").orderBy("id")
    few = fit_for.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= search.k + 1)
    distinct = few.groupBy("own", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = keep(distinct, "distinct")
    queries = fit_for.where(F.col("is_query")).select("id", "own", "vector")

    total = distinct.count()
    directions = projection(dimension or 1, search)
    wanted = search.sample_for(total)

    def projected(vectors: pa.Array) -> pa.Array:
        points = _matrix(vectors) @ directions
        return pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), search.dimensions).cast(pa.list_(pa.float64()))

    # A hash bound leaves little more than the sample, of which each row is then a short projection.
    drawn = distinct.withColumn("draw", F.xxhash64(F.lit(search.seed), "own"))
    share = min(1.0, 1.2 * wanted / max(total, 1) + 100 / max(total, 1))
    if share < 1.0:
        drawn = drawn.where(F.col("draw") <= F.lit(int(share * (1 << 64)) - (1 << 63)))
    points = drawn.select("draw", "own", F.arrow_udf(projected, "array<double>")("vector").alias("point"))
    sampled = points.orderBy("draw", "own").limit(wanted).select("point").toArrow()
    sample = _matrix(sampled.column("point").combine_chunks()) if total else np.zeros((0, search.dimensions))
    cuts = Cuts.fit(sample, search.parts_for(total))

    def part_of(vectors: pa.Array) -> pa.Array:
        return pa.array(cuts.part_of(_matrix(vectors) @ directions).astype(np.int32))

    filed = keep(distinct.withColumn("part", F.arrow_udf(part_of, "int")("vector")), "filed")
    # One count for each part; a large part is dealt to several blocks.
    sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}
    blocks = np.array([max(1, -(-sizes.get(p, 0) // search.block)) for p in range(cuts.parts)])
    per_part = F.lit(blocks.tolist())[F.col("part")]
    entries = filed.select(
        "part", F.pmod(F.xxhash64("own"), per_part).cast("int").alias("block"), F.lit(False).alias("is_query"),
        F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("own"), F.lit(None).cast("double").alias("found"),
        "vector", "ids",
    )

    def hits(visits: DataFrame) -> DataFrame:
        each = visits.select(
            "part", F.explode(F.sequence(F.lit(0), (per_part - 1).cast("int"))).alias("block"), F.lit(True).alias("is_query"),
            "id", "own", "found", "vector", F.lit(None).cast("array<bigint>").alias("ids"),
        )
        both = entries.unionByName(each).repartition("part", "block").sortWithinPartitions("part", "block", "is_query")
        return both.mapInArrow(_searched(directions, search), HIT)

    best = Window.partitionBy("query_id", "own").orderBy("score", "vec_id")

    def nearest(df: DataFrame) -> DataFrame:
        once = df.groupBy("query_id", "own", "vec_id").agg(F.min("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= search.k)

    home = queries.withColumns({"part": F.arrow_udf(part_of, "int")("vector"), "found": F.lit(float("inf"))})
    near = keep(nearest(hits(home)), "near")
    bound = near.groupBy(F.col("query_id").alias("id"), "own").agg(
        F.when(F.count("score") == search.k, F.max("score")).otherwise(float("inf")).alias("found")
    )
    known = queries.join(bound, ["id", "own"], "left").withColumn("found", F.coalesce("found", F.lit(float("inf"))))

    def others(vectors: pa.Array, found: pa.Array) -> pa.Array:
        points, out = _matrix(vectors) @ directions, []
        for point, home, limit in zip(points, cuts.part_of(points), found.to_pylist()):
            near = cuts.near(point, lambda squared: bool(Block._stop(np.array([squared]), limit, search)[0]))
            out.append(sorted(p for p in near if p != home))
        return pa.array(out, pa.list_(pa.int32()))

    visits = known.withColumn("part", F.explode(F.arrow_udf(others, "array<int>")("vector", "found")))
    far = keep(hits(visits), "far")
    found = nearest(near.select("query_id", "own", "vec_id", "score").unionByName(far))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
