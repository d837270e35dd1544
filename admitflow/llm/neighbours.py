"""Nearest neighbours over balanced posting lists.

A bounded sample is halved again and again until the parts hold their share of a list; the parts' means, moved a little
by Lloyd's steps, are the centroids. Every vector is posted under its nearest centroid and, near a boundary, under the
others that are almost as near. A graph of near centroids, small enough for memory, is searched for the lists of a
vector. A query reads the lists whose centroid is at most so many times as far as its nearest one; how many times is
measured on the sample, so that the lists read hold nearly all of its vectors' nearest others. Lists and their queries
are cut into parts of bounded size, each pair of which one task compares on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admitflow.llm.common import stored

# Bounds of the index: vectors to fit it on, and centroids. Every vector is indexed.
SAMPLE_ROWS = 20_000
MAX_LISTS = 2_500
LIST_ROWS = 500
PART_ROWS = 4_096
# A vector is also posted under centroids at most so many times as far as its nearest.
BOUNDARY_RATIO = 1.02
MOST_POSTINGS = 4
# The share of the sample's nearest others that the lists read have to hold, and the vectors it is measured on.
SAMPLE_RECALL = 0.97
MEASURED_ROWS = 400
NEAREST = 10
DEGREE = 16
PASS_ROWS = 256


def _halves(points: np.ndarray, size: float) -> Iterator[np.ndarray]:
    """Parts of at most ``size`` points, by cutting at the median along the line between two far points."""
    if len(points) <= max(size, 1):
        yield points
        return
    a = points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    b = points[((points - a) ** 2).sum(axis=1).argmax()]
    order = np.argsort(points @ (b - a), kind="stable")
    middle = len(points) // 2
    yield from _halves(points[order[:middle]], size)
    yield from _halves(points[order[middle:]], size)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None], 0)


@dataclass
class CentroidGraph:
    """Centroids, each with its nearest others, and some to enter by."""

    centroids: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, total: int) -> CentroidGraph:
        lists = min(max(1, math.ceil(total / LIST_ROWS)), MAX_LISTS, len(sample))
        centroids = np.stack([p.mean(axis=0) for p in _halves(sample, len(sample) / lists)])
        for _ in range(3):
            own = np.concatenate([_squares(x, centroids).argmin(axis=1) for x in np.array_split(sample, 20) if len(x)])
            held = np.bincount(own, minlength=len(centroids))
            sums = np.stack([np.bincount(own, sample[:, k], len(centroids)) for k in range(sample.shape[1])], axis=1)
            centroids = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centroids)
        degree = min(DEGREE, len(centroids) - 1)
        edges = np.argsort(_squares(centroids, centroids) + np.diag(np.full(len(centroids), np.inf)), axis=1)[:, :degree]
        entries = np.linspace(0, len(centroids) - 1, min(len(centroids), 2 * math.isqrt(len(centroids)) + 1)).astype(int)
        return cls(centroids, edges, np.unique(entries))

    def _beam(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids that best-first steps along the edges find, for all rows at once."""
        rows = np.arange(len(x))[:, None]
        square = (self.centroids**2).sum(axis=1)
        held = np.broadcast_to(self.entries, (len(x), len(self.entries)))
        before = None
        while True:
            held = np.sort(held, axis=1)
            again = np.concatenate([np.zeros((len(x), 1), bool), held[:, 1:] == held[:, :-1]], axis=1)
            far = square[held] - 2 * np.einsum("qd,qcd->qc", x, self.centroids[held])
            far = np.where(again, np.inf, far)
            best = np.argsort(far, axis=1, kind="stable")[:, :width]
            beam, lengths = held[rows, best], far[rows, best]
            if before is not None and beam.shape == before.shape and (beam == before).all():
                lengths = np.sqrt(np.maximum(lengths + (x * x).sum(axis=1)[:, None], 0))
                return beam, lengths
            before = beam
            held = np.concatenate([beam, self.edges[beam].reshape(len(x), -1)], axis=1)

    def lists(self, x: np.ndarray, ratio: float, most: int | None = None, least: float = 0.0) -> list[np.ndarray]:
        """Lists whose centroid is at most ``ratio`` times as far as the nearest one; the beam grows until it ends.

        The nearest one counts as ``least`` away at least, as a vector close to its centroid has neighbours elsewhere too.
        """
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(x)
        todo, width = np.arange(len(x)), min(most or 2 * DEGREE, len(self.centroids))
        while len(todo):
            if width * 4 >= len(self.centroids):
                far = np.sqrt(_squares(x[todo], self.centroids))
                beam = np.argsort(far, axis=1, kind="stable")
                far = np.take_along_axis(far, beam, axis=1)
            else:
                beam, far = self._beam(x[todo], width)
            near = far <= ratio * np.maximum(far[:, :1], least)
            whole = near.all(axis=1) & (most is None) & (beam.shape[1] < len(self.centroids))
            for k in np.flatnonzero(~whole):
                found[todo[k]] = beam[k][near[k]][:most]
            todo, width = todo[whole], width * 4
        return found


def measured_ratio(graph: CentroidGraph, sample: np.ndarray, nearest: int) -> tuple[float, float]:
    """The least distance ratio at which the lists of sampled vectors hold enough of their nearest others, and the
    median distance to the nearest centroid, which the ratio is taken of for vectors that are closer.

    Others in the sample are farther away than those in the table, so the table's are found at least as often.
    """
    step = max(1, len(sample) // MEASURED_ROWS)
    needed: list[float] = []
    least = float(np.median(np.sqrt(_squares(sample[::step], graph.centroids).min(axis=1))))
    for at in range(0, len(sample), step * PASS_ROWS):
        rows = np.arange(at, min(at + step * PASS_ROWS, len(sample)), step)
        far = _squares(sample[rows], sample)
        far[np.arange(len(rows)), rows] = np.inf
        near = np.argsort(far, axis=1, kind="stable")[:, : min(nearest, len(sample) - 1)]
        posted = graph.lists(sample[near.ravel()], BOUNDARY_RATIO, MOST_POSTINGS)
        to_lists = np.sqrt(_squares(sample[rows], graph.centroids))
        for k, own in enumerate(to_lists):
            reached = [own[lists].min() for lists in posted[k * near.shape[1] : (k + 1) * near.shape[1]]]
            if max(own.min(), least) > 0:
                needed += (np.array(reached) / max(own.min(), least)).tolist()
    return (max(1.0, float(np.quantile(needed, SAMPLE_RECALL))) + 1e-9 if needed else 1.0), least


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector): each different row with an id and a sound vector of the commonest length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound)
    rows = rows.where(F.exists("vector", lambda v: v != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths.n if lengths else 0)).dropDuplicates(["vec_id", "vector"])


def _post(graph: CentroidGraph, ratio: float, most: int | None, least: float = 0.0):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PASS_ROWS):
                part = batch.slice(at, PASS_ROWS)
                x = np.array(part.column(1).to_pylist(), float)
                chosen = graph.lists(x, ratio, most, least)
                rows = pa.array(np.repeat(np.arange(len(x)), [len(c) for c in chosen]))
                arrays = [pa.array(np.concatenate(chosen)), part.column(0).take(rows), part.column(1).take(rows)]
                yield pa.RecordBatch.from_arrays(arrays, ["list", "vec_id", "vector"])

    return post


def _compare(nearest: int):
    def compare(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(queries) and len(members):
            ids, m = members["vec_id"].to_numpy(), np.stack(members["vector"].to_numpy())
            for query, vector in zip(queries["vec_id"].to_numpy(), queries["vector"]):
                gap = m - vector
                far = np.sqrt((gap * gap).sum(axis=1))
                far[ids == query] = np.inf
                best = np.lexsort((ids, far))[:nearest]
                out += [(query, ids[k], far[k]) for k in best if far[k] < np.inf]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return compare


def search(
    spark: SparkSession, vectors: DataFrame, every: int = 100, nearest: int = NEAREST, ratio: float | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest found to each row whose vec_id is divisible by ``every``.

    The score is the Euclidean distance in double precision, ties go to the smaller vec_id. Vectors that are null, zero,
    hold a null or a number that is not finite, or differ from the others in length take no part, nor do rows without an
    id. Equal rows count once; rows that share an id are no neighbours of each other. Fewer candidates than asked for are
    all given; an empty table gives none. Other columns are not read. Without a ``ratio`` it is measured on the sample.
    """
    rows = _usable(vectors)
    # Of equal vectors only the smallest ids can ever be among the nearest, one more in case the query is one of them.
    equal = Window.partitionBy("vector").orderBy("vec_id")
    held = rows.withColumn("place", F.row_number().over(equal)).where(F.col("place") <= nearest + 1).drop("place")
    sample = held.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vector").collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], result)
    points = np.array([r.vector for r in sample])
    graph = CentroidGraph.build(points, rows.count())
    ratio, least = measured_ratio(graph, points, nearest) if ratio is None else (ratio, 0.0)
    kinds = "list long, vec_id long, vector array<double>"
    postings = stored(held.mapInArrow(_post(graph, BOUNDARY_RATIO, MOST_POSTINGS), kinds), "postings")
    queries = rows.where(F.col("vec_id") % every == 0)
    # One row per list.
    counted = postings.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).cast("long").alias("parts"))
    sizes = stored(counted, "sizes")

    def part_of(parts: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(parts))

    def every_part(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))

    def met(asked: DataFrame) -> DataFrame:
        asked = stored(asked, "asked")
        groups = asked.groupBy("list").agg(F.ceil(F.count("*") / PART_ROWS).cast("long").alias("groups"))
        cut = stored(sizes.join(groups, "list"), "cut")
        # At most one row per list; a part of a list meets each group of its queries once.
        cut = F.broadcast(spark.createDataFrame(cut.collect(), cut.schema))
        asked = asked.join(cut, "list").select(
            "list", part_of("groups").alias("group"), every_part("parts").alias("part"), "vec_id", "vector"
        )
        members = postings.join(cut, "list").select(
            "list", every_part("groups").alias("group"), part_of("parts").alias("part"), "vec_id", "vector"
        )
        pairs = (
            asked.groupBy("list", "group", "part")
            .cogroup(members.groupBy("list", "group", "part"))
            .applyInPandas(_compare(nearest), "query_id long, vec_id long, score double")
        )
        once = pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
        return ranked.select("query_id", "rank", "vec_id", "score")

    found = stored(met(queries.mapInArrow(_post(graph, ratio, None, least), kinds)), "found")
    # Lists near an outlier may hold too few: such queries read all lists.
    full = found.where(F.col("rank") == nearest).select(F.col("query_id").alias("vec_id"))
    short = stored(queries.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    lists = F.sequence(F.lit(0).cast("long"), F.lit(len(graph.centroids) - 1).cast("long"))
    farther = met(short.select(F.explode(lists).alias("list"), "vec_id", "vector"))
    return found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").union(farther)
