"""Approximate nearest neighbours by a hash-prefix forest.

A tree is a sorted array of hash strings of ``BITS`` bits, one for each vector;
bit i of a string tells on which side of the tree's i-th random hyperplane the
vector lies (hyperplanes pass through the median of a bounded sample). A query
descends to its place in each array, where its longest-prefix matches stand
side by side, and the search ascends in all trees at once: from the longest
prefix to shorter ones, level by level, until the ranges of all trees together
hold a ``share`` of the array (counted with repetition). Everything in those
ranges, however much it is, is a candidate and gets its exact distance.

Vectors are dealt over the cells of a few orthonormal hyperplanes, about
``BLOCK_ROWS`` to a cell; a larger cell is parted by hash. Each part has a
forest of its own. A query first searches its own cell; its k-th distance there
bounds how far its neighbours can be, and as the distance from a cell is at
least the root of the summed squares of the margins by which the query lies on
the other side of its hyperplanes, the search then visits only cells that can
hold a nearer one. Routing therefore loses nothing; on clustered vectors few
cells are visited, on vectors in all directions nearly all.

``share`` is set by measurement: on ``TRIALS`` of the parts, the smallest of a
fixed list that finds ``TARGET`` of the true neighbours of some of their rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hashed_sample, materialize

TREES = 48
BITS = 64
#: Vectors and queries that meet in one task.
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
#: Rows on which offsets are set, the smallest by a hash.
SAMPLE_ROWS = 4096
#: Parts on which the share is set (of a cell's parts the first, cells by a hash), and rows of each that serve as queries.
TRIALS = 3
TRIAL_QUERIES = 100
#: Shares to choose from: parts of a forest's rows that the ranges of all trees hold together, counted with repetition.
SHARES = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0)
#: Recall to reach on the trials; above the 0.9 that results must have.
TARGET = 0.95
SEED = 3

_WEIGHTS = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)


class Planes:
    """The hyperplanes of all trees: ``TREES * BITS`` directions and offsets."""

    def __init__(self, sample: np.ndarray, dim: int, trees: int = TREES) -> None:
        rng = np.random.default_rng(SEED)
        self.trees = trees
        self.directions = rng.normal(size=(dim, trees * BITS)).astype(np.float32)
        sides = [np.median(sample.astype(np.float32) @ self.directions[:, at : at + 256], axis=0) for at in range(0, trees * BITS, 256)] if len(sample) else [np.zeros(trees * BITS)]
        self.offsets = np.concatenate(sides).astype(np.float32)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, rows): the hash strings as numbers, whose order is that of the strings."""
        out = np.empty((self.trees, len(vectors)), np.uint64)
        for at in range(0, len(vectors), 1024):
            side = vectors[at : at + 1024].astype(np.float32) @ self.directions > self.offsets
            packed = np.packbits(side.reshape(-1, self.trees, BITS), axis=2)
            out[:, at : at + 1024] = packed.view(">u8")[:, :, 0].T
        return out


class Forest:
    def __init__(self, planes: Planes, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.planes, self.ids, self.vectors = planes, ids, vectors
        strings = planes.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, 1)
        self.norms = np.einsum("ij,ij->i", vectors, vectors)

    def wanted(self, k: int, share: float) -> float:
        """Rows that a query's ranges must hold together: the share, and so many that one of the trees holds the query
        itself and ``k`` others."""
        return max(share * len(self.ids), self.planes.trees * (k + 1))

    def ranges(self, queries: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries): the ranges that the synchronous ascent ends with."""
        strings = self.planes.strings(queries)
        low, high = np.zeros(strings.shape, np.int64), np.zeros(strings.shape, np.int64)
        rest = np.arange(len(queries))
        for level in range(BITS, -1, -1):
            if level > 2 * np.log2(len(self.ids) + 2) + 8 and level % 8:
                continue  # where hardly any two strings agree the ascent takes eight levels at a time
            free = np.uint64((1 << (BITS - level)) - 1)
            for tree in range(self.planes.trees):
                own = strings[tree, rest]
                low[tree, rest] = np.searchsorted(self.sorted[tree], own & ~free, "left")
                high[tree, rest] = np.searchsorted(self.sorted[tree], own | free, "right")
            rest = rest[(high[:, rest] - low[:, rest]).sum(0) < wanted]
            if not len(rest):
                break
        return low, high

    def candidates(self, queries: np.ndarray, wanted: float) -> Iterator[np.ndarray]:
        """The rows that each query's ranges hold, in order."""
        low, high = self.ranges(queries, wanted)
        seen = np.zeros(len(self.ids), bool)
        for q in range(len(queries)):
            seen[:] = False
            for order, a, b in zip(self.order, low[:, q], high[:, q], strict=True):
                seen[order[a:b]] = True
            yield np.flatnonzero(seen)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vector row, distance) of each query's ``k`` nearest candidates of other ids."""
        rows, found, scores = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for q, candidates in enumerate(self.candidates(queries, self.wanted(k, share))):
            candidates = candidates[self.ids[candidates] != query_ids[q]]
            if len(candidates) > 8 * k:  # the expanded form is cheap but rounds: it only bounds what may be among the nearest
                rough = self.norms[candidates] - 2 * (self.vectors[candidates] @ queries[q])
                limit = np.partition(rough, k - 1)[k - 1]
                slack = 1e-9 * (1 + abs(limit) + self.norms[candidates].max() + queries[q] @ queries[q])
                candidates = candidates[rough <= limit + slack]
            exact = np.sqrt(np.square(self.vectors[candidates] - queries[q]).sum(1))
            best = np.lexsort((self.ids[candidates], exact))[:k]
            rows += [q] * len(best)
            found.append(candidates[best])
            scores.append(exact[best])
        return np.array(rows, np.int64), np.concatenate(found), np.concatenate(scores)


class Router:
    """Cells of orthonormal hyperplanes through the sample's medians."""

    def __init__(self, sample: np.ndarray, dim: int, cells: int) -> None:
        bits = min(dim, max(0, int(np.ceil(np.log2(max(cells, 1))))))
        self.directions = np.linalg.qr(np.random.default_rng(SEED + 1).normal(size=(dim, max(bits, 1))))[0][:, :bits]
        self.offsets = np.median(sample @ self.directions, axis=0) if len(sample) and bits else np.zeros(bits)
        self.weights = 1 << np.arange(bits, dtype=np.int64)

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.directions - self.offsets

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return (self.margins(vectors) > 0) @ self.weights

    def within(self, vector: np.ndarray, radius: float) -> list[int]:
        """The cells that may hold a vector at most ``radius`` away, but for the vector's own."""
        margin = self.margins(vector[None])[0]
        cell, squares = int((margin > 0) @ self.weights), np.square(margin)
        order = np.argsort(squares, kind="stable")
        limit = radius * radius * (1 + 1e-9) + 1e-12
        out, stack = [], [(0, 0, 0.0)]  # the other sides taken so far, the next hyperplane, their squares' sum
        while stack:
            flips, at, total = stack.pop()
            for j in range(at, len(order)):
                more = total + squares[order[j]]
                if more > limit:
                    break  # the rest have larger margins
                own = flips | int(self.weights[order[j]])
                out.append(cell ^ own)
                stack.append((own, j + 1, more))
        return out


def true_neighbours(rows: np.ndarray, queries: int, k: int) -> list[np.ndarray]:
    """For the first ``queries`` rows, the rows of their ``k`` nearest others."""
    norms, out = np.einsum("ij,ij->i", rows, rows), []
    for q in range(min(queries, len(rows))):
        near = norms - 2 * (rows @ rows[q])
        near[q] = np.inf
        out.append(np.argsort(near, kind="stable")[: min(k, len(rows) - 1)])
    return out


def measured_share(planes: Planes, parts: list[np.ndarray], k: int, target: float = TARGET) -> float:
    """The smallest of ``SHARES`` whose candidates hold ``target`` of the true neighbours (the largest, if none does)."""
    trials = [(Forest(planes, np.arange(len(x)), x), x, truth) for x in parts if len(truth := true_neighbours(x, TRIAL_QUERIES, k)) and len(truth[0])]

    def enough(share: float) -> bool:
        recalls = [np.isin(t, c).mean() for forest, x, truth in trials for t, c in zip(truth, forest.candidates(x[: len(truth)], forest.wanted(k, share)), strict=True)]
        return bool(recalls) and float(np.mean(recalls)) >= target

    return SHARES[min(bisect_left(SHARES, True, key=enough), len(SHARES) - 1)]  # recall grows with the share


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the vectors that can be compared: no nulls, none but finite numbers, not all zero."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    share: float | None = None,
    trees: int = TREES,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to each query row, among all rows but its own.

    ``score`` is the Euclidean distance in double precision on the vectors as
    given; ties go to the smaller vec_id. ``share`` overrides the measured one.

    Defined cases: vectors that are null, zero or hold a null or non-finite
    number take no part, nor do rows without an id; ids must be whole numbers;
    vectors of another length than most are compared among their own length
    only; an id that is repeated is one vector (the smallest as an array); with
    fewer than ``k`` candidates all are returned; an empty table gives no rows;
    other columns, whatever their names, are ignored.
    """
    rows = valid_vectors(vectors, id_col, vector_col).withColumn("q", F.coalesce(is_query, F.lit(False)))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("q").alias("q")).withColumn("dim", F.size("v")), "ann-rows")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("n_q")).collect()  # a row for each length of vector
    parts = [_search(rows.filter(F.col("dim") == s["dim"]), s["dim"], s["n"], k, share, trees, block_rows) for s in sizes if s["n_q"]]
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, dim: int, n: int, k: int, share: float | None, trees: int, block_rows: int) -> DataFrame:
    sample = np.array([r.v for r in hashed_sample(rows.select("vec_id", "v"), SAMPLE_ROWS, ["vec_id"]).collect()]).reshape(-1, dim)
    planes, router = Planes(sample, dim, trees), Router(sample, dim, -(-n // block_rows))
    shared = rows.sparkSession.sparkContext.broadcast((planes, router))  # set by dim, trees and bits alone

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value[1].cells(_matrix(batch.column(1))), pa.int64())], names=["vec_id", "v", "q", "cell"])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each query the cells beside its own that may hold nearer vectors than its own cell's."""
        for batch in batches:
            to = [shared.value[1].within(x, r) for x, r in zip(_matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False), strict=True)]
            at = pa.array(np.repeat(np.arange(len(to)), [len(t) for t in to]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([c for t in to for c in t], pa.int64())], names=["q_id", "q_v", "q_cell"])

    routed = materialize(rows.select("vec_id", "v", "q").mapInArrow(route, "vec_id long, v array<double>, q boolean, cell long"), "ann-routed")
    asked = routed.filter("q").select(F.col("vec_id").alias("q_id"), F.col("v").alias("q_v"), F.col("cell").alias("q_cell"))
    cells = materialize(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts")), "ann-cells")
    if share is None:
        chosen = cells.orderBy(F.xxhash64("cell")).limit(TRIALS).select(F.col("cell").alias("p_cell"), "parts")
        trial = routed.join(F.broadcast(chosen), routed.cell == chosen.p_cell).filter(_part("parts") == 0).select("cell", "v", F.xxhash64(F.lit(4), "vec_id").alias("h")).toPandas()
        share = measured_share(planes, [np.stack(own.sort_values("h")["v"].to_list()) for _, own in trial.groupby("cell")], k)  # about TRIALS * block_rows vectors
    home = _visit(routed, asked, cells, shared, k, share)
    if not len(router.weights):
        return home
    home = materialize(home, "ann-home")
    kth = home.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("score")).alias("scores"))
    kth = kth.select("query_id", F.when(F.col("n") >= k, F.try_element_at("scores", F.lit(k))).alias("reach"))
    reach = asked.join(kth, asked.q_id == kth.query_id, "left").select("q_id", "q_v", F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    visits = reach.mapInArrow(further, "q_id long, q_v array<double>, q_cell long")
    return home.unionByName(_visit(routed, materialize(visits, "ann-visits"), cells, shared, k, share))


def _part(parts: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col(parts))


def _visit(data: DataFrame, visits: DataFrame, cells: DataFrame, shared, k: int, share: float) -> DataFrame:  # noqa: ANN001
    """The ``k`` nearest of every visit (``q_id, q_v, q_cell``), of each part of the visited cell."""
    asked_for = visits.groupBy("q_cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("groups"))
    plan = cells.join(asked_for, cells.cell == asked_for.q_cell).select(F.col("cell").alias("p_cell"), "parts", "groups")
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.col(m) - 1))
    # A part and a group of queries meet in a task of their own: both sides in whole, no larger than their bounds.
    group = F.pmod(F.xxhash64(F.lit(2), "q_id"), F.col("groups"))
    here = data.join(plan, data.cell == plan.p_cell).select("vec_id", "v", F.col("p_cell").alias("d_cell"), _part("parts").alias("d_part"), every("groups").alias("d_group"))
    asked = visits.join(plan, visits.q_cell == plan.p_cell).select("q_id", "q_v", F.col("p_cell").alias("a_cell"), group.alias("a_group"), every("parts").alias("a_part"))

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not block.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids, query_ids = block["vec_id"].to_numpy(), queries["q_id"].to_numpy()
        forest = Forest(shared.value[0], ids, _matrix(block["v"]))
        q, found, score = forest.nearest(query_ids, _matrix(queries["q_v"]), k, share)
        return pa.table([pa.array(query_ids[q]), pa.array(ids[found]), pa.array(score)], schema=schema)

    return here.groupBy("d_cell", "d_part", "d_group").cogroup(asked.groupBy("a_cell", "a_part", "a_group")).applyInArrow(run, "query_id long, vec_id long, score double")
