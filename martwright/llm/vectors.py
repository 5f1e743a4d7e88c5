"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, best bin first.

A tree of k-means splits is fitted on a bounded sample of the vectors (``sample`` rows, chosen by
hash); every vector is then filed in a leaf. To make the largest inner product the nearest
neighbour, vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and queries a
zero there. A query walks the tree with a priority queue of branches by the distance to their
centres and names its leaves in that order. How many leaves are read is calibrated: on rows
of the sample the number is widened until the mean share of true neighbours found reaches ``recall``.

Leaves lie in tree order on shelves of about ``cell`` vectors: small leaves share one, and a leaf of
many (also of equal) vectors spreads over several, so that none lands in one task. A query is sent
once to each shelf with a leaf it reads, together with the numbers of those leaves; queries come in
chunks of about ``together``. A shelf answers with the best ``k`` in those leaves, ties to the
smaller id, and the best of all shelves are kept. Scores are exact, in double precision.

Defined results: vectors that are null, zero, of another length than most rows of the sample, or
hold null or non-finite components take no part; null ids take no part; repeated rows are separate
candidates, but an id asks once, with its smallest vector; a table of fewer than k others returns all; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (id, v, norm) with v in double precision; only vectors that can be compared."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        table.select(F.col(key).cast("long").alias("id"), v.alias("v"), bad.alias("bad"))
        .where(F.col("v").isNotNull() & ~F.coalesce("bad", F.lit(True)) & F.col("id").isNotNull())
        .select("id", "v", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))
        .where("norm > 0")
    )


def kmeans(points: np.ndarray, k: int, rng: np.random.Generator, turns: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and each point's centre; empty centres are dropped."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(turns):
        near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
        centres = np.stack([points[near == c].mean(0) for c in np.unique(near)])
    near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
    return centres, near


class Tree:
    """Nodes by number: a branch has centres and children, a leaf has its leaf number."""

    def __init__(self, points: np.ndarray, branching: int, leaf_points: int, seed: int = 0):
        self.branches: dict[int, tuple[np.ndarray, list[int]]] = {}
        self.leaves: dict[int, int] = {}
        rng, todo, nodes = np.random.default_rng(seed), [(0, points)], 1
        while todo:
            node, own = todo.pop()
            centres, near = kmeans(own, branching, rng) if len(own) > leaf_points else (own[:1], None)
            if len(centres) < 2:  # small enough, or all points alike
                self.leaves[node] = len(self.leaves)
                continue
            parts = [(nodes + c, own[near == c]) for c in range(len(centres))]
            nodes += len(centres)
            self.branches[node] = centres, [n for n, _ in parts]
            todo += parts

    def file(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: the nearest centre, level by level."""
        at = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node in self.leaves:
                at[rows] = self.leaves[node]
                continue
            centres, children = self.branches[node]
            near = ((centres**2).sum(1) - 2 * points[rows] @ centres.T).argmin(1)
            todo += [(child, rows[near == c]) for c, child in enumerate(children)]
        return at

    def best_bins(self, point: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            while node not in self.leaves:
                centres, children = self.branches[node]
                far = ((centres - point) ** 2).sum(1)
                order = far.argsort()
                for c in order[1:]:
                    heapq.heappush(queue, (float(far[c]), children[c]))
                node = children[order[0]]
            found.append(self.leaves[node])
        return found


def _stack(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _lifted(v: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0, most**2 - (v**2).sum(1)))
    return np.hstack([v, rest[:, None]])


def calibrate(tree: Tree, points: np.ndarray, most: float, k: int, recall: float, tests: int) -> int:
    """Fewest leaves to read for ``recall`` on rows of the sample, which the tree was fitted on."""
    leaf = tree.file(_lifted(points, most))
    probes = np.arange(0, len(points), max(1, len(points) // tests))
    # How many of a probe's true neighbours lie in its first 1, 2, ... leaves.
    shares = np.zeros(len(tree.leaves))
    for q in probes:
        score = points @ points[q]
        score[q] = -np.inf
        best = np.argsort(-score)[: min(k, len(points) - 1)]
        order = tree.best_bins(np.append(points[q], 0.0), len(tree.leaves))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        if len(best):
            shares += np.bincount(rank[leaf[best]], minlength=len(order)).cumsum() / len(best)
    enough = np.flatnonzero(shares / len(probes) >= recall)
    return int(enough[0]) + 1 if len(enough) else len(tree.leaves)


def search(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    k: int = 20,
    sample: int = 20000,
    branching: int = 16,
    leaf_points: int = 64,
    recall: float = 0.97,
    tests: int = 300,
    cell: int = 4096,
    together: int = 16384,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of each row with id divisible by ``every``."""
    spark = table.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    good = usable(table, key, vector)
    chosen = good.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()["v"]
    if not len(chosen):
        return none
    sizes = chosen.map(len)
    width = int(sizes.mode()[0])
    points = np.stack(chosen[sizes == width].to_list())
    good = good.where(F.size("v") == width)
    most, rows = good.agg(F.max("norm"), F.count("*")).first()
    # Leaves of the sample hold a fixed number of its points; more rows make fuller leaves, dealt in cells.
    tree = Tree(_lifted(points, most), branching, leaf_points)
    visits = calibrate(tree, points, most, k, recall, tests)
    shared = spark.sparkContext.broadcast((tree, most))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, most = shared.value
        for batch in batches:
            if batch.num_rows:
                leaf = tree.file(_lifted(_stack(batch.column(1)), most))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(leaf)], ["id", "v", "leaf"])

    # Rows of one id must part as well, so a row's number is in its hash; it is stored and stays.
    filed = cut_lineage(
        good.select("id", "v")
        .mapInArrow(index, "id long, v array<double>, leaf long")
        .withColumn("spread", F.xxhash64("id", F.monotonically_increasing_id()))
    )
    # One row per leaf of the sample's tree, so at most ``sample`` rows.
    filled = np.zeros(len(tree.leaves), np.int64)
    for leaf, n in filed.groupBy("leaf").count().collect():
        filled[leaf] = n
    start = np.cumsum(filled) - filled
    directory = spark.createDataFrame(
        list(zip(range(len(filled)), start.tolist(), filled.tolist(), strict=True)), "leaf long, start long, n long"
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, _ = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                shelves, leaves, of_query, of_shelf = [], [], [0], [0]
                for point in _stack(batch.column(1)):
                    read = np.array(tree.best_bins(np.append(point, 0.0), visits), np.int64)
                    read = np.sort(read[filled[read] > 0])
                    first, last = start[read] // cell, (start[read] + filled[read] - 1) // cell
                    many = last - first + 1
                    shelf = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
                    new = np.flatnonzero(np.append(True, shelf[1:] != shelf[:-1])[: len(shelf)])
                    shelves.append(shelf[new])
                    leaves.append(np.repeat(read, many))
                    of_query.append(of_query[-1] + len(new))
                    of_shelf += (of_shelf[-1] + np.append(new[1:], len(shelf))).tolist() if len(new) else []
                inner = pa.ListArray.from_arrays(pa.array(of_shelf, pa.int32()), pa.array(np.concatenate(leaves)))
                place = pa.StructArray.from_arrays([pa.array(np.concatenate(shelves)), inner], ["shelf", "leaves"])
                places = pa.ListArray.from_arrays(pa.array(of_query, pa.int32()), place)
                yield pa.record_batch([batch.column(0), batch.column(1), places], ["id", "v", "places"])

    # A walk of the tree costs far more than its row's bytes tell, so the number of parts is set here.
    parts = max(1, -(-rows // (every * 256)))
    queries = good.where(F.col("id") % every == 0).repartition(parts, "id").groupBy("id").agg(F.min("v").alias("v"))
    chunks = max(1, -(-rows // (every * together)))
    held = (
        filed.join(directory, "leaf")
        .withColumn("shelf", F.expr(f"(start + pmod(spread, n)) div {cell}"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .select("shelf", "chunk", "id", "v", "leaf")
    )
    asked = (
        queries.mapInArrow(probe, "id long, v array<double>, places array<struct<shelf:bigint,leaves:array<bigint>>>")
        .select("id", "v", F.inline("places"))
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
        .select("shelf", "chunk", "id", "v", "leaves")
    )

    def answer(own: pa.Table, queries: pa.Table) -> pa.Table:
        parts = []
        if len(own) and len(queries):
            ids = own.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], _stack(own.column("v").combine_chunks())[order]
            here, which = np.unique(own.column("leaf").to_numpy()[order], return_inverse=True)
            q_ids = queries.column("id").to_numpy()
            q = _stack(queries.column("v").combine_chunks())
            read = queries.column("leaves").combine_chunks()
            for at in range(0, len(q), 256):
                rough = q[at : at + 256] @ v.T
                # Only the leaves that a query reads count for it.
                part = read.slice(at, 256)
                row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                leaf = part.flatten().to_numpy()
                place = np.minimum(np.searchsorted(here, leaf), len(here) - 1)
                known = here[place] == leaf
                reads = np.zeros((len(part), len(here)), bool)
                reads[row[known], place[known]] = True
                rough[~reads[:, which] | (q_ids[at : at + 256, None] == ids[None, :])] = -np.inf
                for i, score in enumerate(rough):
                    if len(score) > k:
                        # All that may be among the best k whatever the last bits of the product say.
                        least = np.partition(score, -k)[-k]
                        near = np.flatnonzero(score >= least - 1e-9 * (1 + abs(least)))
                    else:
                        near = np.arange(len(score))
                    near = near[score[near] > -np.inf]
                    exact = (v[near] * q[at + i]).sum(1)
                    best = np.lexsort((ids[near], -exact))[:k]
                    parts.append((q_ids[at + i], ids[near][best], exact[best]))
        return pa.table(
            {
                "query_id": pa.array(np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int64)),
                "vec_id": pa.array(np.concatenate([p[1] for p in parts] or [[]]).astype(np.int64)),
                "score": pa.array(np.concatenate([p[2] for p in parts] or [[]]).astype(np.float64)),
            }
        )

    found = (
        held.groupBy("shelf", "chunk")
        .cogroup(asked.groupBy("shelf", "chunk"))
        .applyInArrow(answer, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
