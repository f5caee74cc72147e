"""Approximate nearest neighbours by inner product over an inverted multi-index.

Both halves of the vectors are quantised by codebooks of their own, so that a cell is a
pair of centroids. A query visits cells in the order of the sum of its inner products
with both centroids, taken from a heap, until they hold enough candidates, and these are
reranked by the exact product.

How many candidates are enough is measured, not assumed: for a sample of queries the true
neighbours are found by comparing with every vector, and the number is set such that the
wanted share of them would have been visited.

Equal vectors are one entry with its smallest ids, and equal queries are asked once. Cells
are packed into shards of a bounded number of vectors, large cells into several, so no
task depends on how the vectors are spread.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.sources.staging import Staging

SAMPLE = 16_384  # vectors that codebooks are fitted to, at most
PER_CELL = 8  # vectors that a cell has on average, while there are fewer than MOST_CENTROIDS
MOST_CENTROIDS = 512
ROUNDS = 12
SHARD = 8192  # vectors
PROBES = 192  # queries that the number of candidates is measured by
WANTED = 0.96  # share of their neighbours that it must reach


def valid_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that can take part."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    # Adding zero turns -0.0 into 0.0, so that equal vectors are also stored alike.
    doubles = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    known = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), doubles.alias("vector"))
    return known.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(fine).where(some)


def kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 2) -> np.ndarray:
    """Centroids; fewer than k if there are fewer different points."""
    different = np.unique(points, axis=0)
    if len(different) <= k:
        return different
    centroids = different[np.random.default_rng(seed).choice(len(different), k, replace=False)]
    for _ in range(rounds):
        nearest = closest(points, centroids)
        n = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    return centroids


def closest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * points @ centroids.T, 1)


@dataclass
class Codebooks:
    """Centroids of both halves, and how many vectors every cell has."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one = closest(vectors[:, : self.half], self.first)
        two = closest(vectors[:, self.half :], self.second) if self.second.shape[1] else 0
        return one * len(self.second) + two

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Cells from the best sum of inner products down: a heap over sorted halves."""
        one, two = self.first @ query[: self.half], self.second @ query[self.half :]
        by_one, by_two = np.argsort(-one, kind="stable").tolist(), np.argsort(-two, kind="stable").tolist()
        one, two = one[by_one].tolist(), two[by_two].tolist()
        # reached[i]: how many of the second half were taken with the i-th of the first.
        heap = [(-(one[0] + two[0]), 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield by_one[i] * len(by_two) + by_two[j]
            if j + 1 < len(two):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))

    def visited(self, query: np.ndarray, candidates: int) -> list[int]:
        """The cells that together hold `candidates` vectors, or all."""
        found, cells = 0, []
        for cell in self.visit(query):
            if self.counts[cell]:
                cells.append(cell)
                found += self.counts[cell]
                if found >= candidates:
                    break
        return cells

    def needed(self, query: np.ndarray, cells: Iterable[int]) -> list[int]:
        """How many candidates a query must take to reach each of these cells."""
        wanted, found, at = set(cells), 0, {}
        for cell in self.visit(query):
            found += int(self.counts[cell])
            if cell in wanted:
                at[cell] = found
                if len(at) == len(wanted):
                    break
        return [at[c] for c in cells]


def matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _with_cell(books) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = Codebooks(*books.value).cells(matrix(batch.column("vector")))
                yield batch.append_column("cell", pa.array(cell.astype(np.int32)))

    return run


def _probe(queries: np.ndarray, ids: np.ndarray, k: int) -> Callable:
    """The k best of a task for every probe, by comparing with all its vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((0, 3))] * len(queries)
        for batch in batches:
            if not batch.num_rows:
                continue
            rep, cell = np.asarray(batch.column("rep")), np.asarray(batch.column("cell"))
            scores = queries @ matrix(batch.column("vector")).T
            scores[ids[:, None] == rep[None, :]] = -np.inf
            some = min(k, scores.shape[1])
            top = np.argpartition(-scores, some - 1, axis=1)[:, :some]
            for q in range(len(queries)):
                new = np.stack([scores[q, top[q]], rep[top[q]], cell[top[q]]], 1)
                both = np.concatenate([best[q], new])
                best[q] = both[np.argsort(-both[:, 0], kind="stable")[:k]]
        rows = [(q, *row) for q, found in enumerate(best) for row in found.tolist() if row[0] > -np.inf]
        q, score, _, cell = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int32()), pa.array(score, pa.float64()), pa.array([int(c) for c in cell], pa.int32())],
            names=["probe", "score", "cell"],
        )

    return run


def _ask(books, candidates: int, shard_of: Callable) -> Callable:
    """For every query and shard that it visits one row with the cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codebooks(*books.value)
        for batch in batches:
            for k, (rep, query) in enumerate(zip(batch.column("rep").to_pylist(), matrix(batch.column("vector")))):
                shards: dict[int, list[int]] = {}
                for cell in own.visited(query, candidates):
                    for shard in shard_of(cell):
                        shards.setdefault(shard, []).append(cell)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(shards), pa.int32()),
                        pa.array([rep] * len(shards), pa.int64()),
                        batch.column("vector").take(pa.array([k] * len(shards), pa.int64())),
                        pa.array(list(shards.values()), pa.list_(pa.int32())),
                    ],
                    names=["shard", "rep", "vector", "cells"],
                )

    return run


def _answer(k: int) -> Callable:
    """The best k of every shard for every query; rows sorted by (shard, entries first)."""

    def best(shard: dict, asked: list[dict]) -> Iterator[tuple[int, int, float]]:
        local = {c: i for i, c in enumerate(np.unique(shard["cell"]).tolist())}
        place = np.array([local[c] for c in shard["cell"].tolist()])
        queries = np.array([r["vector"] for r in asked])
        allowed = np.zeros((len(asked), len(local)), bool)
        for q, row in enumerate(asked):
            allowed[q, [local[c] for c in row["cells"] if c in local]] = True
        scores = np.where(allowed[:, place], queries @ shard["vector"].T, -np.inf)
        some = min(k + 4, scores.shape[1])  # a few more, as products are rounded
        top = np.argpartition(-scores, some - 1, axis=1)[:, :some]
        for q, row in enumerate(asked):
            chosen = top[q][scores[q, top[q]] > -np.inf]
            exact = (shard["vector"][chosen] * queries[q]).sum(1)
            for i in np.lexsort((shard["rep"][chosen], -exact))[:k]:
                yield row["rep"], int(shard["rep"][chosen[i]]), float(exact[i])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, asked, shard = None, [], [], None

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal shard, asked
            if asked and parts:
                if shard is None:
                    columns = {c: np.concatenate([p[c] for p in parts]) for c in ("rep", "cell", "vector")}
                    shard = columns
                q, rep, score = zip(*found) if (found := list(best(shard, asked))) else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(rep, pa.int64()), pa.array(score, pa.float64())],
                    names=["query", "rep", "score"],
                )
            asked = []

        for batch in batches:
            for row_shard, tag, group in _groups(batch):
                if row_shard != number:
                    yield from answers()
                    number, parts, asked, shard = row_shard, [], [], None
                if tag == 0:
                    parts.append({
                        "rep": np.asarray(group.column("rep")),
                        "cell": np.asarray(group.column("cell")),
                        "vector": matrix(group.column("vector")),
                    })
                else:
                    asked += group.select(["rep", "vector", "cells"]).to_pylist()
                    if len(asked) >= 256:
                        yield from answers()
        yield from answers()

    return run


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    shard, tag = np.asarray(batch.column("shard")), np.asarray(batch.column("tag"))
    if not len(shard):
        return
    edges = np.flatnonzero((shard[1:] != shard[:-1]) | (tag[1:] != tag[:-1])) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)]):
        yield int(shard[a]), int(tag[a]), batch.slice(a, b - a)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, staging: Staging | None = None) -> DataFrame:
    """The k nearest found for every query: query_id, rank (from 1), vec_id, score.

    `rows` has (vec_id, embedding). Nearest is the largest inner product, ties go to the
    smaller vec_id; a query's own row is no candidate, rows with the same vector are.
    Vectors that are null, empty, zero, or have null or non-finite components take no part,
    nor those of another length than most have. Rows that repeat both id and vector count
    once. Without queries or candidates there are no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    staging = staging or Staging(spark)
    valid = valid_vectors(rows)
    sizes = valid.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    width = sizes[0].d
    valid = valid.where(F.size("vector") == width).distinct()
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    smallest = valid.withColumn("_nth", F.row_number().over(by_id)).where(F.col("_nth") <= k + 1)
    entries = staging.pin(
        smallest.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries"
    )
    total = entries.count()

    part = min(1.0, 1.2 * SAMPLE / total)
    chance = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1
    sample = matrix(entries.where(chance).select("vector").limit(SAMPLE).toArrow()["vector"].combine_chunks())
    centroids = int(np.clip(2 ** round(np.log2(max(total / PER_CELL, 1)) / 2), 1, MOST_CENTROIDS))
    half = (width + 1) // 2
    books = Codebooks(kmeans(sample[:, :half], centroids), kmeans(sample[:, half:], centroids))
    # Arrays are broadcast: workers need not know this module to read them.
    shared = spark.sparkContext.broadcast((books.first, books.second))
    placed = staging.pin(
        entries.select("rep", "ids", "vector").mapInArrow(
            _with_cell(shared), "rep bigint, ids array<bigint>, vector array<double>, cell int"
        ),
        "index",
    )
    cell_rows = placed.groupBy("cell").count().collect()  # at most MOST_CENTROIDS ** 2
    books.counts = np.zeros(len(books.first) * len(books.second), np.int64)
    for row in cell_rows:
        books.counts[row.cell] = row["count"]
    shared = spark.sparkContext.broadcast((books.first, books.second, books.counts))

    asked = valid.where(is_query)
    queries = staging.pin(asked.groupBy("vector").agg(F.min("vec_id").alias("rep")), "queries")
    probes = queries.orderBy(F.xxhash64("rep"), "rep").limit(PROBES).toArrow()
    if not probes.num_rows:
        return spark.createDataFrame([], schema)
    probe_vectors = matrix(probes["vector"].combine_chunks())
    truth = placed.mapInArrow(_probe(probe_vectors, np.asarray(probes["rep"]), k), "probe int, score double, cell int")
    best = Window.partitionBy("probe").orderBy(F.desc("score"))
    true_cells: dict[int, list[int]] = {}
    for row in truth.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k).collect():
        true_cells.setdefault(row.probe, []).append(row.cell)
    needed = [n for q, cells in true_cells.items() for n in books.needed(probe_vectors[q], cells)]
    candidates = int(np.quantile(needed, WANTED, method="higher")) if needed else 1

    # Cells in order fill shards; a cell larger than a shard has several.
    parts = np.maximum(1, -(-books.counts // SHARD))
    first = np.cumsum(np.concatenate([[0], books.counts]))[:-1] // SHARD
    shift = np.cumsum(np.concatenate([[0], parts - 1]))[:-1]
    start = (first + shift).astype(np.int64)
    layout = spark.sparkContext.broadcast((start, parts))

    def shard_of(cell: int) -> range:
        begin, n = layout.value
        return range(int(begin[cell]), int(begin[cell] + n[cell]))

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, n = layout.value
        for batch in batches:
            cell, rep = np.asarray(batch.column("cell")), np.asarray(batch.column("rep"))
            shard = begin[cell] + rep % n[cell]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), *(batch.column(c) for c in ("rep", "vector", "cell"))],
                names=["shard", "rep", "vector", "cell"],
            )

    entry_rows = placed.select("rep", "vector", "cell").mapInArrow(dealt, "shard int, rep bigint, vector array<double>, cell int")
    query_rows = queries.select("rep", "vector").mapInArrow(
        _ask(shared, candidates, shard_of), "shard int, rep bigint, vector array<double>, cells array<int>"
    )
    together = entry_rows.withColumn("tag", F.lit(0)).unionByName(query_rows.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    found = staging.pin(
        together.select("shard", "tag", "rep", "vector", "cell", "cells")
        .repartition("shard")
        .sortWithinPartitions("shard", "tag")
        .mapInArrow(_answer(k + 1), "query bigint, rep bigint, score double"),
        "found",
    )
    by_vector = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    kept = found.withColumn("_nth", F.row_number().over(by_vector)).where(F.col("_nth") <= k + 1)
    ids = placed.select(F.col("rep").alias("_rep"), "ids")
    listed = kept.join(ids, F.col("rep") == F.col("_rep")).select("query", "score", F.explode("ids").alias("vec_id"))
    by_entry = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best_ids = (
        listed.withColumn("_nth", F.row_number().over(by_entry))
        .where(F.col("_nth") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("_nth", "vec_id", "score"))).alias("found"))
    )
    names = queries.select(F.col("vector").alias("_vector"), F.col("rep").alias("_query"))
    owned = asked.join(names, F.col("vector") == F.col("_vector")).select(F.col("vec_id").alias("query_id"), "_query")
    answers = owned.join(best_ids, F.col("_query") == F.col("query"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(others).alias("_place", "_hit")).select(
        "query_id", (F.col("_place") + 1).alias("rank"), F.col("_hit.vec_id").alias("vec_id"), F.col("_hit.score").alias("score")
    )
