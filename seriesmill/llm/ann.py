"""Operator 10: approximate nearest neighbours by robust-pruned directed graphs, one for each shard of the vectors.

Equal vectors are one node: of their rows only the ``k + 1`` with the smallest ids can ever be among a query's
``k`` nearest, so no more are kept, and a vector of any number of copies is no hot group. Nodes are dealt by
hash into shards of about ``shard_rows``. In a shard, nodes enter the graph in random order and growing batches: a greedy
search in the graph so far proposes neighbours, and pruning takes them by distance, dropping those that a neighbour
already taken is nearer to, by the factor ``alpha``, than the node itself. Edges are put in both directions and a list
that grows too long is pruned in the same way. The graphs are written as a table (one row per node).

Queries search every shard by beam, in blocks of ``block`` queries; the shards' answers are ranked by the exact
Euclidean distance of the original vectors in double precision. This is a stated query set against all rows.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as queries or
candidates; only vectors of the query's length are its candidates; a null id takes no part; repeated rows count
once; with fewer than ``k`` candidates all are returned, if the graph reaches them (a graph of at most ``beam`` nodes
is searched whole); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import parts_for, q

K = 10
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
BEAM = 128
FRONTIER = 4
SHARD_ROWS = 8192
QUERY_BLOCK = 20_000
BATCH = 512


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of a (B, d) to rows of b (B, C, d)."""
    d = b - a[:, None, :]
    return np.einsum("bcd,bcd->bc", d, d)


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes found and their squared distances, nearest first; -1 and infinity where there are fewer.

    ``graph``: neighbours of each node, -1 where there is none.
    """
    b, n = len(queries), len(points)
    rows = np.arange(b)
    seen = np.zeros((b, n), bool)
    ids = np.full((b, beam), -1)
    far = np.full((b, beam), np.inf, np.float32)
    opened = np.ones((b, beam), bool)  # expanded, or empty
    ids[:, 0], far[:, 0], opened[:, 0] = entry, _squares(queries, points[[entry]][None].repeat(b, 0))[:, 0], False
    seen[:, entry] = True
    while True:
        rank = np.where(opened, np.inf, far)
        at = np.argsort(rank, axis=1, kind="stable")[:, :FRONTIER]
        use = ~np.take_along_axis(opened, at, 1)
        active = np.flatnonzero(use.any(axis=1))
        if not len(active):
            return ids, far
        at, use = at[active], use[active]
        nodes = np.where(use, ids[active[:, None], at], -1)
        opened[active[:, None], at] = True
        found = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(active), -1)
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        new = (found >= 0) & ~seen[active[:, None], found]
        r, c = np.nonzero(new)
        seen[active[r], found[r, c]] = True
        distance = np.full(found.shape, np.inf, np.float32)
        difference = points[found[r, c]] - queries[active[r]]
        distance[r, c] = np.einsum("nd,nd->n", difference, difference)
        all_ids = np.concatenate([ids[active], np.where(new, found, -1)], axis=1)
        all_far = np.concatenate([far[active], distance], axis=1)
        all_open = np.concatenate([opened[active], ~new], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        far[active] = np.take_along_axis(all_far, order, 1)
        opened[active] = np.take_along_axis(all_open, order, 1)


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (-1: none), near and in different directions."""
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    vectors = points[candidates]
    away = np.where(candidates >= 0, _squares(points[nodes], vectors), np.inf)
    order = np.argsort(away, axis=1, kind="stable")
    candidates, away = np.take_along_axis(candidates, order, 1), np.take_along_axis(away, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    alive = np.isfinite(away)
    kept = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[some, k] = candidates[rows, first][some]
        between = _squares(vectors[rows, first], vectors)
        alive &= alpha * alpha * between > away
        alive[rows, first] = False
    return kept


def _in_batches(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    parts = [robust_prune(points, nodes[k : k + BATCH], candidates[k : k + BATCH], degree, alpha) for k in range(0, len(nodes), BATCH)]
    return np.concatenate(parts) if parts else np.full((0, degree), -1)


def build_graph(points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 5) -> tuple[np.ndarray, int]:
    """Neighbours of every node (-1: none) and the node where searches start, the one nearest the middle."""
    n = len(points)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, 2 * degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done : done + min(done, BATCH)]
        near, _ = beam_search(points, graph, entry, points[batch], beam)
        own = _in_batches(points, batch, near, degree, alpha)
        graph[batch, :degree] = own
        r, c = np.nonzero(own >= 0)
        target, source = own[r, c], batch[r]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.zeros(0, int)
        counts = np.diff(np.r_[starts, len(target)])
        nodes = target[starts]
        within = np.arange(len(target)) - np.repeat(starts, counts)
        wide = np.full((len(nodes), 2 * degree + int(counts.max(initial=0))), -1)
        wide[:, : 2 * degree] = graph[nodes]
        wide[np.repeat(np.arange(len(nodes)), counts), 2 * degree + within] = source
        wide = -np.sort(-wide, axis=1)  # empty places last
        full = (wide[:, 2 * degree :] >= 0).any(axis=1)
        graph[nodes[~full]] = wide[~full, : 2 * degree]
        graph[nodes[full]] = -1
        graph[nodes[full], :degree] = _in_batches(points, nodes[full], wide[full], degree, alpha)
        done += len(batch)
    return graph, entry


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


GRAPH = "shard int, dim int, node int, entry boolean, vector array<double>, neighbours array<int>, ids array<long>"


def build_index(df: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, alpha: float = ALPHA, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The graphs of all shards as a table: shard, dim, node, entry, vector, neighbours, ids (at most k + 1)."""
    rows = df.select(q(id_col).cast("long").alias("id"), q(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = materialize(nodes.withColumn("dim", F.size("vector")), "vectors")
    shards = parts_for(nodes.count(), shard_rows)
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64(F.get("ids", 0)), F.lit(shards)).cast("int"))

    def link(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ids", key=lambda s: s.str[0], ignore_index=True)
        graph, entry = build_graph(np.stack(group["vector"].to_numpy()).astype(np.float32), degree, alpha)
        group["node"] = np.arange(len(group), dtype=np.int32)
        group["entry"] = group["node"] == entry
        group["neighbours"] = [row[row >= 0].astype(np.int32) for row in graph]
        return group[["shard", "dim", "node", "entry", "vector", "neighbours", "ids"]]

    return materialize(nodes.groupBy("shard", "dim").applyInPandas(link, GRAPH), "graph")


FOUND = "query_id long, id long, score double"


def search(index: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. ``queries``: query_id, vector (array of double); ids equal to the query's are left out."""
    queries = queries.distinct().withColumn("dim", F.size("vector"))
    blocks = parts_for(queries.count(), block)
    shards = index.select(F.col("shard").alias("to_shard"), F.col("dim").alias("to_dim")).distinct()
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.join(shards, F.col("dim") == F.col("to_dim"))
    served = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(key: tuple, graph: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(asking):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64", "score": "float64"})
        graph = graph.sort_values("node", ignore_index=True)
        exact = np.stack(graph["vector"].to_numpy())
        points = exact.astype(np.float32)
        width = max(1, int(graph["neighbours"].str.len().max()))
        links = np.full((len(graph), width), -1)
        for row, near in zip(links, graph["neighbours"]):
            row[: len(near)] = near
        entry = int(graph["entry"].to_numpy().argmax())
        own, vectors = asking["query_id"].to_numpy(), np.stack(asking["vector"].to_numpy())
        out: list[tuple[int, int, float]] = []
        for at in range(0, len(own), BATCH):
            asked_now = vectors[at : at + BATCH]
            if len(points) <= beam:
                near = np.tile(np.arange(len(points)), (len(asked_now), 1))
            else:
                near, _ = beam_search(points, links, entry, asked_now.astype(np.float32), beam)
            score = np.sqrt(_squares(asked_now, exact[near]))
            score[near < 0] = np.inf
            for query, nodes, away in zip(own[at : at + BATCH].tolist(), near, score):
                found: list[tuple[float, int]] = []
                last = np.inf
                for j in np.argsort(away, kind="stable").tolist():
                    if away[j] == np.inf or (len(found) >= k and away[j] > last):
                        break
                    found += [(float(away[j]), int(i)) for i in graph["ids"].iat[nodes[j]] if i != query]
                    last = away[j]
                out += [(query, i, s) for s, i in sorted(found)[:k]]
        return pd.DataFrame(out, columns=["query_id", "id", "score"])

    found = served.groupBy("shard", "dim", "block").cogroup(asked.groupBy("to_shard", "to_dim", "block")).applyInPandas(answer, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = vectors.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return search(build_index(vectors), asked.where(usable(F.col("vector"))))
