"""Approximate nearest neighbours: a navigable small-world graph per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash. Each shard's
task builds one hierarchical graph (HNSW): every vector draws a top level,
enters by greedy descent, and links to the nearest of its search results that
aren't nearer to a chosen neighbour than to itself. The graph is stored as flat
neighbour arrays: one row a shard, written to the shared folder, so that a lost
executor rebuilds one shard. Every query searches every shard, in blocks of
queries; the shards' best are merged by an exact cosine in double precision.

Equal vectors are one point of the graph that carries its smallest ids (one
more than asked for, so that a query's own can go), so a vector that a third of
all rows share neither fills a neighbourhood nor a task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import write_once

K = 5
SHARD_ROWS = 8_192
QUERY_BLOCK = 10_000
LINKS = 16
EF_BUILD = 64
EF_SEARCH = 192

INDEX = (
    "shard int, dim int, n int, entry int, top int, vectors binary, ids array<array<long>>, "
    "neighbours binary, upper_nodes array<binary>, upper_neighbours array<binary>"
)


class Graph:
    """Flat arrays of one shard: unit vectors (float32), the base layer's
    neighbours (n x 2 LINKS, -1 where free) and per upper layer its nodes and
    their neighbours (m x LINKS)."""

    def __init__(self, unit: np.ndarray, base: np.ndarray, upper: list[dict[int, np.ndarray]], entry: int):
        self.unit, self.base, self.upper, self.entry = unit, base, upper, entry
        self.seen = np.zeros(len(unit), np.int32)
        self.mark = 0

    def near(self, q: np.ndarray, starts: list[int], ef: int, layer: int) -> list[tuple[float, int]]:
        """Up to ``ef`` (similarity, node) found from ``starts``, unordered."""
        self.mark += 1
        seen, mark, unit = self.seen, self.mark, self.unit
        links = self.base if layer == 0 else self.upper[layer - 1]
        seen[starts] = mark
        sims = (unit[starts] @ q).tolist()
        open_ = [(-s, i) for s, i in zip(sims, starts)]
        best = list(zip(sims, starts))
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            s, node = heapq.heappop(open_)
            if -s < best[0][0] and len(best) >= ef:
                break
            nodes = links[node]
            nodes = nodes[nodes >= 0]
            nodes = nodes[seen[nodes] != mark]
            if not len(nodes):
                continue
            seen[nodes] = mark
            found = unit[nodes] @ q
            if len(best) >= ef:
                better = found > best[0][0]
                nodes, found = nodes[better], found[better]
            for s, i in zip(found.tolist(), nodes.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                else:
                    continue
                heapq.heappush(open_, (-s, i))
        return best

    def descend(self, q: np.ndarray, to: int) -> int:
        node = self.entry
        for layer in range(len(self.upper), to, -1):
            node = max(self.near(q, [node], 1, layer))[1]
        return node

    def search(self, q: np.ndarray, ef: int) -> list[int]:
        return [i for _, i in self.near(q, [self.descend(q, 0)], ef, 0)]


def _diverse(unit: np.ndarray, found: list[tuple[float, int]], limit: int) -> list[int]:
    """Nearest first, without those nearer to a chosen one than to the node;
    the room left goes to the nearest of the others."""
    found = sorted(found, reverse=True)
    nodes = np.array([i for _, i in found])
    between = unit[nodes] @ unit[nodes].T
    chosen: list[int] = []
    rest: list[int] = []
    for k, (s, _) in enumerate(found):
        if len(chosen) >= limit:
            break
        (rest if chosen and between[k, chosen].max() > s else chosen).append(k)
    return nodes[(chosen + rest)[:limit]].tolist()


def build_graph(unit: np.ndarray, links: int = LINKS, ef: int = EF_BUILD) -> Graph:
    """Graph over unit vectors, inserted in their order; levels from a fixed seed."""
    n = len(unit)
    levels = (-np.log(1.0 - np.random.RandomState(8).random_sample(n)) / math.log(links)).astype(int)
    g = Graph(unit, np.full((n, 2 * links), -1, np.int32), [], 0)
    g.upper = [{} for _ in range(int(levels[0]))]
    for layer in range(len(g.upper)):
        g.upper[layer][0] = np.full(links, -1, np.int32)
    for node in range(1, n):
        q, level = unit[node], int(levels[node])
        starts = [g.descend(q, min(level, len(g.upper)))]
        for layer in range(min(level, len(g.upper)), -1, -1):
            found = g.near(q, starts, ef, layer)
            starts = [i for _, i in found]
            chosen = _diverse(unit, found, links)
            table = g.base if layer == 0 else g.upper[layer - 1]
            width = 2 * links if layer == 0 else links
            row = np.full(width, -1, np.int32)
            row[: len(chosen)] = chosen
            table[node] = row
            for other in chosen:
                theirs = table[other]
                free = np.flatnonzero(theirs < 0)
                if len(free):
                    theirs[free[0]] = node
                else:
                    asked = np.append(theirs, node)
                    sims = (unit[asked] @ unit[other]).tolist()
                    kept = _diverse(unit, list(zip(sims, asked.tolist())), width)
                    theirs[:] = -1
                    theirs[: len(kept)] = kept
        if level > len(g.upper):
            for _ in range(len(g.upper), level):
                g.upper.append({node: np.full(links, -1, np.int32)})
            g.entry = node
    return g


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest part first, so that no square over- or underflows.
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("order")
    vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    g = build_graph(_unit(vectors).astype(np.float32))
    return pd.DataFrame([{
        "shard": key[1],
        "dim": key[0],
        "n": len(vectors),
        "entry": g.entry,
        "top": len(g.upper),
        "vectors": vectors.tobytes(),
        "ids": [list(map(int, i)) for i in rows["ids"]],
        "neighbours": g.base.tobytes(),
        "upper_nodes": [np.array(list(u), np.int32).tobytes() for u in g.upper],
        "upper_neighbours": [np.stack(list(u.values())).tobytes() for u in g.upper],
    }])


def _load(row: pd.Series) -> tuple[Graph, np.ndarray]:
    exact = _unit(np.frombuffer(row["vectors"]).reshape(row["n"], row["dim"]))
    base = np.frombuffer(row["neighbours"], np.int32).reshape(row["n"], 2 * LINKS)
    upper = [
        dict(zip(np.frombuffer(n, np.int32).tolist(), np.frombuffer(b, np.int32).reshape(-1, LINKS)))
        for n, b in zip(row["upper_nodes"], row["upper_neighbours"])
    ]
    return Graph(exact.astype(np.float32), base, upper, row["entry"]), exact


def _search(k: int, ef: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for _, row in index.iterrows():
            graph, exact = _load(row)
            for query_id, embedding in zip(queries["query_id"], queries["embedding"]):
                q = _unit(np.asarray(embedding, np.float64)[None, :])[0]
                at = graph.search(q.astype(np.float32), max(ef, k + 1))
                scores = exact[at] @ q
                own = [(-s, i) for s, node in zip(scores.tolist(), at) for i in row["ids"][node] if i != query_id]
                out.extend((query_id, i, -s) for s, i in heapq.nsmallest(k, own))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def _usable(embedding: Column) -> Column:
    """No null, a finite number in each place, and one that isn't zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return embedding.isNotNull() & ~F.exists(embedding, bad) & F.exists(embedding, lambda x: x != 0)


def build_index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of all usable rows of ``vectors`` (``vec_id, embedding``): one
    row per shard and dimension (see ``INDEX``), written to the shared folder."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull()).filter(_usable(F.col("embedding"))).distinct()
    # Spark limits each task's groups before the shuffle, so a common vector stays small.
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    points = rows.withColumn("first", first).filter(F.col("first") <= k + 1)
    points = write_once(points.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-points")
    shards = max(1, math.ceil(points.count() / shard_rows))
    order = F.xxhash64("embedding")
    dealt = points.withColumns({"order": order, "dim": F.size("embedding"), "shard": F.pmod(order, F.lit(shards)).cast("int")})
    return write_once(dealt.groupBy("dim", "shard").applyInPandas(_build, INDEX), "ann-index")


def nearest(vectors: DataFrame, every: int = 50, k: int = K, ef: int = EF_SEARCH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each usable row of ``vectors`` whose vec_id is divisible by ``every``:
    its ``k`` nearest found, by cosine. ``query_id, rank, vec_id, score``.

    Defined cases: vectors that are null, empty, zero or hold a null or
    non-finite part take no part, as do rows without a vec_id; vectors of
    another length than the query's aren't candidates; equal rows count once; a
    row with the query's vec_id is the query's own; ties go to the smaller
    vec_id; fewer than ``k`` candidates give as many rows; other columns aren't
    read; an empty table gives an empty result.
    """
    index = build_index(vectors, k, shard_rows)
    places = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] + 1
    queries = vectors.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    queries = queries.filter((F.col("query_id") % every == 0)).filter(_usable(F.col("embedding"))).distinct()
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    asked = queries.withColumns({
        "dim": F.size("embedding"),
        "shard": F.explode(F.sequence(F.lit(0), F.lit(places - 1))),
        "block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"),
    })
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(_search(k, ef), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
