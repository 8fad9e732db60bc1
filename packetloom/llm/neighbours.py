"""Approximate nearest neighbours by inner product.

Distinct vectors are hashed into shards of bounded size. Each shard holds a
hierarchical navigable small-world graph as flat neighbour arrays; every block
of queries searches every shard, and the shards' results are merged. To search
by inner product, a vector gets one more component that brings all of a shard
to the same length; a query has zero there, so its products stay as they are.

Vectors that are null, zero, or hold a null or a non-finite component take no
part; vectors meet only those of their own dimension. Rows of equal vectors are
one point of the graph, of which the ``k + 1`` smallest ids are kept: no query
can need more. Rows that repeat an id count once a vector, and none of them is
returned for that id's own query. An empty table gives an empty result. Only the
id and vector columns are read, so other columns cannot clash.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import load, prepare, settled

K = 20
EVERY = 20
#: Vectors of a shard and queries of a block, on average.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LINKS = 16
EF_BUILD = 80
EF_SEARCH = 128
SEED = 11
_SLACK = 12


class Graph:
    """Layers of neighbour arrays over the rows of ``x``; row -1 is no neighbour."""

    def __init__(self, x, base=None, counts=None, upper=None, entry=0):
        self.x, self.entry = x, entry
        n = len(x)
        self.base = np.full((n, 2 * LINKS + _SLACK), -1, np.int32) if base is None else base
        self.counts = np.zeros(n, np.int32) if counts is None else counts
        self.upper = upper if upper is not None else []
        self.seen, self.mark = np.zeros(n, np.int64), 0

    def neighbours(self, layer, node):
        if layer == 0:
            return self.base[node, : self.counts[node]]
        return self.upper[layer - 1].get(node, _NONE)

    def link(self, layer, node, others):
        if layer == 0:
            self.base[node, : len(others)] = others
            self.counts[node] = len(others)
        else:
            self.upper[layer - 1][node] = np.asarray(others, np.int32)

    def search(self, q, starts, ef, layer):
        """The ``ef`` best rows found for ``q``, as (product, row), best first."""
        self.mark += 1
        seen, mark, x = self.seen, self.mark, self.x
        starts = np.asarray(starts)
        seen[starts] = mark
        best = [(s, int(i)) for s, i in zip((x[starts] @ q).tolist(), starts.tolist(), strict=True)]
        heapq.heapify(best)
        open_ = [(-s, i) for s, i in best]
        heapq.heapify(open_)
        while open_:
            s, node = heapq.heappop(open_)
            if -s < best[0][0] and len(best) >= ef:
                break
            near = self.neighbours(layer, node)
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            for t, i in zip((x[near] @ q).tolist(), near.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (t, i))
                    heapq.heappush(open_, (-t, i))
                elif t > best[0][0]:
                    heapq.heapreplace(best, (t, i))
                    heapq.heappush(open_, (-t, i))
        return sorted(best, reverse=True)

    def spread(self, node, found, most):
        """Of rows sorted by nearness, those nearer to ``node`` than to any chosen before; then the nearest others."""
        rows = np.array([i for _, i in found if i != node], np.int32)
        near = self.x[rows] @ self.x[node]
        order = np.argsort(-near, kind="stable")
        rows, near = rows[order], near[order]
        among = self.x[rows] @ self.x[rows].T
        closest, chosen, rest = np.full(len(rows), -np.inf, np.float32), [], []
        for j in range(len(rows)):
            if len(chosen) >= most:
                break
            if near[j] > closest[j]:
                chosen.append(j)
                np.maximum(closest, among[j], out=closest)
            else:
                rest.append(j)
        return rows[(chosen + rest)[:most]]

    def insert(self, node, level):
        top, starts, q = len(self.upper), [self.entry], self.x[node]
        for layer in range(top, level, -1):
            starts = [self.search(q, starts, 1, layer)[0][1]]
        for layer in range(min(level, top), -1, -1):
            found = self.search(q, starts, EF_BUILD, layer)
            most = 2 * LINKS if layer == 0 else LINKS
            chosen = self.spread(node, found, LINKS)
            self.link(layer, node, chosen)
            for other in chosen.tolist():
                held = np.append(self.neighbours(layer, other), np.int32(node))
                if len(held) > most + _SLACK:
                    held = self.spread(other, [(0, i) for i in held.tolist()], most)
                self.link(layer, other, held)
            starts = [i for _, i in found]
        while len(self.upper) < level:
            self.upper.append({node: _NONE})
            self.entry = node

    def find(self, q, k):
        starts = [self.entry]
        for layer in range(len(self.upper), 0, -1):
            starts = [self.search(q, starts, 1, layer)[0][1]]
        return [i for _, i in self.search(q, starts, max(EF_SEARCH, k), 0)][:k]


_NONE = np.empty(0, np.int32)


def build(x: np.ndarray, seed: int = SEED) -> Graph:
    norms = (x * x).sum(1)
    lift = np.sqrt(np.maximum(norms.max() - norms, 0))
    graph = Graph(np.ascontiguousarray(np.column_stack([x, lift]), np.float32))
    levels = (-np.log(1 - np.random.default_rng(seed).random(len(x))) / np.log(LINKS)).astype(int)
    for node in range(1, len(x)):
        graph.insert(node, int(levels[node]))
    return graph


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``embedding``, ``rep`` (least id) and ``ids`` (the ``k + 1`` least).

    The rank is limited within each task before the shuffle, so a vector that a
    third of all rows share sends a few rows per task.
    """
    w = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1)
    few = few.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return few.withColumn("dim", F.size("embedding"))


def index(vectors: DataFrame, n_shards: int) -> DataFrame:
    """A row per dimension and shard: vectors, ids and the graph's flat arrays."""

    def make(part):
        part = part.sort_values("rep")
        x = np.stack(part.embedding.to_numpy()).astype(np.float32)
        g = build(x)
        layers = [(layer, node, near) for layer, nodes in enumerate(g.upper, 1) for node, near in sorted(nodes.items())]
        return pd.DataFrame({
            "dim": [part["dim"].iloc[0]], "shard": [part.shard.iloc[0]], "reps": [part.rep.to_numpy()],
            "vectors": [x.ravel()], "lift": [g.x[:, -1].copy()],
            "base": [np.concatenate([g.base[i, : c] for i, c in enumerate(g.counts)]).astype(np.int32)],
            "counts": [g.counts], "upper_layer": [np.array([a for a, _, _ in layers], np.int32)],
            "upper_node": [np.array([b for _, b, _ in layers], np.int32)],
            "upper_count": [np.array([len(c) for *_, c in layers], np.int32)],
            "upper": [np.concatenate([c for *_, c in layers] + [_NONE]).astype(np.int32)], "entry": [g.entry]})

    schema = ("dim int, shard int, reps array<bigint>, vectors array<float>, lift array<float>, base array<int>, counts array<int>, "
              "upper_layer array<int>, upper_node array<int>, upper_count array<int>, upper array<int>, entry int")
    d = vectors.select("dim", "rep", "embedding", F.pmod(F.xxhash64("rep"), F.lit(n_shards)).cast("int").alias("shard"))
    return d.groupBy("dim", "shard").applyInPandas(make, schema)


def opened(row) -> Graph:
    """The graph of an index row."""
    n, counts = len(row.reps), np.asarray(row.counts, np.int32)
    x = np.column_stack([np.asarray(row.vectors, np.float32).reshape(n, -1), np.asarray(row.lift, np.float32)])
    base, ends = np.full((n, 2 * LINKS + _SLACK), -1, np.int32), np.cumsum(counts)
    for i, (e, c) in enumerate(zip(ends, counts, strict=True)):
        base[i, :c] = row.base[e - c : e]
    upper, at = [{} for _ in range(max(row.upper_layer, default=0))], 0
    for layer, node, count in zip(row.upper_layer, row.upper_node, row.upper_count, strict=True):
        upper[layer - 1][int(node)] = np.asarray(row.upper[at : at + count], np.int32)
        at += count
    return Graph(np.ascontiguousarray(x), base, counts, upper, int(row.entry))


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` nearest found.

    ``queries`` are rows (vec_id, embedding) of their own; both sides must have
    passed ``usable``. Blocks and shards have bounded size, so a task holds one
    graph and one block.
    """
    spark = vectors.sparkSession
    prepare(spark)
    points = settled(distinct_vectors(vectors, k), "vectors")
    n_shards = max(1, -(-points.count() // SHARD_ROWS))
    graphs = settled(index(points, n_shards), "graphs")
    asked = settled(queries.select(F.col("vec_id").alias("query_id"), "embedding").distinct(), "queries")
    each = asked.groupBy("embedding").agg(F.min("query_id").alias("q")).withColumn("dim", F.size("embedding"))
    each = settled(each, "query-vectors")
    n_blocks = max(1, -(-each.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("q"), F.lit(n_blocks)).cast("int")
    left = each.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    right = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def find(asked, held):
        out = []
        if len(asked) and len(held):
            row = held.iloc[0]
            graph, reps = opened(row), np.asarray(row.reps)
            exact = np.asarray(row.vectors, np.float64).reshape(len(reps), -1)
            for q, vector in zip(asked.q, asked.embedding, strict=True):
                v = np.asarray(vector, np.float64)
                rows = graph.find(np.append(v, 0).astype(np.float32), EF_SEARCH)
                score = (exact[rows] * v).sum(1)
                best = np.lexsort((reps[rows], -score))[: k + 1]
                out += [(q, reps[rows[i]], score[i]) for i in best]
        return pd.DataFrame(out, columns=["q", "rep", "score"])

    keys = ["dim", "shard", "block"]
    kind = vectors.schema["vec_id"].dataType.simpleString()
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(find, f"q {kind}, rep {kind}, score double")
    first = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    found = found.join(points.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).drop("n")
    d = asked.join(each.select("embedding", "q"), "embedding").select("query_id", "q").join(found, "q").filter("query_id <> vec_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return d.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows with an id and a vector that is not zero and has finite components only."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(sound & F.exists(v, lambda x: x != 0)).select(
        F.col(id_col).alias("vec_id"), v.alias("embedding"))


def op4_nearest_neighbours(spark, folder):
    rows = usable(load(spark, folder, "embeddings"))
    return search(rows, rows.filter(F.col("vec_id") % EVERY == 0))
