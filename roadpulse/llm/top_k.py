"""Exact top-k by inner product with two cover trees.

Vectors are dealt to blocks, queries to blocks of their own, and each pair of blocks is one task. It
builds a cover tree over either block and walks both trees at once: a pair of nodes is left out if no
query in the one can reach, with any vector in the other, the worst k-th score its group has so far.
The bound comes from the centres' product, their norms and the covering radii. What is left is scored
in matrix products; the k best of all blocks are then ranked for each query.

Components are taken as floor(256 * x). A vector that is null, empty or has null or non-finite
components takes no part, nor does one with a null id. If an id is repeated, its least vector counts.
Vectors of another length than the query's are no candidates. Ties go to the smaller id. Sums must stay
below 2**53, which holds for 1,000 components below 2**21 after scaling.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadpulse.session import ship_package

SCALE = 256
VECTORS, QUERIES = 8192, 4096  # rows of a block, on average
LEAF = 64


class Tree:
    """A cover tree: a node's points lie within its radius of its centre, and its children halve the radius.

    The points of a node are a run of `order`. Points that would be alone or nearly so in a child stay
    together in one leaf of their parent's centre, as do those that a number of centres leave uncovered.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF, centres: int = 64):
        self.points, self.leaf, self.centres = points, leaf, centres
        self.norms = np.sqrt((points * points).sum(1))
        self.order = np.empty(len(points), np.int64)
        self.filled = 0
        self.root = self._node(np.arange(len(points)))

    def _distances(self, centre: int, at: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[at] - self.points[centre]) ** 2).sum(1))

    def _node(self, at: np.ndarray, centre: int | None = None) -> dict:
        centre = int(at[0]) if centre is None else centre
        radius = float(self._distances(centre, at).max())
        node = {"centre": centre, "radius": radius, "start": self.filled, "children": []}
        if len(at) <= self.leaf or radius == 0:
            self.order[self.filled : self.filled + len(at)] = at
            self.filled += len(at)
        else:
            rest, few = at, []
            for _ in range(self.centres):
                if not len(rest):
                    break
                near = self._distances(int(rest[0]), rest) <= radius / 2
                if near.sum() >= self.leaf // 4:
                    node["children"].append(self._node(rest[near]))
                else:
                    few.append(rest[near])
                rest = rest[~near]
            if few or len(rest):
                few = np.concatenate([*few, rest])
                node["children"].append({"centre": centre, "radius": float(self._distances(centre, few).max()), "start": self.filled, "children": [], "end": self.filled + len(few)})
                self.order[self.filled : self.filled + len(few)] = few
                self.filled += len(few)
        node["end"] = self.filled
        return node

    def at(self, node: dict) -> np.ndarray:
        return self.order[node["start"] : node["end"]]


class Search:
    """The k best of one block of vectors for each query of another."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
        by_id = np.argsort(ids, kind="stable")  # so that a stable sort prefers smaller ids
        self.q, self.q_ids, self.x, self.ids, self.k = queries, query_ids, vectors[by_id], ids[by_id], k
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.scored = 0
        self.asked, self.data = Tree(queries, LEAF // 4), Tree(self.x)
        self.worst = np.full(len(queries), -np.inf)  # of each query in the order of its tree
        self._walk(self.asked.root, self.data.root)

    def _bound(self, a: dict, b: dict) -> float:
        p, q = self.q[a["centre"]], self.x[b["centre"]]
        norms = self.asked.norms[a["centre"]] * b["radius"] + self.data.norms[b["centre"]] * a["radius"]
        bound = p @ q + norms + a["radius"] * b["radius"]
        return bound + 1e-9 * abs(bound) + 1e-6  # radii are rounded

    def _hopeless(self, a: dict, bound: float) -> bool:
        return bound < self.worst[a["start"] : a["end"]].min()  # an equal score may win by its id

    def _walk(self, a: dict, b: dict) -> None:
        if self._hopeless(a, self._bound(a, b)):
            return
        if not a["children"] and not b["children"]:
            self._score(a, b)
        elif a["children"] and (not b["children"] or a["radius"] > b["radius"]):
            for child in a["children"]:
                self._walk(child, b)
        else:
            for bound, _, child in sorted(((-self._bound(a, c), k, c) for k, c in enumerate(b["children"]))):
                if not self._hopeless(a, -bound):
                    self._walk(a, child)

    def _score(self, a: dict, b: dict) -> None:
        q, x = self.asked.at(a), np.sort(self.data.at(b))
        self.scored += len(q) * len(x)
        scores = self.q[q] @ self.x[x].T
        scores[self.q_ids[q][:, None] == self.ids[x][None, :]] = -np.inf
        ids = np.broadcast_to(self.ids[x], scores.shape)
        if scores.shape[1] > 4 * self.k:  # what is below the k-th best here is out
            least = np.partition(scores, -self.k, axis=1)[:, -self.k]
            best = np.argsort(-np.where(scores >= least[:, None], scores, -np.inf), axis=1, kind="stable")[:, : self.k]
            scores, ids = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)
        scores, ids = np.concatenate([self.scores[q], scores], 1), np.concatenate([self.found[q], ids], 1)
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[q], self.found[q] = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)
        self.worst[a["start"] : a["end"]] = self.scores[q][:, -1]


def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding",
          vectors_in_block: int = VECTORS, queries_in_block: int = QUERIES) -> DataFrame:
    """query_id, rank, the id and score of each query's k best among all other vectors (all, if fewer)."""
    ship_package(vectors.sparkSession)
    usable = (vectors.filter(F.col(id).isNotNull() & _usable(F.col(vector)))
              .select(F.col(id).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")).cast("double")).alias("v"),
                      F.coalesce(is_query, F.lit(False)).alias("asks"))
              .groupBy("id").agg(F.min("v").alias("v"), F.bool_or("asks").alias("asks")).withColumn("size", F.size("v")))
    counted = usable.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("q")).first()
    n_blocks = max(1, math.ceil(counted.n / vectors_in_block))
    q_blocks = max(1, math.ceil((counted.q or 0) / queries_in_block))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = usable.filter("asks").withColumn("a", block(q_blocks)).withColumn("b", every(n_blocks)).select("size", "a", "b", "id", "v")
    data = usable.withColumn("b", block(n_blocks)).withColumn("a", every(q_blocks)).select("size", "a", "b", "id", "v")
    schema = T.StructType().add("query_id", "long").add("id", "long").add("score", "long")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            q, x = (np.stack(t.column("v").to_numpy()) for t in (left, right))
            q_ids, ids = (t.column("id").to_numpy() for t in (left, right))
            found = Search(q, q_ids, x, ids, k)
            real = np.isfinite(found.scores)
            out = [np.repeat(q_ids, k).reshape(-1, k)[real], found.found[real], found.scores[real].astype(np.int64)]
        return pa.Table.from_arrays([pa.array(x) for x in out], names=["query_id", "id", "score"])

    keys = ("size", "a", "b")
    best = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(search, schema)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")


def op5_exact_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


SQL = """
with v as (select vec_id, [floor(256 * x::double)::bigint for x in embedding] as e from embeddings
           where vec_id is not null and len(embedding) > 0
             and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
q as (select vec_id as query_id, unnest(e) as x, unnest(range(len(e))) as i, len(e) as size from v where vec_id % 50 = 0),
c as (select vec_id, unnest(e) as x, unnest(range(len(e))) as i, len(e) as size from v),
s as (select query_id, vec_id, sum(q.x * c.x)::bigint as score from q join c using (i, size) where query_id <> vec_id group by all)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""
