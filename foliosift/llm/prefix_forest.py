"""Operator 9, nearest neighbours by a forest of sorted hash prefixes.

Every vector gets one long hash string per tree (signs of random projections around the
sample's mean). Rows are dealt to blocks; in a block each tree is a sorted array of those
strings. A query descends every tree to its longest matching prefix and then ascends all
trees together, one depth at a time, until they hold enough candidates; the nearest of them by
exact distance are kept. The nearest over all blocks are the result. At the shares of a block
that vectors without structure need, the distances of the whole block are one matrix product,
of which those of the candidates are taken.

Blocks are of bounded size, so memory is bounded whatever the number of rows, and neither
candidates nor pairs leave a block: a query leaves at most ``k`` rows there, its answer. The
vectors need no copies per tree. Queries stream through a block.

The mean is fitted on at most ``fit_rows`` rows (smallest hash); every row is indexed. Vectors
that are null, zero, or hold null or non-finite components take no part, nor do rows with a
null id. Only vectors of the same length are neighbours of each other. Ties go to the smaller
id. Rows that repeat an id are candidates one by one; a query's own id never is, and a query
id that repeats is searched once, by its smallest vector. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliosift.llm.common import quoted, require_columns
from foliosift.session import materialise

#: Bits of a hash string.
BITS = 24


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Forest:
    """The trees over one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centre: np.ndarray, trees: int, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.centre, self.trees = centre, trees
        # One family for all blocks, made anew from the seed.
        self.planes = np.random.default_rng(seed).normal(size=(trees * BITS, vectors.shape[1]))
        words = self._words(self.vectors)
        self.rows = np.argsort(words, axis=0, kind="stable")
        self.sorted = np.take_along_axis(words, self.rows, axis=0)

    def _words(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.centre) @ self.planes.T > 0
        return bits.reshape(len(vectors), self.trees, BITS) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float):
        """(query, id, squared distance) of each query's k nearest candidates."""
        words = self._words(queries)
        wanted = min(len(self.ids), max(2 * k, int(np.ceil(share * len(self.ids)))))
        found = np.zeros((len(queries), len(self.ids)), bool)
        open_, depth = np.arange(len(queries)), BITS
        while len(open_) and depth >= 0:
            low = words[open_] >> (BITS - depth) << (BITS - depth)
            high = low + (1 << (BITS - depth))
            for t in range(self.trees):
                a = np.searchsorted(self.sorted[:, t], low[:, t])
                b = np.searchsorted(self.sorted[:, t], high[:, t])
                for q in np.flatnonzero(b > a):
                    found[open_[q], self.rows[a[q] : b[q], t]] = True
            open_ = open_[found[open_].sum(axis=1) < wanted]
            depth -= 1
        found &= self.ids[None, :] != query_ids[:, None]
        near = (queries**2).sum(axis=1)[:, None] + (self.vectors**2).sum(axis=1)[None] - 2 * queries @ self.vectors.T
        near[~found] = np.inf
        for q in range(len(queries)):
            at = np.flatnonzero(found[q])
            if len(at) > k:
                # Rounding of the product form must not decide: take what is close, then measure.
                limit = np.partition(near[q, at], k - 1)[k - 1]
                at = at[near[q, at] <= limit + 1e-9 * (1 + abs(limit))]
            exact = ((self.vectors[at] - queries[q]) ** 2).sum(axis=1)
            for i in np.lexsort((self.ids[at], exact))[:k]:
                yield query_ids[q], self.ids[at[i]], exact[i]


def block_count(rows: int, smallest: int = 1024, largest: int = 65_536, wanted: int = 64) -> int:
    """Blocks of at most ``largest`` rows; up to ``wanted`` of them while that leaves ``smallest``."""
    return max(1, -(-rows // largest), min(wanted, -(-rows // smallest)))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = 64,
    share: float = 0.45,
    fit_rows: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance), nearest first by rank.

    ``share``: the part of a block that the ascent gathers before it stops; it sets recall.
    """
    require_columns(vectors, id_col, vector_col)
    doubles = quoted(vector_col).cast("array<double>")
    rows = (
        vectors.select(quoted(id_col).cast("bigint").alias("id"), doubles.alias("v"), is_query.alias("asks"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .withColumn("dim", F.size("v"))
    )
    # More than k rows with one id and vector cannot be told from k: groups of such copies are
    # combined before the shuffle and cannot fill a block.
    once = rows.groupBy("id", "v", "dim").agg(F.max("asks").alias("asks"), F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    once = materialise(once, "forest-rows")
    rows = once.select("id", "v", "dim", "asks", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # one row per length
    answer = "query_id bigint, vec_id bigint, square double, dim int"
    if not sizes:
        empty = rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"))
        return empty.withColumn("score", F.lit(0.0)).where(F.lit(False))
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(fit_rows).select("v").toPandas()["v"]
    by_dim: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(np.asarray(v, np.float64))
    centres = {d: np.mean(x, axis=0) for d, x in by_dim.items()}
    counts = F.create_map(*[F.lit(int(x)) for d, n in sizes.items() for x in (d, block_count(n))])
    blocks = F.element_at(counts, F.col("dim"))
    index = rows.select("dim", F.pmod(F.xxhash64("id", "v"), blocks).cast("int").alias("block"), F.lit(0).alias("part"), "id", "v")
    # One search for a repeated id; the map side keeps one vector of each.
    asking = once.where("asks").groupBy("id", "dim").agg(F.min("v").alias("v"))
    queries = asking.select(
        "dim", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("part"), "id", "v"
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block, the indexed ones before the queries."""
        key, forest, held = None, None, []
        for batch in batches:
            for (dim, block, part), some in batch.groupby(["dim", "block", "part"], sort=False):
                if (dim, block) != key:
                    key, forest, held = (dim, block), None, []
                if part == 0:
                    held.append((some["id"].to_numpy(), np.stack(some["v"].to_list())))
                    continue
                if forest is None:
                    if not held:
                        continue
                    ids, own = (np.concatenate(x) for x in zip(*held, strict=True))
                    forest = Forest(ids, own, centres.get(dim, np.zeros(dim)), trees, seed)
                    held = []
                for at in range(0, len(some), 256):
                    asked = some.iloc[at : at + 256]
                    found = list(forest.search(asked["id"].to_numpy(), np.stack(asked["v"].to_list()), k, share))
                    yield pd.DataFrame(found, columns=["query_id", "vec_id", "square"]).assign(dim=dim)

    dealt = index.unionByName(queries).repartition("dim", "block").sortWithinPartitions("dim", "block", "part")
    found = dealt.mapInPandas(search, answer)
    best = Window.partitionBy("query_id").orderBy("square", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.sqrt("square").alias("score"))
    )
