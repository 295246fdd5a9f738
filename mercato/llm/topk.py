"""Exact top-k by inner product with an impact-ordered index, score at a time.

Candidates are dealt into blocks. In a block every component is quantised to an impact level, and the rows of one
dimension and level make a posting segment. A query takes the segments in the order of their share of the score,
largest first, and adds them up. Between steps two bounds are known for each row: what it has, plus the least and the
most that the rest can bring. Rows whose upper bound lies below the k-th best lower bound cannot be members; when few
are left, or nothing is, these are scored exactly. Results of the blocks are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mercato.llm.vectors import scaled, usable
from mercato.session import materialise

SCALE = 1024
MOST = 1 << 24  # scaled components stay below this in size
BLOCK, QUERY_BLOCK = 8192, 8192  # rows, and queries, that meet in one task
LEVEL_BITS = 4  # an impact level is 16 wide
STEPS = 8  # of a query's postings in a block


class ImpactIndex:
    """Posting segments of a block of integer vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        count, self.dimensions = vectors.shape
        levels = (vectors >> LEVEL_BITS).T  # a row per dimension
        order = np.argsort(levels, axis=1, kind="stable")
        ranked = np.take_along_axis(levels, order, axis=1)
        fresh = np.ones(ranked.shape, bool)
        fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        self.postings = order.ravel()
        self.starts = np.flatnonzero(fresh.ravel())
        self.sizes = np.diff(np.append(self.starts, self.postings.size))
        self.segment_dimension = self.starts // max(count, 1)
        self.base = ranked.ravel()[self.starts] << LEVEL_BITS  # least value of the segment

    def possible(self, query: np.ndarray, k: int, without: np.ndarray) -> np.ndarray:
        """Rows that may be among the k best, ``without`` left out; all true members are in it."""
        count = len(self.vectors)
        weight = query[self.segment_dimension]
        impact = weight * self.base
        by = np.argsort(-np.abs(impact), kind="stable")
        spread = ((1 << LEVEL_BITS) - 1) * query  # of a component within its level
        least_rest, most_rest = np.minimum(spread, 0).sum(), np.maximum(spread, 0).sum()
        ends = np.cumsum(self.sizes[by])
        sums = np.zeros(count)
        at = 0
        for step in range(1, STEPS + 1):
            past = int(np.searchsorted(ends, ends[-1] * step // STEPS)) + 1 if step < STEPS else len(by)
            taken = by[at:past]
            sizes = self.sizes[taken]
            rows = np.arange(sizes.sum()) + np.repeat(self.starts[taken] - np.cumsum(sizes) + sizes, sizes)
            sums += np.bincount(self.postings[rows], np.repeat(impact[taken], sizes), count)
            at = past
            left = by[at:]
            low, high = np.zeros(self.dimensions), np.zeros(self.dimensions)  # 0: the row's segment may be done
            np.minimum.at(low, self.segment_dimension[left], impact[left])
            np.maximum.at(high, self.segment_dimension[left], impact[left])
            lower = sums + (least_rest + low.sum())
            lower[without] = -np.inf
            bar = np.partition(lower, count - k)[count - k] if k < count else -np.inf
            maybe = lower + (most_rest + high.sum() - least_rest - low.sum()) >= bar
            maybe[without] = False
            if maybe.sum() <= 4 * k:
                break
        return np.flatnonzero(maybe)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists as rows; shorter ones are filled up with zeros, which add nothing to a product."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


_RESULT = StructType([StructField(n, LongType()) for n in ("query_row", "query_id", "row", "id", "score")])


def _search_block(k: int):
    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        found = [[] for _ in range(5)]
        if len(queries) and len(block):
            rows, ids = _column(block, "row"), _column(block, "id")
            vectors = _matrix(block.column("vector").combine_chunks())
            asked = _matrix(queries.column("vector").combine_chunks())
            wide = max(vectors.shape[1], asked.shape[1])
            vectors, asked = (np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (vectors, asked))
            index = ImpactIndex(vectors)
            for query_row, query_id, query in zip(_column(queries, "row"), _column(queries, "id"), asked):
                if wide:
                    maybe = index.possible(query, k, np.flatnonzero(rows == query_row))
                else:
                    maybe = np.flatnonzero(rows != query_row)
                scores = vectors[maybe] @ query
                best = np.lexsort((rows[maybe], ids[maybe], -scores))[:k]
                for column, values in zip(found, (query_row, query_id, rows[maybe[best]], ids[maybe[best]], scores[best])):
                    column.append(np.broadcast_to(values, len(best)))
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in found]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=_RESULT.names)

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, ``id_col``, score: the ``k`` rows of largest inner product with each query row but itself.

    Queries are the rows of ``vectors`` where ``is_query`` holds. Equal scores go to the smaller id, then to the earlier
    row. Vectors that are null or hold a null or non-finite component, and null ids, take no part. Repeated rows are rows of their own, as queries and as candidates. A
    shorter vector counts as filled up with zeros; empty ones score 0. Scaled components of 2**24 or more in size raise, as
    sums are exact below. Fewer than ``k`` other rows are all returned; an empty table gives none. Extra columns are
    not read.
    """
    rows = vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), scaled(F.col(vector_col), SCALE, MOST).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).collect()[0]
    blocks, query_blocks = (max(1, -(-sizes[n] // size)) for n, size in (("n", BLOCK), ("q", QUERY_BLOCK)))
    dealt = rows.withColumn("mixed", F.xxhash64("row"))

    def everywhere(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # every block of queries meets every block of rows: a grid, each cell of bounded size
    candidates = dealt.select("row", "id", "vector", F.pmod("mixed", F.lit(blocks)).cast("int").alias("block"), everywhere(query_blocks).alias("part"))
    queries = dealt.filter("asks").select(
        "row", "id", "vector", F.pmod("mixed", F.lit(query_blocks)).cast("int").alias("part"), everywhere(blocks).alias("block"))
    found = (
        queries.groupBy("block", "part").cogroup(candidates.groupBy("block", "part"))
        .applyInArrow(_search_block(k), _RESULT))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score"))
