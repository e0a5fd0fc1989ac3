"""Exact top-k by inner product over an impact-ordered index.

Vectors are indexed in blocks. For every dimension a block holds its rows in the
order of their quantised component; rows of equal level are a segment. What a
segment adds to a query's score lies between two bounds, counted from the least
the dimension can add. Segments are processed by descending upper bound, for all
rows of a segment at once. Rows whose remaining segments cannot lift them to the
k-th best lower bound are out; when few are left, these are scored exactly. The
search of a block ends by that proof only, or when all segments are processed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logstow.llm.tables import written

#: Scaled components beyond this would not fit the index's 32-bit values.
LARGEST = float(2**31 - 1)
#: Shares of a block's postings after which the proof is tried.
ROUNDS = (0.5, 0.75, 0.9, 0.96, 1.0)


@dataclass(frozen=True)
class Blocks:
    """Sizes: vectors of an index block, queries that meet a block in one group,
    and levels of a quantised component."""

    vectors: int = 16_384
    queries: int = 512
    levels: int = 64


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """Rows (vec_id, v): floor(scale * component) of vectors that take part.

    Left out: a null id, a null or empty vector, a null or non-finite component,
    and one whose scaled value does not fit 32 bits.
    """

    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < LARGEST)

    good = F.col(id_column).isNotNull() & (F.size(vector_column) > 0)
    good &= F.forall(vector_column, lambda x: F.coalesce(fits(x), F.lit(False)))
    return vectors.filter(good).select(
        F.col(id_column).cast("long").alias("vec_id"),
        _scaled(F.col(vector_column), scale).alias("v"),
    )


class Block:
    """Rows of equal width, with the postings of every dimension by level."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, levels: int):
        self.ids, self.values, self.levels = ids, values, levels
        self.low = int(values.min())
        self.step = (int(values.max()) - self.low) // levels + 1
        code = (values.astype(np.int64) - self.low) // self.step
        self.order = np.argsort(code, axis=0, kind="stable").T
        edges = np.arange(levels + 1)
        self.starts = np.stack(
            [np.searchsorted(np.sort(code[:, d]), edges) for d in range(values.shape[1])]
        )

    def _slice(self, d: int, upward: bool, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings with ranks first to last - 1 of a dimension, and their ranks.

        Ranks count levels upward for a positive query component, else downward.
        """
        starts, ranks = self.starts[d], np.arange(first, last)
        if not upward:
            first, last, ranks = self.levels - last, self.levels - first, ranks[::-1]
        sizes = np.diff(starts[first : last + 1])
        return self.order[d, starts[first] : starts[last]], np.repeat(ranks, sizes)

    def _possible(self, q: np.ndarray, own: np.ndarray, k: int, few: int) -> np.ndarray:
        """Rows that may be among the k best: a proof leaves out all others."""
        rows, width = self.values.shape
        weight = np.abs(q)
        slack = float((weight * (self.step - 1)).sum())
        # Upper bound of every segment, by rank: what it adds beyond the least.
        bound = weight[:, None] * ((np.arange(self.levels) + 1) * self.step - 1)
        sizes = np.diff(self.starts, axis=1)
        sizes = np.where((q >= 0)[:, None], sizes, sizes[:, ::-1])
        by_impact = np.argsort(-bound, axis=None, kind="stable")
        done = sizes.ravel()[by_impact].cumsum()
        lower = np.zeros(rows)
        reached = np.full(width, self.levels)
        every = np.arange(width)
        for share in ROUNDS:
            at = int(np.searchsorted(done, share * rows * width))
            at = min(at, len(by_impact) - 1)
            limit = float(bound.ravel()[by_impact[at]])
            # All segments of at least this bound are processed now.
            ranks = np.minimum(reached, (bound < limit).sum(axis=1))
            for d in np.flatnonzero(ranks < reached):
                rows_of, rank = self._slice(d, q[d] >= 0, int(ranks[d]), int(reached[d]))
                lower[rows_of] += rank * float(weight[d] * self.step)
            reached = ranks
            # A dimension adds at most the bound of its next segment, if one is left.
            rest = np.where(ranks > 0, bound[every, np.maximum(ranks - 1, 0)], 0).sum()
            rivals = np.where(own, -1.0, lower)
            kth = np.partition(rivals, rows - k)[rows - k] if k <= rows else -1.0
            possible = np.flatnonzero((lower + (slack + rest) >= kth) & ~own)
            if len(possible) <= few:
                break
        return possible

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores of the block, ties to smaller ids."""
        own = self.ids == query_id
        possible = self._possible(q, own, k, max(8 * k, len(self.ids) // 64))
        scores = self.values[possible].astype(np.int64) @ q
        best = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][best], scores[best]


def index_blocks(rows: DataFrame, blocks: int, levels: int) -> DataFrame:
    """The index: one row for each block and width, (block, width, ids, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            offsets = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy()
            widths = np.diff(offsets)
            for width in np.unique(widths):
                which = np.flatnonzero(widths == width)
                at = offsets[which][:, None] + np.arange(width)
                ids = batch.column(0).to_numpy()[which]
                parts.setdefault(int(width), []).append((ids, flat[at].astype(np.int32)))
        block = TaskContext.get().partitionId()
        for width, found in parts.items():
            ids = np.concatenate([x[0] for x in found]).astype(np.int64)
            values = np.concatenate([x[1] for x in found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block], pa.int32()),
                    pa.array([width], pa.int32()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([values.tobytes()], pa.binary()),
                ],
                names=["block", "width", "ids", "values"],
            )

    return rows.repartition(blocks).mapInArrow(
        run, "block int, width int, ids binary, values binary"
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    blocks: Blocks = Blocks(),
) -> DataFrame:
    """query_id, rank, vec_id and score: each query's k best vectors.

    Takes the id and the vector column of both tables. Score is the inner product
    of floored, scaled components; equal scores go by smaller vec_id. A vector
    with the query's own id is no candidate, nor is one of another width. Vectors
    that are null, empty, or hold a null, non-finite or scaled component beyond
    32 bits take no part. A row repeated among the vectors is listed as often; among
    the queries it is asked once. Fewer candidates give fewer rows, an empty table
    an empty result.

    Queries meet the index block by block. Both sides are dealt by (block, query
    group), so no task holds more than a block and a group of queries.
    """
    table = written(usable(vectors, id_column, vector_column, scale), "topk-vectors")
    asked = written(
        usable(queries, id_column, vector_column, scale)
        .withColumn("variant", F.xxhash64("v"))
        .dropDuplicates(["vec_id", "variant"]),
        "topk-queries",
    )
    n_blocks = max(1, -(-table.count() // blocks.vectors))
    n_groups = max(1, -(-asked.count() // blocks.queries))
    index = written(index_blocks(table, n_blocks, blocks.levels), "topk-index")
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    right = asked.withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "variant"), F.lit(n_groups)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def meet(block: pa.Table, group: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        ids, variants = group["vec_id"].to_pylist(), group["variant"].to_pylist()
        asked_for = [np.array(v, dtype=np.int64) for v in group["v"].to_pylist()]
        for width, own, values in zip(
            block["width"].to_pylist(), block["ids"].to_pylist(), block["values"].to_pylist(),
            strict=True,
        ):
            own = np.frombuffer(own, dtype=np.int64)
            rows = np.frombuffer(values, dtype=np.int32).reshape(len(own), width)
            part = Block(own, rows, blocks.levels)
            for query_id, variant, q in zip(ids, variants, asked_for, strict=True):
                if len(q) != width:
                    continue
                found, scores = part.search(query_id, q, k)
                out[0] += [query_id] * len(found)
                out[1] += [variant] * len(found)
                out[2] += found.tolist()
                out[3] += scores.tolist()
        return pa.table(
            [pa.array(x, pa.int64()) for x in out], names=["query_id", "variant", "vec_id", "score"]
        )

    found = (
        left.groupBy("block", "part")
        .cogroup(right.groupBy("block", "part"))
        .applyInArrow(meet, "query_id long, variant long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    # A rank limit is applied in every task before the shuffle.
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def is_query(id_column: str = "vec_id", every: int = 100) -> Column:
    """The stated query set: every row whose id is divisible."""
    return F.col(id_column) % every == 0
