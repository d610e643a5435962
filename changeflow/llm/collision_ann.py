"""Approximate nearest neighbours by collision counting over single projections.

Every vector is projected on a fixed set of random lines, and each line keeps its projections sorted. A query opens a
window around its own projection on every line and widens all of them step by step (virtual rehashing: nothing is hashed
again, the windows just take in their next neighbours). A vector that lies in the windows of enough lines is verified,
that is compared with the query exactly. A vector within distance R of the query shares a line's window of R times the
base width with a known probability, so the threshold can be set to let nearly all of them through; the search ends when
the last of the wanted neighbours is no further away than R. Distances are those of the vectors scaled to length one,
which order as the cosines do.

Vectors are dealt into blocks of bounded size, queries into batches; each pair of a block and a batch is one task with
its own sorted lines, and the best of all blocks are merged. Every vector is in the index, and nothing caps candidates.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

NEIGHBOURS = 5
LINES = 64
#: Half the width of a window at radius one; at distance R a window of R times this width is shared with probability 0.64.
HALF_WIDTH = 0.92
#: Collisions that make a candidate. Of 64 lines 41 are expected at distance R, with a deviation of 3.8.
THRESHOLD = 36
FIRST_RADIUS, GROWTH, STEPS = 0.3, 1.15, 12
BLOCK_ROWS = 16_384
QUERY_BATCH = 20_000
SEED = 20


def usable(vector: Column) -> Column:
    """Not NULL, not empty, all components finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Block:
    """The sorted lines of one block of vectors."""

    def __init__(self, rows: np.ndarray, lines: int = LINES, seed: int = SEED):
        self.rows = rows
        self.norms = np.sqrt((rows * rows).sum(axis=1))
        self.units = rows / self.norms[:, None]
        self.axes = np.random.default_rng(seed).standard_normal((lines, rows.shape[1]))
        places = self.axes @ self.units.T
        self.order = np.argsort(places, axis=1, kind="stable")
        self.places = np.take_along_axis(places, self.order, axis=1)

    def cosines(self, which: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        """Summed row by row in one order, so that equal vectors get equal results wherever they stand."""
        return (self.rows[which] * query).sum(axis=1) / (self.norms[which] * norm)

    def search(self, query: np.ndarray, own: int, ids: np.ndarray, wanted: int, threshold: int, half_width: float = HALF_WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``wanted`` nearest, ties by id; ``own`` (or -1) is left out."""
        count = len(self.rows)
        norm = float(np.sqrt((query * query).sum()))
        at = self.axes @ (query / norm)
        hits = np.zeros(count, dtype=np.int64)
        open_ = np.ones(count, dtype=bool)
        if own >= 0:
            open_[own] = False
        rows, scores = np.empty(0, dtype=np.int64), np.empty(0)
        lines, low, high = range(len(at)), None, None
        first = FIRST_RADIUS
        while True:
            # where the windows of the next radii begin and end, looked up for all of them at once
            radii = first * GROWTH ** np.arange(STEPS)
            begins = [np.searchsorted(self.places[k], at[k] - half_width * radii).tolist() for k in lines]
            ends = [np.searchsorted(self.places[k], at[k] + half_width * radii, side="right").tolist() for k in lines]
            for step, radius in enumerate(radii.tolist()):
                old_low, old_high = low, high
                low, high = [x[step] for x in begins], [x[step] for x in ends]
                if old_low is None:
                    taken = [self.order[k, low[k] : high[k]] for k in lines]
                else:
                    taken = [self.order[k, low[k] : old_low[k]] for k in lines if low[k] < old_low[k]]
                    taken += [self.order[k, old_high[k] : high[k]] for k in lines if old_high[k] < high[k]]
                if taken:
                    hits += np.bincount(np.concatenate(taken), minlength=count)
                new = np.flatnonzero(open_ & (hits >= threshold))
                if len(new):
                    open_[new] = False
                    if len(new) > wanted:
                        # all are compared; those that rounding alone could not bring among the wanted ones go at once
                        near = self.units[new] @ (query / norm)
                        least = np.partition(near, -wanted)[-wanted]
                        if len(rows) == wanted:
                            least = max(least, scores[-1])
                        new = new[near >= least - 1e-9]
                    rows = np.concatenate([rows, new])
                    scores = np.concatenate([scores, self.cosines(new, query, norm)])
                    best = np.lexsort((ids[rows], -scores))[:wanted]
                    rows, scores = rows[best], scores[best]
                if not open_.any() or len(rows) == wanted and 2 - 2 * scores[-1] <= radius * radius:
                    return rows, scores
            first = radii[-1] * GROWTH


def search(
    vectors: DataFrame,
    is_query: Column | str,
    id_column: str = "vec_id",
    vector: str = "embedding",
    wanted: int = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS,
    query_batch: int = QUERY_BATCH,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its ``wanted`` nearest other rows by cosine, nearest first.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do those without id, and
    only vectors of equal length are compared. Repeated rows are candidates of each other; a row is not its own. Equal
    scores are ordered by id. With fewer candidates all are given.
    """
    spark = vectors.sparkSession
    asked = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(F.expr(is_query) if isinstance(is_query, str) else is_query, F.lit(False)).alias("asks"))
    fine = asked.filter(usable(F.col("v")) & F.col("id").isNotNull())
    rows = stored(fine.select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")), "vectors")
    sizes = rows.agg(F.count("*").alias("all"), F.count_if("asks").alias("asks")).first()
    blocks, batches = max(1, -(-sizes["all"] // block_rows)), max(1, -(-sizes["asks"] // query_batch))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    # renamed onto themselves: two sides with the same columns of one table would be taken for each other
    held = rows.select("id", "v", "dim", "row", dealt(blocks).alias("block"), every(batches).alias("batch")).toDF("id", "v", "dim", "row", "block", "batch")
    asking = rows.filter("asks").select("id", "v", "dim", "row", dealt(batches).alias("batch"), every(blocks).alias("block"))

    def find(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            held = held.sort_values("row", kind="stable")
            ids, numbers = held["id"].to_numpy(), held["row"].to_numpy()
            block = Block(np.stack(held["v"].to_numpy()).astype(np.float64))
            places = np.searchsorted(numbers, queries["row"].to_numpy())
            for query_id, v, row, at in zip(queries["id"], queries["v"], queries["row"], places, strict=True):
                own = int(at) if at < len(numbers) and numbers[at] == row else -1
                found, scores = block.search(np.asarray(v, dtype=np.float64), own, ids, wanted, threshold)
                out += [(query_id, row, ids[r], s) for r, s in zip(found, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "query_row", "vec_id", "score"])

    ship(spark)
    key = ["dim", "block", "batch"]
    found = asking.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(find, "query_id long, query_row long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
    return ranked.select("query_id", "rank", "vec_id", "score")
