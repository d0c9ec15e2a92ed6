"""Filling containers of fixed capacity by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SumOfSquares:
    """Places items one by one so that sum over gaps g of N(g)**2 becomes smallest, N(g) being the
    number of open containers with g left (full and new ones count in none)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)  # [0] and [capacity] stay 0
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, size: int) -> int:
        """The container (numbered from 0) that takes an item of 1 to capacity."""
        c, n = self.capacity, self.counts
        # an item moves a container from gap g to g - size: N(g) falls by one, N(g - size) rises by one
        change = 2 * (n[: c - size + 1] - n[size:]) + 2
        change[0] -= 2 * n[0] + 1  # filling up adds to no count
        change[:-1][n[size:c] == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * n[c - size] + 1 if size < c else 0  # a new container
        rest = int(change.argmin())  # the least; of equals the smallest gap that stays
        gap = rest + size
        if gap == c:
            box, self.made = self.made, self.made + 1
        else:
            box = self.open[gap].pop()
            n[gap] -= 1
        if 0 < rest < c:
            self.open[rest].append(box)
            n[rest] += 1
        return box


def packed(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Container of each size, and their number."""
    s = SumOfSquares(capacity)
    return np.fromiter((s.place(int(x)) for x in sizes), dtype=np.int64, count=len(sizes)), s.made


def pieces(df: DataFrame, id_col: str, size_col: str, capacity: int) -> DataFrame:
    """(id_col, piece, start, n): one row per item; one above the capacity is cut into full pieces and a rest.

    Null sizes and sizes below 0 count as 0; an item of size 0 keeps one piece.
    """
    n = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    last = F.greatest(F.ceil(n / capacity) - 1, F.lit(0)).cast("int")
    d = df.select(id_col, n.alias("_n"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * capacity
    return d.select(id_col, "piece", start.alias("start"), F.least(F.col("_n") - start, F.lit(capacity)).alias("n"))


def _pack(df: DataFrame, id_col: str, capacity: int, shares: int, level: int, full_enough: int) -> DataFrame:
    """One pass: pieces go to shares by hash; done tells whether the container is filled to full_enough."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)  # four numbers a piece, of a share of bounded size
        if not parts:
            return
        t = pd.concat(parts, ignore_index=True)
        for share, g in t.groupby("_share", sort=False):
            # large items first, the rest of equal sizes by id: a fixed order whatever the partitions
            g = g.sort_values(["n", id_col, "piece", "_row"], ascending=[False, True, True, True]) if level else g.sort_values(["_h", id_col, "piece"])
            some = g["n"].to_numpy() > 0
            box = np.zeros(len(g), dtype=np.int64)
            box[some], made = packed(g["n"].to_numpy()[some], capacity)
            fill = np.bincount(box, weights=g["n"].to_numpy(), minlength=max(made, 1))
            yield pd.DataFrame({id_col: g[id_col], "piece": g["piece"], "start": g["start"], "n": g["n"], "_row": g["_row"], "container": ((level << 22) + int(share)) * (1 << 40) + box, "done": fill[box] >= full_enough})

    # the row's own number keeps repeated rows of one id from meeting in one share
    h = F.xxhash64(F.col(id_col), F.col("piece"), F.col("_row"), F.lit(level))
    d = df.withColumn("_h", h).withColumn("_share", F.pmod("_h", F.lit(shares)))
    # a share is a partition: by hash some tasks would hold several shares and others none
    d = d.repartitionById(shares, F.col("_share").cast("int")).select(id_col, "piece", "start", "n", "_row", "_h", "_share")
    return d.mapInPandas(run, f"`{id_col}` {kind}, piece int, start bigint, n bigint, _row bigint, container bigint, done boolean")


def containers(df: DataFrame, id_col: str, size_col: str, capacity: int, cut, share_rows: int = 200_000) -> DataFrame:
    """(id_col, piece, start, n, container): every item in a container of capacity, ids unique over all.

    Items are dealt by hash into shares of about share_rows pieces, packed independently by sum of
    squares (time in proportion to pieces times capacity, vectorised over the gaps). Containers a
    share leaves underfull are emptied and packed again with those of other shares, large items
    first; what remains is the open containers of few shares. Ties: of equal outcomes the fullest
    container, latest opened first. Ids of repeated rows are pieces of their own; an empty table
    gives no rows; nulls: see pieces. cut computes a DataFrame once (see kinlink.session.cut).
    """
    p = cut(pieces(df, id_col, size_col, capacity).withColumn("_row", F.monotonically_increasing_id()))
    whole = p.where(F.col("n") == capacity)
    rest = p.where(F.col("n") < capacity)
    # a full piece is a container by itself and needs no packing
    alone = whole.select(id_col, "piece", "start", "n", (F.lit(-1) - F.monotonically_increasing_id()).alias("container"))
    shares = max(1, -(-rest.count() // share_rows))
    out, level = [], 0
    while True:
        t = cut(_pack(rest, id_col, capacity, shares, level, int(capacity * 0.99)))
        again = t.where(~F.col("done"))
        if level == 1 or shares >= (1 << 22):
            out.append(t)
            break
        out.append(t.where("done"))
        left = again.count()
        if not left:
            break
        rest, shares, level = again.select(id_col, "piece", "start", "n", "_row"), max(1, -(-left // share_rows)), 1
    for t in out:
        alone = alone.unionByName(t.select(id_col, "piece", "start", "n", "container"))
    return alone
