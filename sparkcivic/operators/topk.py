"""Top-k rows per group with an explicit tie rule."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {
    "dense": F.dense_rank,   # ties share a rank, no gaps: may return more than k rows
    "rank": F.rank,          # ties share a rank, gaps after ties
    "row": F.row_number,     # exactly k rows; ``tiebreak`` makes the order total
}


def topk_per_group(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int,
                   ties: str = "dense", tiebreak: Sequence[str] = (),
                   descending: bool = True, rank_col: str = "rank") -> DataFrame:
    """Rows whose rank within their group is at most ``k``.

    The ``rank <= k`` filter over a ranking window is planned by Spark as a
    partial ``WindowGroupLimit`` before the shuffle and a final one after it,
    so a group never ships more than its own top-k rows across the network.
    """
    if ties not in _RANKERS:
        raise ValueError(f"ties must be one of {sorted(_RANKERS)}")
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    order = [key] + [F.col(t).asc() for t in tiebreak]
    w = Window.partitionBy(*[F.col(g) for g in group_cols]).orderBy(*order)
    return df.withColumn(rank_col, _RANKERS[ties]().over(w)).filter(F.col(rank_col) <= k)
