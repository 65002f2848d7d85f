"""Peer benchmarks (D12): exact median of submissions per active user by
division and segment.  Accounts without any event history take no part;
accounts whose recent rate is 0 do (inner join in ``activity_rate``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantile

MEDIAN_COL = "median_submissions_per_mau"


def segment_benchmarks(rate: DataFrame, group_cols=("division", "segment"), method: str = "split",
                       row_bound: int | None = None) -> DataFrame:
    """``method='split'`` ranks values across many tasks (see ``quantiles``);
    ``'percentile'`` is Spark's single-reducer exact ``percentile`` per group.
    ``row_bound`` bounds the rows of ``rate`` (one per account)."""
    if method == "percentile":
        return rate.groupBy(*group_cols).agg(
            F.percentile(F.col("recent_submissions_per_mau"), F.lit(0.5)).alias(MEDIAN_COL))
    return exact_quantile(rate, group_cols, "recent_submissions_per_mau", 0.5, out=MEDIAN_COL, row_bound=row_bound)
