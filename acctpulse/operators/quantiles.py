"""Exact continuous quantile per group without gathering a group in one task.

``percentile``/``median`` merge every distinct value of a group in a single
reducer.  A peer group may hold a third of all accounts, so here the group is
split by a global range sort instead:

1. count rows per (group, value) - a pre-aggregated shuffle;
2. range-partition those counts by (group, value) so a large group spans many
   partitions, tag each row with its partition id and cut lineage, which pins
   the sampled range bounds for both uses below;
3. per (group, partition) totals -> offset of each partition inside its group
   (a window over at most one row per partition and group);
4. per partition a running count -> every distinct value's rank interval;
5. keep the one or two values whose interval holds floor/ceil of (n-1)*q and
   interpolate between them exactly as ``percentile`` does.

The number of ranges follows a proven bound on the input rows (one per
account for the peer median): about ``ROWS_PER_RANGE`` rows each.  When one
range suffices, no task can hold more than that many rows anyway, so the
range sort and the pinning write are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


ROWS_PER_RANGE = 50_000


def range_partitions(spark, row_bound: int | None, rows_per_range: int | None = None) -> int:
    """Ranges for ``row_bound`` distinct (group, value) rows: about
    ``rows_per_range`` (default ``ROWS_PER_RANGE``) each, at most
    ``spark.sql.shuffle.partitions``."""
    rows_per_range = rows_per_range or ROWS_PER_RANGE
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if row_bound is None:
        return most
    return max(1, min(most, -(-row_bound // rows_per_range)))


def exact_quantile(df: DataFrame, group_cols, value_col: str, q: float = 0.5,
                   out: str = "quantile", num_partitions: int | None = None,
                   row_bound: int | None = None) -> DataFrame:
    """``row_bound``: a proven upper bound on the rows of ``df`` (sizes the ranges)."""
    g = list(group_cols)
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = range_partitions(spark, row_bound)
    # NULL values stay as a zero-count row, so a group of only NULLs still gets its (NULL) quantile
    counts = df.groupBy(*g, value_col).agg(F.count(F.col(value_col)).alias("_cnt"))
    if num_partitions == 1:
        # every row fits one range (at most ROWS_PER_RANGE): nothing to pin
        ranged = counts.withColumn("_part", F.lit(0))
    else:
        ranged = cut_lineage(
            counts.repartitionByRange(num_partitions, *g, value_col).withColumn("_part", F.spark_partition_id()),
            "quantile_ranges")

    gk = [f"_g{i}" for i in range(len(g))]
    blocks = ranged.groupBy(*g, "_part").agg(F.sum("_cnt").alias("_bcnt"))
    in_group = Window.partitionBy(*g)
    before = in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *[F.col(c).alias(k) for c, k in zip(g, gk)], "_part",
        F.coalesce(F.sum("_bcnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_bcnt").over(in_group).alias("_n"),
    )
    running = Window.partitionBy("_part", *g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, 0)
    ranks = ranged.withColumn("_end", F.sum("_cnt").over(running))
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(g, gk)] + [ranks["_part"] == blocks["_part"]]
    pos = (F.col("_n") - 1).cast("double") * F.lit(float(q))
    located = (
        ranks.join(blocks, cond)
        .select(*g, value_col,
                (F.col("_offset") + F.col("_end")).alias("_hi_rank"),
                (F.col("_offset") + F.col("_end") - F.col("_cnt")).alias("_lo_rank"),
                pos.alias("_pos"))
        .withColumn("_k_lo", F.floor("_pos"))
        .withColumn("_k_hi", F.ceil("_pos"))
    )
    holds = lambda k: (F.col("_lo_rank") <= F.col(k)) & (F.col(k) < F.col("_hi_rank"))
    picked = (
        located.groupBy(*g)   # conditional maxima: map-side combined, one row per group
        .agg(
            F.max(F.when(holds("_k_lo"), F.col(value_col))).alias("_lo"),
            F.max(F.when(holds("_k_hi"), F.col(value_col))).alias("_hi"),
            F.max("_pos").alias("_pos"),
            F.max("_k_lo").alias("_k_lo"),
            F.max("_k_hi").alias("_k_hi"),
        )
    )
    # the same interpolation, term for term, as Spark's percentile / percentile_cont
    value = (F.when((F.col("_k_lo") == F.col("_k_hi")) | (F.col("_lo") == F.col("_hi")), F.col("_lo").cast("double"))
             .otherwise((F.col("_k_hi") - F.col("_pos")) * F.col("_lo")
                        + (F.col("_pos") - F.col("_k_lo")) * F.col("_hi")))
    return picked.select(*g, value.alias(out))
