"""Join and ranking building blocks shared by the operators.

Joins are plain equi joins: adaptive execution broadcasts a side that its
measured bytes allow and splits the partitions of hot keys, whatever the size
of the input. ``top_k`` keeps the first k rows per group; Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
k rows per map task. ``spread`` is scan set-up for the stand-in loader only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Hash-distribute rows by ``key`` when a *scan* yields fewer partitions
    than the cluster can run at once (e.g. one large row group holding many
    documents). On a large input with many splits this is a no-op, so no
    shuffle is added where the scan is already parallel. Apply it to a scan:
    on a plan with joins, counting partitions would run the plan's stages."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    keys = [key] if isinstance(key, str) else list(key)
    # partition on a hash *expression* of the key: rows spread evenly, but
    # the layout does not count as clustering on the key, so the usual
    # partial aggregate -> exchange -> final aggregate plan (whose exchange
    # later consumers reuse, and which splits a hot document's terms over
    # tasks) stays in place downstream
    return df.repartition(target, F.xxhash64(*keys))


def top_k(df: DataFrame, group_cols: list[str], order: list[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per group by ``order`` (which must be a total order
    within a group), with a 1-based ``rank_col`` (bigint)."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= k)
              .withColumn(rank_col, F.col(rank_col).cast("long")))
