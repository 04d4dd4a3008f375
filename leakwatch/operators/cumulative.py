"""Distributed running totals along a global sort order.

A window with ``orderBy`` but no ``partitionBy`` runs on a single task. For
curves over model scores the order is global (all scores of one model), so
the running totals are built in three steps that keep every task bounded:

1. ``repartitionByRange`` on (group, order) splits the rows into contiguous,
   sampled, balanced ranges; the result is checkpointed so the partition
   index is stable (recomputation after a lost executor gives the same
   ranges) and can be read with ``spark_partition_id()``.
2. A window per (group, range) computes the running sum inside the range.
3. A tiny table of per-(group, range) totals (one row per range) gives each
   range its offset; it is bounded by the number of ranges and broadcast.

The input should already be aggregated to one row per distinct order value
(partial aggregation), so a repeated score can never make a hot range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Target rows per range; the number of ranges grows with the input.
ROWS_PER_RANGE = 1_000_000
MAX_BROADCAST_ROWS = 100_000


def running_totals(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    value_cols: list[str],
    descending: bool = True,
    prefix: str = "cum_",
    rows_per_range: int = ROWS_PER_RANGE,
    materialized: bool = False,
) -> DataFrame:
    """Add ``{prefix}{v}``: the sum of ``v`` over rows of the same group whose
    ``order_col`` comes at or before this row's in the given direction.

    ``df`` must hold at most one row per (group, order value). Pass
    ``materialized=True`` when it is already a checkpoint.
    """
    base = df if materialized else df.checkpoint(eager=True)
    n = base.count()
    n_ranges = max(1, math.ceil(n / rows_per_range))
    ordered = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if n_ranges == 1:
        # Proven small (at most rows_per_range rows in all): one window per group.
        w = Window.partitionBy(*group_cols).orderBy(ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return base.withColumns({f"{prefix}{v}": F.sum(v).over(w) for v in value_cols})
    ranged = base.repartitionByRange(n_ranges, *group_cols, order_col).checkpoint(eager=True)
    ranged = ranged.withColumn("_rt_pid", F.spark_partition_id())

    w_in = (
        Window.partitionBy(*group_cols, "_rt_pid")
        .orderBy(ordered)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = ranged.withColumns({f"_rt_in_{v}": F.sum(v).over(w_in) for v in value_cols})

    totals = ranged.groupBy(*group_cols, "_rt_pid").agg(*[F.sum(v).alias(f"_rt_t_{v}") for v in value_cols])
    # Ranges are ascending in (group, order): for a descending running sum the
    # earlier rows live in higher range ids, otherwise in lower ones.
    pid_order = F.col("_rt_pid").desc() if descending else F.col("_rt_pid").asc()
    w_off = Window.partitionBy(*group_cols).orderBy(pid_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group_cols,
        "_rt_pid",
        *[F.coalesce(F.sum(f"_rt_t_{v}").over(w_off), F.lit(0)).alias(f"_rt_o_{v}") for v in value_cols],
    )
    # One row per (group, range). Broadcast only after proving the bound.
    small = offsets.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    out = inner.join(F.broadcast(offsets) if small else offsets, [*group_cols, "_rt_pid"])
    out = out.withColumns({f"{prefix}{v}": F.col(f"_rt_in_{v}") + F.col(f"_rt_o_{v}") for v in value_cols})
    drop = ["_rt_pid"] + [f"_rt_in_{v}" for v in value_cols] + [f"_rt_o_{v}" for v in value_cols]
    return out.drop(*drop)
