"""Length-bucketed batches under a cap of padded cost."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a stretch that is numbered by one window; stretches get their offsets from a running sum.
STRETCH = 1 << 16


def dense_position(df: DataFrame, order: str = "seq") -> DataFrame:
    """Adds `position`, 0, 1, .. in the order of `order` (a distinct non-negative long), without sorting all rows in one task."""
    part = F.expr(f"{order} div {STRETCH}")
    counts = df.groupBy(part.alias("_s")).agg(F.count("*").alias("_n"))
    before = F.expr("coalesce(sum(_n) over (order by _s rows between unbounded preceding and 1 preceding), 0)")
    placed = df.withColumn("_s", part).join(counts.select("_s", before.alias("_at")), "_s")
    nth = F.expr(f"row_number() over (partition by _s order by {order})")
    return placed.withColumn("position", F.col("_at") + nth - 1).drop("_s", "_at")


def greedy(durations: list[float], size: int, cap: float) -> list[int]:
    """Batch numbers of rising durations: a batch ends when full, or before its padded cost would exceed the cap."""
    out, number, held, longest = [], 0, 0, 0.0
    for d in durations:
        if held and max(longest, d) * (held + 1) > cap:
            number, held, longest = number + 1, 0, 0.0
        out.append(number)
        held, longest = held + 1, max(longest, d)
        if held >= size:
            number, held, longest = number + 1, 0, 0.0
    return out


def assign_batches(df: DataFrame, size: int = 16, buffer: int = 2048, cap: float = 480.0, order: str = "seq", duration: str = "duration") -> DataFrame:
    """Adds `win` (the arrival window of max(size, buffer) rows), `batch_no` in it and `slot` in the batch.

    Rows of a window are sorted by duration, ties in arrival order, and packed greedily.  A group is one
    window, so its size is bounded.
    """
    window = max(size, buffer)
    placed = dense_position(df, order).withColumn("win", F.expr(f"cast(position div {window} as bigint)"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([duration, "position"], kind="stable")
        rows["batch_no"] = greedy(rows[duration].tolist(), size, cap)
        rows["slot"] = rows.groupby("batch_no").cumcount()
        return rows

    schema = ", ".join([f"`{n}` {t}" for n, t in placed.dtypes] + ["batch_no bigint", "slot bigint"])
    return placed.groupBy("win").applyInPandas(run, schema).drop("position")


def batch_stats(batches: DataFrame, duration: str = "duration") -> DataFrame:
    """win, batch_no, n, longest, padded_cost."""
    out = batches.groupBy("win", "batch_no").agg(F.count("*").alias("n"), F.max(duration).alias("longest"))
    return out.withColumn("padded_cost", F.col("longest") * F.col("n"))
