"""References side by side with predictions: last prediction wins, one row for each input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfkc


def last_wins(predictions: DataFrame, order: str | list[str] = "seq") -> DataFrame:
    """segment_id and the pred_text of its last row: one partial aggregate, no window."""
    order = [order] if isinstance(order, str) else order
    return predictions.groupBy("segment_id").agg(F.max_by("pred_text", F.struct(*order)).alias("pred_text"))


def matched(records: DataFrame, predictions: DataFrame, order: str | list[str] = "seq", merge: bool = False) -> DataFrame:
    """seq, segment_id, text, pred_text and `matched`; an empty prediction still matches.

    The join is left to the optimizer, which broadcasts a small side by its size; `merge` asks for sort-merge.
    """
    latest = last_wins(predictions, order).withColumn("_hit", F.lit(True))
    if merge:
        latest = latest.hint("merge")
    joined = records.select("seq", "segment_id", "text").join(latest, "segment_id", "left")
    return joined.select("seq", "segment_id", "text", "pred_text", F.coalesce("_hit", F.lit(False)).alias("matched"))


def combine(records: DataFrame, predictions: DataFrame, order: str | list[str] = "seq", merge: bool = False, normalize: bool = True) -> DataFrame:
    """seq, segment_id, orig_text, pred_text, both NFKC; a missing prediction is empty."""
    rows = matched(records, predictions, order, merge)
    shape = nfkc if normalize else lambda c: c
    return rows.select("seq", "segment_id", shape(F.col("text")).alias("orig_text"), shape(F.coalesce("pred_text", F.lit(""))).alias("pred_text"))


def extra(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Distinct predicted ids without an input row."""
    return predictions.select("segment_id").distinct().join(records, "segment_id", "left_anti")


def missing(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Input rows without a prediction, repeats kept."""
    return records.select("seq", "segment_id").join(predictions, "segment_id", "left_anti")


def stats_frame(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row of the four counts, summed from the rows of both joins."""
    none = F.lit(0).cast("long").alias
    rows = matched(records, predictions.withColumn("seq", F.lit(0))).select(F.col("matched").cast("long").alias("m"), (~F.col("matched")).cast("long").alias("miss"), none("extra"))
    both = rows.unionByName(extra(records, predictions).select(none("m"), none("miss"), F.lit(1).cast("long").alias("extra")))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return both.agg(total(F.col("m") + F.col("miss"), "total_input"), total("m", "matched"), total("miss", "missing_prediction"), total("extra", "extra_prediction"))
