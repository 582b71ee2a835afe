"""Progress of a run, from its ledger alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip

EMPTY_ALARM = 0.5


def progress(ledger: DataFrame) -> DataFrame:
    """One row: completed (attempts), distinct_ids, failed, empty, empty_ratio, alarm."""
    empty = py_strip(F.coalesce("pred_text", F.lit(""))) == ""
    out = ledger.agg(F.count("*").alias("completed"), F.countDistinct("segment_id").alias("distinct_ids"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(empty).alias("empty"))
    ratio = F.col("empty") / F.greatest(F.lit(1), F.col("completed"))
    return out.withColumn("empty_ratio", ratio).withColumn("alarm", (F.col("completed") > 0) & (ratio > EMPTY_ALARM))
