"""Text exports: predictions, combined files, missing ids, the error journal; and repair of cut files."""

from __future__ import annotations

import mmap
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

COMBINED = ("segment_id", "orig_text", "pred_text")


def predicted_name(path: str) -> str:
    return f"predicted-{os.path.basename(path)}"


def combined_name(path: str) -> str:
    return f"combined-{os.path.basename(path)}"


def named_after(path: Column, prefix: str) -> Column:
    """predicted_name() and combined_name() of paths in a column."""
    return F.concat(F.lit(prefix + "-"), F.substring_index(path, "/", -1))


def tsv_line(*columns: Column) -> Column:
    """Never quoted: tabs and line ends in the values are spaces."""
    return F.concat_ws("\t", *[text.neutralize(F.coalesce(c, F.lit(""))) for c in columns])


def prediction_lines(df: DataFrame, fmt: str) -> DataFrame:
    """seq, line of predictions (seq, segment_id, pred_text, audio_filepath, duration)."""
    if fmt == "tsv":
        line = tsv_line(F.col("segment_id"), F.col("pred_text"))
    else:
        line = F.to_json(F.struct(F.coalesce("audio_filepath", F.lit("")).alias("audio_filepath"), F.col("pred_text").alias("text"), "duration"))
    return df.select("seq", line.alias("value"))


def combined_lines(df: DataFrame, fmt: str) -> DataFrame:
    """seq, line of a combined table; TSV has a header, numbered -1."""
    if fmt == "jsonl":
        return df.select("seq", F.to_json(F.struct(*COMBINED)).alias("value"))
    header = df.sparkSession.range(1).select(F.lit(-1).cast("long").alias("seq"), F.lit("\t".join(COMBINED)).alias("value"))
    return header.unionByName(df.select("seq", tsv_line(*map(F.col, COMBINED)).alias("value")))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder of text parts whose concatenation in name order is the file."""
    lines.orderBy("seq").select("value").write.mode(mode).text(path)


def write_missing(missing: DataFrame, path: str) -> bool:
    """Ids without a prediction in input order; nothing is written if there are none."""
    if missing.limit(1).count() == 0:
        return False
    write_lines(missing.select("seq", F.col("segment_id").alias("value")), path)
    return True


def write_journal(failures: DataFrame, path: str) -> None:
    """ts (Bangkok), segment_id, audio_path, reason of failed clips, appended as JSON lines."""
    failures.select(text.bangkok(F.current_timestamp()).alias("ts"), "segment_id", F.col("audio_filepath").alias("audio_path"), F.col("error").alias("reason")).write.mode("append").json(path)


def drop_cut_tail(path: str) -> int:
    """Cut a local text file behind its last line end, in place; the bytes that went (0 without a file)."""
    if not os.path.exists(path) or not os.path.getsize(path):
        return 0
    with open(path, "r+b") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as view:
        keep, size = view.rfind(b"\n") + 1, len(view)
    if keep < size:
        os.truncate(path, keep)
    return size - keep
