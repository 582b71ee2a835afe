"""Transcript scans: headerless TSV and JSON-lines manifests, with rejected lines kept as data."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text

LOG = logging.getLogger(__name__)
FIELDS = "audio_filepath VARIANT, text VARIANT, duration VARIANT, _bad STRING"


def suffix_format(path: str) -> str:
    return "jsonl" if path.lower().endswith(".jsonl") else "tsv"


def sniff_format(spark: SparkSession, path: str) -> str | None:
    """By the first line that is not blank; None if there is none or it can't be read."""
    try:
        lines = spark.read.text(path).select(text.strip_bom(F.col("value")).alias("v"))
        row = lines.where(text.py_strip(F.col("v")) != "").limit(1).first()
    except Exception as e:  # an unreadable file has no format of its own
        LOG.warning("%s can't be read: %s", path, e)
        return None
    return None if row is None else "jsonl" if row["v"].startswith("{") else "tsv"


def detect_format(spark: SparkSession, path: str) -> str:
    named, seen = suffix_format(path), sniff_format(spark, path)
    if seen and seen != named:
        LOG.warning("%s holds %s whatever its suffix says", path, seen)
    return seen or named


def detect_formats(spark: SparkSession, folder: str, name: Column | None = None) -> DataFrame:
    """file, by_suffix, found (by the first line that is not blank, else by the suffix) of all files in a folder, in one pass.

    `name` takes the place of the file's path, as where a file is many parts in a folder of its name.
    """
    file = F.col("_metadata.file_path") if name is None else name
    raw = spark.read.option("recursiveFileLookup", "true").text(folder).select(file.alias("file"), "_metadata.file_block_start", "value", F.monotonically_increasing_id().alias("nth"))
    bare = text.py_strip(text.strip_bom(F.col("value")))
    first = F.min_by(F.when(bare != "", bare.startswith("{")), F.when(bare != "", F.struct("file_block_start", "nth")))
    named = F.when(F.lower("file").endswith(".jsonl"), "jsonl").otherwise("tsv")
    found = F.when(F.col("json").isNull(), F.col("by_suffix")).when(F.col("json"), "jsonl").otherwise("tsv")
    return raw.groupBy("file").agg(first.alias("json")).withColumn("by_suffix", named).select("file", "by_suffix", found.alias("found"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """seq (dense, in the order of files and lines), value; byte-order marks in front of a file removed.

    Splits of a file are read whole by one task each, so a line's number is its split's offset, a
    running sum over the small table of splits, and its place in the split.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    raw = raw.withColumn("_m", F.monotonically_increasing_id())
    splits = raw.groupBy("_f", "_b").agg(F.min("_m").alias("_low"), F.count("*").alias("_n"))
    before = F.expr("coalesce(sum(_n) over (order by _f, _b rows between unbounded preceding and 1 preceding), 0)")
    placed = raw.join(splits.select("_f", "_b", "_low", before.alias("_at")), ["_f", "_b"])
    first = (F.col("_b") == 0) & (F.col("_m") == F.col("_low"))
    return placed.select((F.col("_at") + F.col("_m") - F.col("_low")).alias("seq"), F.when(first, text.strip_bom(F.col("value"))).otherwise(F.col("value")).alias("value"))


def parse_tsv(lines: DataFrame, audio_root: str | Column) -> DataFrame:
    """seq, segment_id, text, audio_filepath, duration, reject_reason of lines (seq, value)."""
    head, rest = text.first_tab(F.col("value"))
    own = text.py_strip(head)
    reason = (
        F.when(text.py_strip(F.col("value")) == "", "blank")
        .when(~F.col("value").contains("\t"), "no_tab")
        .when(own == "", "empty_id")
        .when(~ids.is_valid_id(own), "malformed_id")
    )
    return lines.select("seq", own.alias("segment_id"), rest.alias("text"), ids.audio_path(own, audio_root).alias("audio_filepath"), F.lit(None).cast("double").alias("duration"), reason.alias("reject_reason"), "value")


def as_text(v: Column) -> Column:
    """A dynamic value as the text of a record: absent and null are empty, true and false as True and False."""
    kind = F.schema_of_variant(v)
    return F.when(v.isNull() | (kind == "VOID"), "").when(kind == "BOOLEAN", F.initcap(v.cast("string"))).otherwise(v.cast("string"))


def parse_jsonl(lines: DataFrame, audio_root: str) -> DataFrame:
    bare = text.py_strip(F.col("value"))
    doc = F.from_json(bare, FIELDS, {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    rows = lines.select("seq", "value", bare.alias("_v"), doc.alias("_d"))
    path = F.col("_d.audio_filepath")
    kind = F.schema_of_variant(path)
    named = F.when(kind == "STRING", F.try_variant_get(path, "$", "string"))
    duration = F.when(F.schema_of_variant("_d.duration").rlike("^(BIGINT|DOUBLE|DECIMAL|BOOLEAN|TINYINT|SMALLINT|INT|FLOAT)"), F.expr("try_variant_get(_d.duration, '$', 'double')"))
    full = ids.under_root(named, audio_root)
    own = ids.stem(full)
    reason = (
        F.when(F.col("_v") == "", "blank")
        .when(F.col("_d._bad").isNotNull() | F.col("_d").isNull() | ~F.col("_v").startswith("{"), "invalid_json")
        .when(F.coalesce(named, F.lit("")) == "", "no_path")
        .when(own.startswith("-") | (own == ""), "no_shard")
    )
    return rows.select("seq", own.alias("segment_id"), as_text(F.col("_d.text")).alias("text"), full.alias("audio_filepath"), duration.alias("duration"), reason.alias("reject_reason"), "value")


#: Parsers by format: lines (seq, value) and the audio root to parsed rows with reject_reason.
PARSERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {"tsv": parse_tsv, "jsonl": parse_jsonl}


def register_format(name: str, parse: Callable[[DataFrame, str], DataFrame]) -> None:
    """Let read_transcripts() read another line format; parse gives the columns of parse_tsv()."""
    PARSERS[name] = parse


def read_transcripts(spark: SparkSession, path: str, audio_root: str, fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records (seq, segment_id, text, audio_filepath, duration) and rejects (seq, reject_reason, value)."""
    fmt = fmt or detect_format(spark, path)
    if fmt not in PARSERS:
        raise ValueError(f"unknown format {fmt!r}")
    parsed = PARSERS[fmt](read_lines(spark, path), audio_root)
    return parsed.where("reject_reason is null").drop("reject_reason", "value"), parsed.where("reject_reason is not null").select("seq", "reject_reason", "value")
