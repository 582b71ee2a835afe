"""Segment ids: validity, shard, audio path, and ids from paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEM = r"^(?:.*/)?((?:\.+[^./]*|[^./][^/]*?))(?:\.[^./]+)?/*$"


class MalformedSegmentIdError(ValueError):
    """An id without the parts that its clip's path is made of."""


def path_of(own: str, root: str) -> str:
    """audio_path() of one id, for code that goes line by line."""
    first, second, *rest = [*own.split("-"), "", ""]
    if len(rest) < 3 or not first or not second:
        raise MalformedSegmentIdError(f"segment id {own!r} has no three parts, the first two not empty")
    return f"{root}/train/{first}/{second}/{own}.wav"


def is_valid_id(c: Column) -> Column:
    """At least three parts between dashes, the first two not empty."""
    return F.coalesce(c.rlike(r"^[^-]+-[^-]+-"), F.lit(False))


def shard_of(c: Column) -> Column:
    head = F.substring_index(c, "-", 1)
    return F.when(head == "", F.raise_error(F.concat(F.lit("no shard in segment id: "), c))).otherwise(head)


def audio_path(c: Column, root: Column | str) -> Column:
    part = F.split(c, "-")
    root = F.lit(root) if isinstance(root, str) else root
    return F.concat_ws("/", root, F.lit("train"), F.get(part, F.lit(0)), F.get(part, F.lit(1)), F.concat(c, F.lit(".wav")))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, STEM, 1)


def under_root(path: Column, root: str) -> Column:
    """Absolute paths and addresses with a scheme stay."""
    return F.when(path.rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:/)"), path).otherwise(F.concat_ws("/", F.lit(root), path))
