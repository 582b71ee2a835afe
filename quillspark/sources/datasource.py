"""Named formats for spark.read and write: transcripts by byte ranges, predictions written by commit messages, headers of clips.

    register(spark)
    spark.read.format("transcripts").option("audio_root", "/audio").load("in.tsv")
    rows.write.format("predictions").option("format", "jsonl").mode("overwrite").save("out")
    spark.read.format("wav_headers").load("/audio")

Files are read in ranges of `range_bytes`.  A task takes neighbouring ranges, of one file or several: there are up to TASKS tasks, and
one for each RANGE_BYTES where these are more, so that neither small ranges nor many small files make tasks without end.  Filters on `shard` go down to the reader, which leaves other
lines before it makes rows of them.  More line formats come by register_lines(), in every worker by the option `parser`.
"""

from __future__ import annotations

import importlib
import itertools
import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from ..functions import ids
from ..operators.batching import dense_position
from . import audio, ranges

RECORDS = "seq bigint, segment_id string, text string, audio_filepath string, duration double, shard string, reject_reason string, value string"
HEADERS = f"path string, bytes bigint, {audio.PROBE}"
PREDICTIONS = ("segment_id", "pred_text", "audio_filepath", "duration")
#: Low bits of a line's number, which hold its place in its file; the bits above are the file's.
OFFSET_BITS = 44
RANGE_BYTES = 1 << 25
#: Tasks that the ranges of less than TASKS * RANGE_BYTES go to, at most.
TASKS = 64
GIVEN = 4096
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

#: A record or the reason of a reject: (segment_id, text, audio path, duration, reason) of a line and the audio root.
Parsed = tuple[str, str, str | None, float | None, str | None]
Parser = Callable[[str, str], Parsed]


def tsv_record(line: str, root: str) -> Parsed:
    head, tab, rest = line.partition("\t")
    own, path, reason = head.strip(BLANKS), None, None
    if not line.strip(BLANKS):
        reason = "blank"
    elif not tab:
        reason = "no_tab"
    elif not own:
        reason = "empty_id"
    else:
        try:
            path = ids.path_of(own, root)
        except ids.MalformedSegmentIdError:
            reason = "malformed_id"
    return own, rest, path, None, reason


def jsonl_record(line: str, root: str) -> Parsed:
    line = line.strip(BLANKS)
    if not line:
        return "", "", None, None, "blank"
    try:
        told = json.loads(line)
    except ValueError:
        told = None
    if not isinstance(told, dict):
        return "", "", None, None, "invalid_json"
    path, text, seconds = told.get("audio_filepath"), told.get("text"), told.get("duration")
    text = "" if text is None else text if isinstance(text, str) else json.dumps(text, ensure_ascii=False) if isinstance(text, (dict, list)) else str(text)
    seconds = float(seconds) if isinstance(seconds, (int, float)) and math.isfinite(seconds) else None
    if not isinstance(path, str) or not path:
        return "", text, None, seconds, "no_path"
    path = path if path.startswith("/") or ranges.SCHEME.match(path) else f"{root.rstrip('/')}/{path}"
    own = PurePosixPath(path).stem
    return own, text, path, seconds, "no_shard" if not own or own.startswith("-") else None


LINES: dict[str, Parser] = {"tsv": tsv_record, "jsonl": jsonl_record}


def register_lines(name: str, parse: Parser) -> None:
    """Let the format `transcripts` read other lines, option("format", name).  Workers that do not import the caller's module need option("parser",
    "module:function") instead.
    """
    LINES[name] = parse


def parser_of(options: dict, path: str) -> Parser:
    """By the option parser, the option format, or what the file's first line that is not blank looks like."""
    if options.get("parser"):
        module, _, name = options["parser"].partition(":")
        return getattr(importlib.import_module(module), name)
    kind = options.get("format")
    if kind is None:
        named = "jsonl" if path.lower().rstrip("/").endswith(".jsonl") else "tsv"
        first = next((t for p, n in ranges.listed(path) if n for _, v in ranges.lines(p, 0, n, 1 << 12) if (t := v.decode("utf-8", "replace").lstrip("﻿").strip(BLANKS))), None)
        kind = named if first is None else "jsonl" if first.startswith("{") else "tsv"
    if kind not in LINES:
        raise ValueError(f"unknown format {kind!r}")
    return LINES[kind]


@dataclass
class Ranges(InputPartition):
    """What a task reads: (number of the file, path, from, to)."""

    found: list[tuple[int, str, int, int]]


def dealt(found: list[tuple[int, str, int, int]]) -> list[Ranges]:
    """Ranges by tasks, in their order: those that begin in the same share of all bytes."""
    ends = [0, *itertools.accumulate(end - start for *_, start, end in found)]
    share = min(RANGE_BYTES, -(-ends[-1] // TASKS))
    told = itertools.groupby(zip(ends, found), lambda x: x[0] // share)
    return [Ranges([r for _, r in group]) for _, group in told]


class TranscriptReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.path, self.root = options["path"], options.get("audio_root", "")
        self.parse = parser_of(options, self.path)
        self.shards: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is not None and f.attribute == ("shard",):
                self.shards = wanted if self.shards is None else self.shards & wanted
            else:
                yield f

    def partitions(self) -> Sequence[Ranges]:
        found = ranges.listed(self.path)
        return dealt(ranges.split_ranges(found, int(self.options.get("range_bytes", RANGE_BYTES)))) or [Ranges([])]

    def read(self, part: Ranges) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        lines = ((number, at, raw) for number, path, start, end in part.found for at, raw in ranges.lines(path, start, end, min(ranges.BLOCK, end - start)))
        for number, at, raw in lines:
            value = raw.decode("utf-8", "replace")
            value = value.lstrip("﻿") if at == 0 else value
            own, text, path, seconds, reason = self.parse(value, self.root)
            shard = None if reason else own.partition("-")[0]
            if self.shards is not None and shard not in self.shards:
                continue
            rows.append((number << OFFSET_BITS | at, own, text, path, seconds, shard, reason, value))
            if len(rows) == GIVEN:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in RECORDS.split(", ")])


class TranscriptSource(DataSource):
    """Lines as records; those that are no records have a reject_reason.  seq rises in the order of files and lines, with gaps."""

    @classmethod
    def name(cls) -> str:
        return "transcripts"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> TranscriptReader:
        return TranscriptReader(dict(self.options))


class HeaderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.most = options["path"], int(options.get("clips_per_task", 2000))

    def partitions(self) -> Sequence[InputPartition]:
        found = ranges.listed(self.path, ".wav")
        return [InputPartition(found[i : i + self.most]) for i in range(0, len(found), self.most)] or [InputPartition([])]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        for path, size in part.value:
            yield path, size, *audio.probe_file(path)


class HeaderSource(DataSource):
    """The headers of all clips below a folder: of each a few bytes are read."""

    @classmethod
    def name(cls) -> str:
        return "wav_headers"

    def schema(self) -> str:
        return HEADERS

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    aside: str
    name: str
    rows: int


class PredictionWriter(DataSourceWriter):
    """Each task writes one file aside; the driver puts all in place when every task has told of its own, and none if one has failed."""

    def __init__(self, options: dict, names: list[str], overwrite: bool):
        self.path, self.kind, self.overwrite, self.job = options["path"], options.get("format", "tsv"), overwrite, uuid.uuid4().hex
        if self.kind not in WRITERS:
            raise ValueError(f"unknown format {self.kind!r}")
        missing = {"segment_id", "pred_text"} - set(names)
        if missing:
            raise ValueError(f"predictions need columns {sorted(missing)}")
        self.aside = f"{self.path.rstrip('/')}/_aside-{self.job}"

    def write(self, rows: Iterator) -> Written:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{self.job}.{self.kind}"
        system, folder = ranges.located(self.aside)
        where, count = f"{folder}/{task.taskAttemptId()}-{name}", 0
        system.create_dir(folder, recursive=True)
        try:
            with system.open_output_stream(where) as out:
                for row in rows:
                    out.write(WRITERS[self.kind](row.asDict()).encode() + b"\n")
                    count += 1
        except BaseException:
            system.delete_file(where)
            raise
        return Written(f"{task.taskAttemptId()}-{name}", name, count)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = ranges.located(self.path)
        old = [x.path for x in system.get_file_info(ranges.pafs.FileSelector(folder, allow_not_found=True)) if x.is_file] if self.overwrite else []
        for m in messages:
            if m is not None:
                system.move(f"{folder}/_aside-{self.job}/{m.aside}", f"{folder}/{m.name}")
        for path in old:
            system.delete_file(path)
        self.clear()

    def abort(self, messages: list[Written | None]) -> None:
        self.clear()

    def clear(self) -> None:
        system, folder = ranges.located(self.aside)
        if system.get_file_info(folder).type != ranges.pafs.FileType.NotFound:
            system.delete_dir(folder)


def tsv_prediction(row: dict) -> str:
    return "\t".join((row.get(c) or "").replace("\t", " ").replace("\n", " ") for c in ("segment_id", "pred_text"))


def jsonl_prediction(row: dict) -> str:
    told = {"audio_filepath": row.get("audio_filepath") or "", "text": row.get("pred_text") or ""}
    return json.dumps(told | ({"duration": row["duration"]} if row.get("duration") is not None else {}), ensure_ascii=False)


WRITERS: dict[str, Callable[[dict], str]] = {"tsv": tsv_prediction, "jsonl": jsonl_prediction}


class PredictionSource(DataSource):
    """Predictions as lines of text, tsv or jsonl by the option format: segment_id, pred_text, and for jsonl audio_filepath and duration."""

    @classmethod
    def name(cls) -> str:
        return "predictions"

    def writer(self, schema, overwrite: bool) -> PredictionWriter:
        return PredictionWriter(dict(self.options), schema.names, overwrite)


def register(spark: SparkSession) -> None:
    """Make the formats known to a session, and let filters go down to their readers."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (TranscriptSource, HeaderSource, PredictionSource):
        spark.dataSource.register(source)


def numbered(records: DataFrame) -> DataFrame:
    """Records of the format `transcripts`, all of them, with seq 0, 1, .. in their order."""
    return dense_position(records, "seq").drop("seq").withColumnRenamed("position", "seq")
