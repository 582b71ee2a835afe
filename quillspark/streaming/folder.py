"""Files that arrive in a folder are parsed and appended to a table once each.

What has been seen is state of the query, keyed by id and kept beside its checkpoint; the table is never read again.  The table is
one of operators.commits: each micro-batch is a chunk named by query and epoch, so one that is given again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.commits import CommitLog
from ..sources import transcripts

#: Keeps the state on executors' disks, with changes alone sent to the checkpoint: it may outgrow their memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECORD = "segment_id string, text string, audio_filepath string, duration double, arrival long"


def read_stream(spark: SparkSession, folder: str, audio_root: str, fmt: str = "tsv", files_per_trigger: int | None = None) -> DataFrame:
    """Parsed lines with reject_reason.  A stream has no line numbers: seq is null."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(folder).select(F.lit(None).cast("long").alias("seq"), "value")
    return transcripts.PARSERS[fmt](lines, audio_root)


def records_of(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").select("segment_id", "text", "audio_filepath", "duration")


def first_of_each(parsed: DataFrame, forget_after: str | None = None) -> DataFrame:
    """The records whose id has not come before, in this micro-batch or an earlier one; of repeats in one micro-batch any one.

    With `forget_after` ("30 days") an id's state goes so long after its first arrival, and a later repeat counts as new.
    """
    records = records_of(parsed)
    if forget_after is None:
        return records.dropDuplicates(["segment_id"])
    return records.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", forget_after).dropDuplicatesWithinWatermark(["segment_id"]).drop("arrived")


class LastOfEach(StatefulProcessor):
    """Tells an id's record when it differs from the one told before: the last of a micro-batch, by text for want of an order in it."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.told = handle.getValueState("told", "text string, arrival long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = max(rows, key=lambda r: (r["text"] or "", r["audio_filepath"] or "", r["duration"] or 0.0))
        before = self.told.get() if self.told.exists() else None
        if before is None or before[0] != best["text"]:
            nth = 0 if before is None else before[1] + 1
            self.told.update((best["text"], nth))
            yield Row(segment_id=key[0], text=best["text"], audio_filepath=best["audio_filepath"], duration=best["duration"], arrival=nth)

    def close(self) -> None:
        pass


def last_of_each(parsed: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Records with `arrival`, told when an id's text is new or has changed; the greatest arrival of an id is its last text.

    With `ttl_ms` an id's state goes so many milliseconds after its last change.
    """
    out = records_of(parsed).groupBy("segment_id")
    return out.transformWithState(LastOfEach(ttl_ms), RECORD, "Update", "ProcessingTime" if ttl_ms else "None")


def start(parsed: DataFrame, checkpoint: str, process: Callable[[DataFrame, int], None], once: bool = True, mode: str = "append") -> StreamingQuery:
    """Run process(records, epoch) on each micro-batch; a batch is given again after a failure, with its epoch."""
    parsed.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = parsed.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(process)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def append_to(table: str) -> Callable[[DataFrame, int], None]:
    """A process that enters each micro-batch into the table's log, once, by the id of its query (which its checkpoint keeps) and its epoch."""

    def process(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        log, chunk = CommitLog(spark, table), f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}:{epoch}"
        if chunk not in log.state().told:
            log.add(log.stage(batch, chunk))

    return process


def read_table(spark: SparkSession, table: str, schema: str = RECORD) -> DataFrame:
    """What the log of an appended table counts."""
    log = CommitLog(spark, table)
    paths = log.paths(list(log.state().live.values()))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
