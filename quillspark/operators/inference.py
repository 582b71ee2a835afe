"""Batch inference with failure isolation; outcomes are data, aborts are decided from them."""

from __future__ import annotations

import os
import tempfile
import threading
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark import Accumulator, InheritableThread, TaskContext
from pyspark.accumulators import AccumulatorParam
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import error_signature, nfkc
from ..sources import audio

OUTCOME = "seq bigint, segment_id string, win bigint, batch_no bigint, pred_text string, status string, error string, audio_filepath string, duration double"


class Model(Protocol):
    def transcribe_batch(self, paths: list[str]) -> list[str]: ...


#: Builds a model; called once in each Python worker, from the options given.
ModelFactory = Callable[[dict], Model]


class ModelLoadError(Exception):
    """The model can't be built."""


#: Names of number types that models may be loaded in.
DTYPES = ("bfloat16", "float16", "float32")


def dtype_of(name: str) -> str:
    if name not in DTYPES:
        raise ModelLoadError(f"no number type {name!r}; there are {', '.join(DTYPES)}")
    return name


class DeadContextError(Exception):
    """Too many batches in a row failed as a whole."""


class SystematicFailureError(Exception):
    """Two batches in a row failed on every clip with one error."""


class EchoModel:
    """A stand-in for tests: `pred:<stem>`, an error for stems that hold `boom`."""

    def __init__(self, options: dict):
        self.options = options

    def transcribe_batch(self, paths: list[str]) -> list[str]:
        for p in paths:
            if "boom" in os.path.basename(p):
                raise RuntimeError(f"poisoned clip {p}")
        return [f"pred:{os.path.splitext(os.path.basename(p))[0]}" for p in paths]


_MODELS: dict = {}


def loaded(factory: ModelFactory, options: dict) -> Model:
    key = (getattr(factory, "__module__", ""), getattr(factory, "__qualname__", repr(factory)), repr(sorted(options.items())))
    if key not in _MODELS:
        try:
            _MODELS[key] = factory(options)
        except Exception as e:
            raise ModelLoadError(str(e)) from e
    return _MODELS[key]


def out_of_memory(e: Exception) -> bool:
    return "out of memory" in str(e).lower() or "OutOfMemory" in type(e).__name__


def isolate(model: Model, paths: list[str]) -> list[tuple[str, str | None]]:
    """(text, error) of each clip: the whole batch at once, and clip by clip if that fails."""

    def call(some: list[str]) -> list[str]:
        texts = model.transcribe_batch(some)
        if len(texts) != len(some):
            raise RuntimeError(f"{len(texts)} texts for {len(some)} clips")
        return [str(t).strip() for t in texts]

    if not paths:
        return []
    try:
        return [(t, None) for t in call(paths)]
    except Exception as whole:
        if out_of_memory(whole) and hasattr(model, "free_memory"):
            model.free_memory()
        if len(paths) == 1:
            return [("", str(whole))]
    out: list[tuple[str, str | None]] = []
    for p in paths:
        try:
            out.append((call([p])[0], None))
        except Exception as e:
            out.append(("", str(e)))
    return out


def prepared(path: str, action: str, shape: audio.Shape, folder: str) -> tuple[str, str | None]:
    """Path and error of a clip as the model can read it; one that is to be converted is written to the folder."""
    try:
        return (path if action == "pass" else audio.convert(path, folder, shape)), None
    except audio.AudioError as e:
        return path, str(e)


def ready_batches(parts: Iterator[pd.DataFrame], path_col: str, shape: audio.Shape | None, workers: int) -> Iterator[tuple[pd.DataFrame, list[tuple[str, str | None]]]]:
    """Each batch with prepared() of its clips, in order.

    `workers` threads make the clips of the next batch ready while the model has the one before; converted clips of two batches at
    most lie in folders of the task, each gone when its batch is done.
    """
    if shape is None:
        for part in parts:
            yield part, [(p, None) for p in part[path_col]]
        return
    with ThreadPoolExecutor(max(1, workers)) as pool:
        waiting: deque = deque()

        def begin() -> None:
            part = next(parts, None)
            if part is not None:
                folder = tempfile.TemporaryDirectory()  # read by this task alone
                clips = enumerate(zip(part[path_col], part["action"]))
                waiting.append((part, folder, [pool.submit(prepared, p, action, shape, os.path.join(folder.name, str(k))) for k, (p, action) in clips]))

        begin()
        while waiting:
            part, folder, clips = waiting.popleft()
            begin()
            with folder:
                yield part, [c.result() for c in clips]


class Alarm(AccumulatorParam):
    """What tasks tell the driver before their job ends: (window, error) of windows after which a run must stop."""

    def zero(self, value: list) -> list:
        return []

    def addInPlace(self, a: list, b: list) -> list:
        return a + b


class Watch:
    """The batches of one window after another: tells the error that ends the run, as check_outcomes() would from the window's outcomes alone."""

    def __init__(self, most: int):
        self.most, self.win, self.streak, self.last = most, None, 0, None

    def saw(self, win: int, errors: list[str | None]) -> Exception | None:
        if win != self.win:
            self.win, self.streak, self.last = win, 0, None
        whole = all(e is not None for e in errors)
        same = {signature(e) for e in errors} if whole and len(errors) > 1 else set()
        now = same.pop() if len(same) == 1 else None
        again, self.last = now is not None and now == self.last, now
        self.streak = self.streak + 1 if whole else 0
        if again:
            return SystematicFailureError(f"every clip of two batches in a row failed with: {now}")
        return DeadContextError(f"{self.streak} batches in a row failed") if self.streak >= self.most else None


def signature(error: str) -> str:
    """functions.text.error_signature() of one message."""
    return " ".join(error.split())[:160]


#: Runs that a worker has seen fail for good.
_DEAD: set[str] = set()


@dataclass(frozen=True)
class Guard:
    """Ends a run's job early: batches that may fail in a row, a name of the run, and the accumulator that its tasks tell."""

    most: int
    run: str
    alarm: Accumulator


@contextmanager
def guarded(spark: SparkSession, most: int, run: str, every: float = 0.2) -> Iterator[Guard]:
    """For one job that transcribes: cancels it as soon as a task has seen the end of the run, and raises that error in its place."""
    sc = spark.sparkContext
    guard = Guard(most, run, sc.accumulator([], Alarm()))
    over = threading.Event()

    def look() -> None:
        while not over.wait(every):
            if guard.alarm.value:
                sc.cancelJobGroup(run)
                return

    sc.setJobGroup(run, "transcribe", interruptOnCancel=False)
    watcher = InheritableThread(target=look, daemon=True)
    watcher.start()
    try:
        yield guard
    except Exception as e:
        if not guard.alarm.value:
            if "ModelLoadError" in str(e):
                raise ModelLoadError(str(e).rsplit("ModelLoadError: ", 1)[-1].splitlines()[0]) from e
            raise
    finally:
        over.set()
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            sc.setLocalProperty(key, None)
    if guard.alarm.value:
        raise min(guard.alarm.value, key=lambda x: x[0])[1]


def transcribe(
    batches: DataFrame, factory: ModelFactory = EchoModel, options: dict | None = None, path_col: str = "audio_filepath", shape: audio.Shape | None = None,
    workers: int = 1, tasks: int | None = None, guard: Guard | None = None, profile: ResourceProfile | None = None,
) -> DataFrame:
    """Outcome rows of rows with win, batch_no, slot: status ok or failed, the NFKC text, the error, and path and duration as they came.

    Rows stream by in the order of window, batch and slot, so a task holds a batch or two.  With a shape and a column `action`, clips to be
    converted are so in the task, and a clip that can't be is a failure of its own.  With a guard a worker that has seen the end
    of the run tells it and leaves the rest of the rows out.  A profile gives each task its accelerators, the model the first of them.
    """
    options = options or {}
    keep = ["seq", "segment_id", "win", "batch_no", "slot", *(["action"] if shape else [])]
    duration = F.col("duration") if "duration" in batches.columns else F.lit(None)
    rows = batches.select(*keep, F.col(path_col).alias("audio_filepath"), duration.cast("double").alias("duration"))

    def run(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, watch = None, Watch(guard.most if guard else 0)
        for part, ready in ready_batches(whole_batches(pieces), "audio_filepath", shape, workers):
            if guard and guard.run in _DEAD:
                return
            model = model or loaded(factory, placed(options))
            told = iter(isolate(model, [p for p, e in ready if e is None]))
            found = [next(told) if e is None else ("", e) for _, e in ready]
            out = part[["seq", "segment_id", "win", "batch_no", "audio_filepath", "duration"]].assign(pred_text=[t for t, _ in found], error=[e for _, e in found])
            out["status"] = ["ok" if e is None else "failed" for e in out["error"]]
            yield out[["seq", "segment_id", "win", "batch_no", "pred_text", "status", "error", "audio_filepath", "duration"]]
            end = watch.saw(int(part["win"].iloc[0]), [e for _, e in found]) if guard else None
            if end is not None:
                _DEAD.add(guard.run)
                guard.alarm.add([(watch.win, end)])
                return

    tasks = tasks or max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    # a number of its own: small rows, but long work, so the partitions are not to be joined
    dealt = rows.repartition(tasks, "win").sortWithinPartitions("win", "batch_no", "slot")
    out = dealt.mapInPandas(run, OUTCOME, profile=profile) if profile else dealt.mapInPandas(run, OUTCOME)
    return out.withColumn("pred_text", nfkc("pred_text"))


def whole_batches(pieces: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in the order of batches, a batch at a time, wherever the pieces are cut."""
    held: pd.DataFrame | None = None
    for piece in pieces:
        if held is not None:
            piece = pd.concat([held, piece])
        parts = [p for _, p in piece.groupby(["win", "batch_no"], sort=False)]
        yield from parts[:-1]
        held = parts[-1] if parts else None
    if held is not None:
        yield held


def placed(options: dict) -> dict:
    """The options with the accelerator that Spark has given the task, if it has."""
    task = TaskContext.get()
    given = task.resources().get("gpu") if task else None
    return options | ({"device": f"cuda:{given.addresses[0]}"} if given and given.addresses else {})


def gpu_profile(share: float) -> ResourceProfile:
    """A stage whose tasks each get `share` of a GPU, which is one model's."""
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource("gpu", share)).build


def batch_outcomes(outcomes: DataFrame) -> DataFrame:
    """win, batch_no, n, failed, whole_failed, and the systematic error: one signature for all clips of a failed batch of several."""
    sig = error_signature(F.coalesce("error", F.lit("")))
    out = outcomes.groupBy("win", "batch_no").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.min(F.when(F.col("status") == "failed", sig)).alias("_low"), F.max(F.when(F.col("status") == "failed", sig)).alias("_high"),
    )
    whole = F.col("failed") == F.col("n")
    return out.select("win", "batch_no", "n", "failed", whole.alias("whole_failed"), F.when(whole & (F.col("n") > 1) & (F.col("_low") == F.col("_high")), F.col("_low")).alias("systematic_error"))


def failure_streaks(batches: DataFrame, order: list[str], failed: str = "whole_failed", partition: list[str] | None = None) -> DataFrame:
    """Adds `streak`, the number of failed batches in a row up to this one; 0 for one that did not fail."""
    by = f"partition by {', '.join(partition)} " if partition else ""
    run = F.expr(f"sum(case when {failed} then 0 else 1 end) over ({by}order by {', '.join(order)} rows unbounded preceding)")
    marked = batches.withColumn("_g", run)
    inner = ", ".join([*(partition or []), "_g"])
    return marked.withColumn("streak", F.expr(f"sum(case when {failed} then 1 else 0 end) over (partition by {inner} order by {', '.join(order)} rows unbounded preceding)")).drop("_g")


def systematic_streaks(batches: DataFrame, order: list[str], signature: str = "systematic_error", partition: list[str] | None = None) -> DataFrame:
    """Adds `repeated`: the batch and the one before failed systematically with one signature."""
    by = f"partition by {', '.join(partition)} " if partition else ""
    before = F.expr(f"lag({signature}) over ({by}order by {', '.join(order)})")
    return batches.withColumn("repeated", F.coalesce(F.col(signature) == before, F.lit(False)))


@dataclass(frozen=True)
class Tail:
    """How the batches so far end: failures in a row, and the systematic error of the last one."""

    streak: int = 0
    error: str | None = None


def window_streaks(outcomes: DataFrame) -> DataFrame:
    """A row for each window: batches, head, tail and longest (failed batches in a row at its begin, its end, at most), first_error, last_error, repeat_error.

    Windows are looked at apart, so no task sees the batches of all.
    """
    batches = systematic_streaks(failure_streaks(batch_outcomes(outcomes), ["batch_no"], partition=["win"]), ["batch_no"], partition=["win"])
    # in the run that begins a window a batch's streak is its place
    nth = F.expr("row_number() over (partition by win order by batch_no)")
    batches = batches.withColumn("head", F.when(F.col("streak") == nth, F.col("streak")).otherwise(0))
    return batches.groupBy("win").agg(
        F.count("*").alias("batches"), F.max("head").alias("head"), F.max_by("streak", "batch_no").alias("tail"), F.max("streak").alias("longest"),
        F.min_by("systematic_error", "batch_no").alias("first_error"), F.max_by("systematic_error", "batch_no").alias("last_error"), F.max(F.when(F.col("repeated"), F.col("systematic_error"))).alias("repeat_error"),
    )


def joined_streaks(windows: DataFrame, before: Tail = Tail()) -> DataFrame:
    """window_streaks() with `streak` (the longest run that ends in the window, counted over windows), `again` (a systematic error repeated, here
    or from the window before) and `ending` (the run at the window's end).  One row a window: for as many windows as a chunk has.
    """
    own = "order by win rows between unbounded preceding"
    marked = windows.withColumn("_g", F.expr(f"sum(case when head < batches then 1 else 0 end) over ({own} and current row)"))
    marked = marked.withColumn("ending", F.expr(f"sum(tail) over (partition by _g {own} and current row)") + F.when(F.col("_g") == 0, before.streak).otherwise(0))
    carried = F.coalesce(F.expr("lag(ending) over (order by win)"), F.lit(before.streak))
    nth = F.expr("row_number() over (order by win)")
    last = F.when(nth == 1, F.lit(before.error)).otherwise(F.expr("lag(last_error) over (order by win)"))
    run = F.greatest("longest", F.when(F.col("head") > 0, carried + F.col("head")).otherwise(0))
    return marked.select("win", run.alias("streak"), (F.col("repeat_error").isNotNull() | F.coalesce(F.col("first_error") == last, F.lit(False))).alias("again"), "ending", "last_error", F.coalesce("repeat_error", "first_error").alias("error"))


def verdicts(outcomes: DataFrame, most: int = 5, before: Tail = Tail()) -> DataFrame:
    """joined_streaks() with `verdict`: null for a window after which a run may go on, else why not; the systematic reason comes first."""
    told = joined_streaks(window_streaks(outcomes), before)
    return told.withColumn("verdict", F.when(F.col("again"), "systematic").when(F.col("streak") >= most, "dead"))


def check_outcomes(outcomes: DataFrame, most: int = 5, before: Tail = Tail()) -> Tail:
    """Raise for a systematic failure or a dead context, else tell how the batches end."""
    told = verdicts(outcomes, most, before)
    # one look: the first bad window and the last window
    first = F.min(F.when(F.col("verdict").isNotNull(), F.struct("win", "verdict", "streak", "error"))).alias("bad")
    row = told.agg(first, F.max(F.struct("win", "ending", "last_error")).alias("last")).first()
    if row["bad"] is None:
        return before if row["last"] is None else Tail(row["last"]["ending"], row["last"]["last_error"])
    if row["bad"]["verdict"] == "systematic":
        raise SystematicFailureError(f"every clip of two batches in a row failed with: {row['bad']['error']}")
    raise DeadContextError(f"{row['bad']['streak']} batches in a row failed")
