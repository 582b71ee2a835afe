"""Runs: scan, resume, probe, batch, transcribe, commit; and combine."""

from __future__ import annotations

import logging
import queue
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import batching, combine, inference, resume
from ..sources import audio, files, sinks, transcripts
from . import config

LOG = logging.getLogger(__name__)


def told(row: Row) -> str:
    """A result row as text."""
    return " ".join(f"{k}={v:.2f}" if isinstance(v, float) else f"{k}={v}" for k, v in row.asDict().items())


def ledger_of(spark: SparkSession, cfg: config.Config, path: str) -> resume.Ledger:
    return resume.Ledger(spark, cfg.paths.checkpoint_dir, path, cfg.checkpoint.enabled)


def attempts_of(outcomes: DataFrame, run_id: str) -> DataFrame:
    """Ledger rows of outcomes, and what the gates look at."""
    return outcomes.select(F.lit(run_id).alias("run_id"), "seq", "segment_id", "pred_text", "status", "error", "audio_filepath", "duration", F.current_timestamp().alias("attempt_ts"), "win", "batch_no")


#: A chunk may shrink to this share of what the first one is guessed to be.
GRAINS = 16


class Pace:
    """How many windows a chunk has: at first flush_every_n rows for each task slot, then what takes about flush_every_seconds.

    Windows are kept in grains, the least that a chunk may have.
    """

    def __init__(self, cfg: config.Config, slots: int, windows: int | None = None):
        self.window = max(cfg.batch.batch_size, cfg.batch.sort_buffer_size)
        self.wanted = 0 if windows else cfg.checkpoint.flush_every_seconds
        self.windows = windows or max(1, -(-cfg.checkpoint.flush_every_n * slots // self.window))
        self.grain = self.windows if windows else max(1, self.windows // GRAINS)

    def took(self, seconds: float) -> None:
        if self.wanted > 0:
            self.windows = max(self.grain, round(self.windows * min(2.0, max(0.5, self.wanted / max(seconds, 1e-3)))))

    def grains(self) -> int:
        return max(1, self.windows // self.grain)


def counted(name: str, **counts) -> tuple[Observation, list]:
    """For DataFrame.observe(): what a job counts on its way."""
    return Observation(f"{name}-{uuid.uuid4().hex}"), [c.alias(k) for k, c in counts.items()]


def told_by(seen: Observation, otherwise: Callable[[], dict], seconds: float = 10.0) -> dict:
    """What a job that has ended has counted; where the planner has left the count out of the plan, as for an empty input, it is made by `otherwise`."""
    box: queue.Queue = queue.Queue()
    threading.Thread(target=lambda: box.put(seen.get), daemon=True).start()
    try:
        return {k: v or 0 for k, v in box.get(timeout=seconds).items()}
    except queue.Empty:
        LOG.debug("no counts of %s came with its job", seen._name)
        return otherwise()


def run_inference(
    spark: SparkSession, path: str, cfg: config.Config, factory: inference.ModelFactory = inference.EchoModel, limit: int | None = None,
    dry_run: bool = False, use_resume: bool = True, force: bool = False, explicit_device: bool = False, chunk: int | None = None,
) -> Row:
    """Transcribe what has no prediction yet; a row of seen, ok, failed, resumed, unreadable, over_window, seconds, elapsed and realtime.

    Rows go in chunks of windows (`chunk` of them; by default as many as the configured cadence asks for).  A chunk's outcomes are
    written once, where they stay, and are checked for a dead model together with the end of the chunk before; only
    an entry in the ledger's log makes them count.  A run that is killed between leaves nothing to see, and without resume the
    old ledger counts until the first chunk is entered.  Tables of the run's own are deleted at its end, however it comes.
    """
    began = time.time()
    fmt = transcripts.detect_format(spark, path)
    records, _ = transcripts.read_transcripts(spark, path, cfg.paths.audio_root, fmt)
    ledger = ledger_of(spark, cfg, path)
    use_resume = use_resume and ledger.enabled
    if dry_run:
        probed = audio.probe(resume.take_first(records, limit), workers=cfg.runtime.io_workers)
        row = audio.summarize(probed, cfg.audio.target_sample_rate, cfg.audio.max_duration_seconds).first()
        return summary(began, seen=row["total"], unreadable=row["missing"], over_window=row["over_window"], seconds=row["seconds"])
    device = config.resolve_device(cfg.device, explicit_device)
    model = cfg.model
    options = {
        "device": device, "model": model.local_model_path or model.hf_repo_id, "local": model.local_model_path is not None, "lang": model.target_lang, "task": model.task,
        "dtype": inference.dtype_of(model.dtype), "max_new_tokens": model.max_new_tokens, "sampling_rate": model.sampling_rate,
    }
    todo, all_seen, left_seen = records, None, None
    if use_resume:
        ledger.guard(resume.manifest(spark, path, fmt, cfg.fingerprint()), force)
        all_seen, counts = counted("all", n=F.count("*"))
        todo = ledger.pending(records.observe(all_seen, *counts))
        left_seen, counts = counted("left", n=F.count("*"))
        todo = todo.observe(left_seen, *counts)
    stage = files.shared_folder(spark)
    try:
        probed, totals = stage_probes(spark, cfg, resume.take_first(todo, limit), stage)
        if use_resume:
            n = told_by(all_seen, lambda: {"n": records.count()})["n"] - told_by(left_seen, lambda: {"n": ledger.pending(records).count()})["n"]
            totals |= {"resumed": n}
        done = run_chunks(spark, cfg, ledger, probed, factory, options, stage, not use_resume, chunk)
    finally:
        files.delete(spark, stage)
    row = summary(began, **totals, **done)
    LOG.info("%s", told(row))
    return row


def summary(began: float, seen=0, ok=0, failed=0, resumed=0, unreadable=0, over_window=0, seconds=0.0) -> Row:
    elapsed = time.time() - began
    return Row(seen=seen, ok=ok, failed=failed, resumed=resumed, unreadable=unreadable, over_window=over_window, seconds=float(seconds), elapsed=elapsed, realtime=seconds / elapsed if elapsed > 0 else 0.0)


def journal_of(cfg: config.Config) -> str:
    return files.join(cfg.paths.log_dir, "errors")


def stage_probes(spark: SparkSession, cfg: config.Config, records: DataFrame, stage: str) -> tuple[DataFrame, dict]:
    """The probed records as a table, which must not change between batching and transcribing, and their counts; journals clips that
    can't be read and those longer than the model's window, whose text the model may cut without a word.
    """
    limit = cfg.audio.max_duration_seconds
    probed = audio.probe(records, workers=cfg.runtime.io_workers)
    probed = audio.plan_decoding(probed, cfg.audio.target_sample_rate, cfg.audio.mono, cfg.audio.resample_on_the_fly, limit)
    over = F.col("is_readable") & F.coalesce("over_window", F.lit(False))
    seen, counts = counted("probed", seen=F.count("*"), unreadable=F.count_if(~F.col("is_readable")), over_window=F.count_if(over))
    probed.observe(seen, *counts).write.parquet(f"{stage}/probed")
    probed = spark.read.schema(probed.schema).parquet(f"{stage}/probed")
    totals = told_by(seen, lambda: probed.agg(*counts).first().asDict())
    if totals["unreadable"] or totals["over_window"]:
        length = F.format_string("%.1f s is over the window of %.1f s, the text may be cut", "probe.duration_seconds", F.lit(float(limit)))
        told = F.when(over, length).otherwise(F.coalesce("probe.error", F.lit("missing")))
        sinks.write_journal(probed.where(over | ~F.col("is_readable")).withColumn("error", told), journal_of(cfg))
    return probed, totals


def run_chunks(spark, cfg, ledger, probed, factory, options, stage, fresh, chunk) -> dict:
    """ok, failed and seconds of all chunks: for each a job that writes its outcomes, a look at them by the gates, and an entry in the log."""
    ready = probed.where("action <> 'reject'").withColumn("duration", F.coalesce("probe.duration_seconds", F.lit(0.0)))
    batches = batching.assign_batches(ready, cfg.batch.batch_size, cfg.batch.sort_buffer_size, cfg.batch.max_batch_duration_seconds)
    pace = Pace(cfg, spark.sparkContext.defaultParallelism, chunk)
    # windows are dealt once; a chunk reads its own folders
    kept = ["seq", "segment_id", "audio_filepath", "duration", "action", "win", "batch_no", "slot"]
    windows, counts = counted("windows", n=F.coalesce(F.max("win") + 1, F.lit(0)))
    batches = batches.select(*kept).observe(windows, *counts).withColumn("part", F.expr(f"win div {pace.grain}"))
    batches.write.partitionBy("part").parquet(f"{stage}/batches")
    batches = spark.read.schema(batches.schema).parquet(f"{stage}/batches")
    parts = -(-told_by(windows, lambda: batches.agg(*counts).first().asDict())["n"] // pace.grain)
    shape = audio.Shape(cfg.audio.target_sample_rate, cfg.audio.mono, cfg.audio.ffmpeg_binary, cfg.audio.ffmpeg_timeout_seconds)
    run_id, tail = uuid.uuid4().hex, inference.Tail()
    profile = inference.gpu_profile(cfg.runtime.gpus_per_task) if cfg.runtime.gpus_per_task else None
    totals: dict = {"ok": 0, "failed": 0, "seconds": 0.0}
    low, ticks, began = 0, 0, time.time()
    while low < parts:
        high, chunk_began = min(parts, low + pace.grains()), time.time()
        part = batches.where(F.col("part").between(low, high - 1))
        with inference.guarded(spark, cfg.runtime.max_consecutive_batch_failures, run_id) as guard:
            outcomes = inference.transcribe(part, factory, options, shape=shape, workers=cfg.runtime.io_workers, guard=guard, profile=profile)
            ok = F.col("status") == "ok"
            seen, counts = counted("outcomes", ok=F.count_if(ok), failed=F.count_if(~ok), seconds=F.sum(F.when(ok, F.col("duration"))))
            staged = ledger.stage(attempts_of(outcomes.observe(seen, *counts), run_id), f"{run_id}:{low}", low * pace.grain, high * pace.grain, replace=fresh)
        done = ledger.staged(staged)
        try:
            tail = inference.check_outcomes(done, cfg.runtime.max_consecutive_batch_failures, tail)
        except Exception:
            ledger.drop(staged)
            raise
        got = told_by(seen, lambda: done.agg(*counts).first().asDict())
        if got["failed"]:
            sinks.write_journal(done.where("status = 'failed'"), journal_of(cfg))
        ledger.enter(staged)
        fresh, low = False, high
        totals = {k: totals[k] + (got[k] or 0) for k in totals}
        n = totals["ok"] + totals["failed"]
        if n // max(1, cfg.runtime.progress_every_n) > ticks or low >= parts:
            ticks, spent = n // max(1, cfg.runtime.progress_every_n), time.time() - began
            LOG.info("%d clips done, %d of them failed, %.1f clips/s, %.2f h", n, totals["failed"], n / max(spent, 1e-9), spent / 3600)
        pace.took(time.time() - chunk_began)
    if parts:
        ledger.compact()
        ledger.vacuum()
    return totals


def predicted_path(cfg: config.Config, path: str) -> str:
    return files.join(cfg.paths.output_dir, sinks.predicted_name(path))


def export_predictions(spark: SparkSession, path: str, cfg: config.Config) -> str:
    """The ledger's last predictions as text beside the input's format."""
    fmt = transcripts.detect_format(spark, path)
    out = predicted_path(cfg, path)
    sinks.write_lines(sinks.prediction_lines(ledger_of(spark, cfg, path).latest(), fmt), out)
    return out


def predictions(spark: SparkSession, cfg: config.Config, path: str, predicted: str | None) -> DataFrame | None:
    """seq, segment_id, pred_text from a prediction file, or from the ledger without one."""
    if predicted is not None:
        if not files.exists(spark, predicted):
            return None
        rows, _ = transcripts.read_transcripts(spark, predicted, cfg.paths.audio_root)
        return rows.select("seq", "segment_id", F.col("text").alias("pred_text"))
    ledger = ledger_of(spark, cfg, path)
    return ledger.latest().select("seq", "segment_id", "pred_text") if ledger.started() else None


def run_combine(spark: SparkSession, path: str, cfg: config.Config, predicted: str | None = None, output: str | None = None, fmt: str | None = None, merge: bool = False) -> Row | None:
    """Write the combined table and the ids without a prediction; the row of combine.stats_frame(), None if there are no predictions."""
    own = predictions(spark, cfg, path, predicted)
    if own is None:
        return None
    records, _ = transcripts.read_transcripts(spark, path, cfg.paths.audio_root)
    output = output or files.join(cfg.paths.output_dir, sinks.combined_name(path))
    fmt = fmt or transcripts.suffix_format(output)
    sinks.write_lines(sinks.combined_lines(combine.combine(records, own, merge=merge), fmt), output)
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    sinks.write_missing(combine.missing(records, own), files.join(cfg.paths.log_dir, f"missing-{stem}.txt"))
    return combine.stats_frame(records, own).first()
