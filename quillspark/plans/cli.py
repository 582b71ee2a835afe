"""Command line: transcribe, combine, run, validate, status.

Exit codes: 0 done, 1 failed, 2 a file is missing, 3 the ledger belongs to another input, 4 no such device,
130 interrupted.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import SparkSession

from ..operators import inference, models, resume, status
from ..sources import files
from . import config, logs, runs

LOG = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillspark", description=__doc__.splitlines()[0])
    verbs = top.add_subparsers(dest="command", required=True)
    for verb, what in (("transcribe", "predict what has no prediction yet"), ("combine", "join references and predictions"), ("run", "transcribe, then combine"), ("validate", "check audio paths"), ("status", "report progress")):
        p = verbs.add_parser(verb, help=what)
        p.add_argument("--config")
        p.add_argument("--input", required=True)
        for flag in ("--audio-root", "--output-dir", "--device"):
            p.add_argument(flag)
        p.add_argument("--log-level", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
        p.add_argument("--cuda-index", type=int)
        if verb in ("transcribe", "run", "validate"):
            p.add_argument("--limit", type=int)
        if verb in ("transcribe", "run"):
            p.add_argument("--no-resume", action="store_true")
            p.add_argument("--force-resume", action="store_true")
            p.add_argument("--batch-size", type=int)
        if verb == "transcribe":
            p.add_argument("--dry-run", action="store_true")
        if verb in ("combine", "run"):
            p.add_argument("--low-memory", action="store_true", help="a sort-merge join")
        if verb == "combine":
            p.add_argument("--predicted")
            p.add_argument("--output")
            p.add_argument("--format", choices=["tsv", "jsonl"])
    return top


def overrides(a: argparse.Namespace) -> dict:
    return {
        "paths": {"audio_root": a.audio_root, "output_dir": a.output_dir},
        "runtime": {"log_level": a.log_level},
        "batch": {"batch_size": getattr(a, "batch_size", None)},
        "device": {"prefer": [a.device] if a.device else ["cuda"] if a.cuda_index is not None else None, "cuda_index": a.cuda_index},
    }


def dispatch(a: argparse.Namespace, cfg: config.Config, spark: SparkSession, factory: inference.ModelFactory) -> int:
    # a device or an index that was asked for is used or an error, never passed over
    explicit = a.device is not None or a.cuda_index is not None
    if a.command in ("transcribe", "run"):
        row = runs.run_inference(spark, a.input, cfg, factory, a.limit, getattr(a, "dry_run", False), not a.no_resume, a.force_resume, explicit)
        print(runs.told(row))
        if row["failed"] and not row["ok"]:
            return 1
    if a.command in ("combine", "run"):
        found = runs.run_combine(spark, a.input, cfg, getattr(a, "predicted", None), getattr(a, "output", None), getattr(a, "format", None), a.low_memory)
        if found is None:
            LOG.error("no predictions for %s", a.input)
            return 2
        print(runs.told(found))
        return 0 if found["total_input"] else 1
    if a.command == "validate":
        print("device", config.resolve_device(cfg.device, explicit))
        row = runs.run_inference(spark, a.input, cfg, factory, a.limit, dry_run=True, use_resume=False)
        print(runs.told(row))
        return 1 if row["unreadable"] else 0
    if a.command == "status":
        ledger = runs.ledger_of(spark, cfg, a.input)
        if not files.exists(spark, ledger.dir):
            print(f"nothing started yet in {ledger.dir}")
            return 0
        row = status.progress(ledger.read()).first()
        print(f"completed={row['completed']} distinct={row['distinct_ids']} failed={row['failed']} empty={row['empty']}")
        for what, where in (("ledger", ledger.data), ("predictions", runs.predicted_path(cfg, a.input))):
            if files.exists(spark, where):
                name, size, _ = files.described(spark, where)
                print(f"{what} {name} {size / 2**20:.1f} MB")
        if row["alarm"]:
            LOG.error("%d of %d predictions are empty", row["empty"], row["completed"])
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None, factory: inference.ModelFactory | None = None) -> int:
    """Without a factory the configured model is loaded; where none is configured the stand-in echoes."""
    a = parser().parse_args(argv)
    if a.config and not os.path.exists(a.config):
        print(f"no configuration at {a.config}", file=sys.stderr)
        return 2
    try:
        cfg = config.load(a.config, overrides(a))
        logs.begin_session(cfg.paths.log_dir, cfg.runtime.log_level)
        spark = spark or SparkSession.builder.appName("quillspark").getOrCreate()
        if not files.exists(spark, a.input):
            LOG.error("no input at %s", a.input)
            return 2
        return dispatch(a, cfg, spark, factory or (models.SpeechModel if cfg.model.hf_repo_id or cfg.model.local_model_path else inference.EchoModel))
    except resume.CheckpointMismatchError as e:
        LOG.error("%s", e)
        return 3
    except config.DeviceConfigError as e:
        LOG.error("%s", e)
        return 4
    except (inference.ModelLoadError, inference.DeadContextError, inference.SystematicFailureError) as e:
        LOG.error("%s", e)
        return 1
    except KeyboardInterrupt:
        LOG.warning("interrupted; run again to go on")
        return 130


if __name__ == "__main__":
    sys.exit(main())
