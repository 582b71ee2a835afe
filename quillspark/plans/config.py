"""Typed configuration: one file over the defaults here, then overrides; and the device policy."""

from __future__ import annotations

import dataclasses
import json
import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.resume import fingerprint

LOG = logging.getLogger(__name__)


class DeviceConfigError(Exception):
    """A device that can't be used as asked."""


@dataclass
class Paths:
    audio_root: str = "./data/audio"
    output_dir: str = "./data/predictions"
    checkpoint_dir: str = "./data/checkpoints"
    log_dir: str = "./logs"
    scratch_dir: str = "./data/scratch"


@dataclass
class ModelSettings:
    hf_repo_id: str = ""
    local_model_path: str | None = None
    target_lang: str = "th"
    task: str = "transcribe"
    dtype: str = "bfloat16"
    max_new_tokens: int = 440
    sampling_rate: int = 16000


@dataclass
class Device:
    prefer: list[str] = field(default_factory=lambda: ["cuda", "cpu"])
    cuda_index: int = 0
    allow_mps: bool = False


@dataclass
class Batch:
    batch_size: int = 16
    sort_buffer_size: int = 2048
    max_batch_duration_seconds: float = 480.0


@dataclass
class Audio:
    target_sample_rate: int = 16000
    mono: bool = True
    resample_on_the_fly: bool = True
    ffmpeg_binary: str = "ffmpeg"
    ffmpeg_timeout_seconds: float = 60.0
    max_duration_seconds: float = 30.0


@dataclass
class Checkpoint:
    enabled: bool = True
    flush_every_n: int = 200
    flush_every_seconds: float = 30.0
    max_cached_shards: int = 4


@dataclass
class Runtime:
    io_workers: int = 8
    progress_every_n: int = 500
    max_consecutive_batch_failures: int = 5
    #: GPUs of a task on clusters that schedule them; 0 leaves that to the session
    gpus_per_task: float = 0.0
    log_level: str = "INFO"


@dataclass
class Config:
    paths: Paths = field(default_factory=Paths)
    model: ModelSettings = field(default_factory=ModelSettings)
    device: Device = field(default_factory=Device)
    batch: Batch = field(default_factory=Batch)
    audio: Audio = field(default_factory=Audio)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)
    runtime: Runtime = field(default_factory=Runtime)

    def fingerprint(self) -> str:
        return fingerprint(self.paths.audio_root, self.model.target_lang, self.model.task, self.model.hf_repo_id)


def merged(base: dict, over: dict) -> dict:
    """over on base: maps are merged, null overrides ignored, lists and scalars replaced."""
    out = dict(base)
    for k, v in over.items():
        if v is not None:
            out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def merged_maps(base: Column, over: Column) -> Column:
    """merged() of flat maps in columns."""
    return F.map_zip_with(base, over, lambda k, a, b: F.coalesce(b, a))


def boolean(v) -> bool:
    """Words count by their meaning: "false" is false."""
    if isinstance(v, str):
        if v.strip().lower() in ("true", "yes", "on", "1"):
            return True
        if v.strip().lower() in ("false", "no", "off", "0", ""):
            return False
        raise ValueError(f"not a boolean: {v!r}")
    return bool(v)


def coerced(kind: str, v):
    if v is None:
        return None
    if kind.startswith("bool"):
        return boolean(v)
    if kind.startswith("int"):
        return int(v)
    if kind.startswith("float"):
        return float(v)
    if kind.startswith("list"):
        return [str(x) for x in (v if isinstance(v, (list, tuple)) else [v])]
    return str(v)


def load(path: str | None = None, overrides: dict | None = None) -> Config:
    """The file (YAML if its library is there, else JSON) with overrides; absent keys have the defaults."""
    raw: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            body = f.read()
        try:
            import yaml

            raw = yaml.safe_load(body) or {}
        except ModuleNotFoundError:
            raw = json.loads(body)
    raw = merged(raw, overrides or {})
    out = Config()
    for group in dataclasses.fields(out):
        part = getattr(out, group.name)
        for f in dataclasses.fields(part):
            v = (raw.get(group.name) or {}).get(f.name)
            if v is not None:
                setattr(part, f.name, coerced(str(f.type), v))
    for f in dataclasses.fields(out.paths):
        setattr(out.paths, f.name, os.path.expanduser(getattr(out.paths, f.name)))
    return out


def parse_device(spec: str) -> tuple[str, int | None]:
    kind, _, index = spec.strip().lower().partition(":")
    if kind in ("cpu", "mps") and not index or kind == "cuda" and (not index or index.isdigit()):
        if not spec.strip().endswith(":"):
            return kind, int(index) if index else None
    raise DeviceConfigError(f"unknown device {spec!r}: cpu, mps, cuda or cuda:N")


def cuda_devices() -> int:
    try:
        import torch

        return torch.cuda.device_count() if torch.cuda.is_available() else 0
    except ImportError:
        return 0


def mps_available() -> bool:
    try:
        import torch

        return bool(torch.backends.mps.is_available())
    except (ImportError, AttributeError):
        return False


def resolve_device(cfg: Device, explicit: bool = False) -> str:
    """The first usable device of the preferences.  An explicit wish is an error if it can't be met, a preference is passed over."""
    for spec in cfg.prefer:
        kind, index = parse_device(spec)
        if kind == "cpu":
            return "cpu"
        problem = None
        if kind == "cuda":
            index, there = cfg.cuda_index if index is None else index, cuda_devices()
            if there and index >= there:
                raise DeviceConfigError(f"cuda:{index} asked for, {there} devices found")
            problem = None if there else "CUDA is not available"
        elif not cfg.allow_mps:
            problem = "mps needs device.allow_mps"
        elif not mps_available():
            problem = "mps is not available"
        if problem is None:
            return f"cuda:{index}" if kind == "cuda" else "mps"
        if explicit:
            raise DeviceConfigError(problem)
        LOG.warning("%s, trying the next device", problem)
    if explicit:
        raise DeviceConfigError(f"none of {cfg.prefer} is available")
    return "cpu"
