"""Audio: header probes as data, and decoding to mono float samples."""

from __future__ import annotations

import os
import shutil
import struct
import subprocess
import wave
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures
from . import ranges

PROBE = "exists boolean, sample_rate int, channels int, duration_seconds double, error string"


class AudioError(Exception):
    """A clip that can't be read or decoded."""


#: Bytes that a header is looked for in at once.
HEADER_BYTES = 4096
#: Codings of a WAV's samples: whole numbers, and the extension that tells the coding in its own field.
PCM, EXTENSIBLE = 1, 0xFFFE


@dataclass(frozen=True)
class Wave:
    """What a WAV's header tells: samples a second, channels, bytes and number of samples, and where they begin."""

    rate: int
    channels: int
    width: int
    frames: int
    start: int


def read_header(f: pa.NativeFile) -> Wave:
    """Of an open file, from its chunks: their heads are read, and the samples are not; AudioError if it is no WAV of whole samples."""
    head = f.read(HEADER_BYTES)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise AudioError("file does not start with RIFF id" if head[:4] != b"RIFF" else "not a WAVE file")
    at, shape = 12, None
    while True:
        if at + 64 > len(head):  # behind a long chunk: the next one's head alone
            f.seek(at)
            part = f.read(64)
        else:
            part = head[at : at + 64]
        if len(part) < 8:
            raise AudioError("fmt chunk and/or data chunk missing")
        name, size = part[:4], int.from_bytes(part[4:8], "little")
        if name == b"fmt ":
            if len(part) < 24:
                raise AudioError("fmt chunk is cut")
            coding, channels, rate, _, _, bits = struct.unpack("<HHLLHH", part[8:24])
            if coding == EXTENSIBLE and len(part) >= 34:
                coding = int.from_bytes(part[32:34], "little")
            if coding != PCM:
                raise AudioError(f"unknown format: {coding}")
            if not channels or not bits:
                raise AudioError("bad # of channels" if not channels else "bad sample width")
            shape = rate, channels, (bits + 7) // 8
        elif name == b"data":
            if shape is None:
                raise AudioError("data chunk before fmt chunk")
            return Wave(*shape, size // (shape[1] * shape[2]), at + 8)
        at += 8 + size + size % 2


def probe_file(path: str | None) -> tuple:
    """exists, sample_rate, channels, duration_seconds, error of a clip on any file system; reads the header only and never raises."""
    try:
        if not path or not ranges.is_file(path):
            return False, None, None, None, "missing"
        with ranges.opened(path) as f:
            w = read_header(f)
        return True, w.rate, w.channels, w.frames / w.rate if w.rate else None, None
    except (AudioError, EOFError, OSError, pa.ArrowException, ValueError) as e:
        return True, None, None, None, f"{type(e).__name__}: {e}"


def probe(records: DataFrame, path_col: str = "audio_filepath", workers: int = 8) -> DataFrame:
    """The records with a struct `probe` and the flag `is_readable`."""
    names = [x.split()[0] for x in PROBE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                found = pd.DataFrame(list(pool.map(probe_file, batch[path_col])), columns=[f"_{n}" for n in names], index=batch.index)
                found = found.astype({"_sample_rate": "Int32", "_channels": "Int32"})
                yield pd.concat([batch, found], axis=1)

    schema = ", ".join([f"`{n}` {t}" for n, t in records.dtypes] + [f"_{x}" for x in PROBE.split(", ")])
    out = records.mapInPandas(run, schema)
    fields = F.struct(*[F.col(f"_{n}").alias(n) for n in names])
    return out.select(*records.columns, fields.alias("probe")).withColumn("is_readable", F.col("probe.exists") & F.col("probe.error").isNull())


def load_samples(path: str, rate: int = 16000) -> np.ndarray:
    """Mono samples from -1 to 1 at `rate`: channels averaged, other rates interpolated linearly."""
    try:
        with ranges.opened(path) as f:
            w = read_header(f)
            f.seek(w.start)
            raw = f.read(w.frames * w.channels * w.width)
    except (AudioError, EOFError, OSError, pa.ArrowException) as e:
        raise AudioError(f"{path}: {e}") from e
    raw = raw[: len(raw) // (w.channels * w.width) * w.channels * w.width]
    if w.width == 1:
        x = np.frombuffer(raw, np.uint8).astype(np.float32) / 128 - 1
    elif w.width in (2, 4):
        x = np.frombuffer(raw, f"<i{w.width}").astype(np.float32) / 2.0 ** (8 * w.width - 1)
    else:
        raise AudioError(f"{path}: samples of {w.width} bytes")
    x = x.reshape(-1, w.channels).mean(axis=1)
    if w.rate != rate and len(x):
        m = max(1, round(len(x) / w.rate * rate))
        x = np.interp(np.linspace(0, len(x) - 1, m), np.arange(len(x)), x)
    return x.astype(np.float32)


@dataclass(frozen=True)
class Shape:
    """What the model reads, and the program for clips that are no WAV of whole samples."""

    rate: int = 16000
    mono: bool = True
    program: str = "ffmpeg"
    seconds: float = 60.0


def convert(path: str, folder: str, shape: Shape) -> str:
    """The clip as a 16-bit WAV of the shape, under its own name in the folder; AudioError if it can't be read."""
    os.makedirs(folder, exist_ok=True)
    made = os.path.join(folder, os.path.splitext(os.path.basename(path))[0] + ".wav")
    try:
        samples = load_samples(path, shape.rate)
    except AudioError:
        return by_program(path, made, shape)
    with wave.open(made, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(shape.rate)
        w.writeframes(np.rint(np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return made


def local_copy(path: str, folder: str) -> str:
    """A path that programs can open: the clip's own, or that of a copy in the folder."""
    system, where = ranges.located(path)
    if isinstance(system, pafs.LocalFileSystem):
        return where
    copy = os.path.join(folder, "whole-" + os.path.basename(where))
    try:
        with system.open_input_stream(where) as f, open(copy, "wb") as out:
            shutil.copyfileobj(f, out)
    except (OSError, pa.ArrowException) as e:
        raise AudioError(f"{path}: {e}") from e
    return copy


def by_program(path: str, made: str, shape: Shape) -> str:
    """The same by the configured program, for other containers and codings."""
    path = local_copy(path, os.path.dirname(made))
    layout = ["-ac", "1"] if shape.mono else []
    try:
        done = subprocess.run([shape.program, "-v", "error", "-nostdin", "-i", path, *layout, "-ar", str(shape.rate), "-sample_fmt", "s16", "-y", made], capture_output=True, timeout=shape.seconds)
    except (OSError, subprocess.TimeoutExpired) as e:
        raise AudioError(f"{path}: {e}") from e
    if done.returncode:
        raise AudioError(f"{path}: {done.stderr.decode('utf-8', 'replace').strip()}")
    return made


def plan_decoding(probed: DataFrame, target: int = 16000, mono: bool = True, resample: bool = True, limit: float = 30.0) -> DataFrame:
    """Adds `action` (pass, convert or reject) and `over_window` to probed records; only columns are read.

    Readable clips of the target rate (and one channel, if mono) pass; others are converted when decoded,
    or rejected where that is switched off.  Unreadable clips are rejected.  A clip over the window is flagged and stays.
    """
    fits = measures.conforms(F.col("is_readable"), F.col("probe.sample_rate"), F.col("probe.channels"), target, mono)
    action = F.when(~F.col("is_readable"), "reject").when(fits, "pass").otherwise("convert" if resample else "reject")
    return probed.withColumn("action", action).withColumn("over_window", measures.exceeds_window(F.col("probe.duration_seconds"), limit))


def summarize(probed: DataFrame, target: int = 16000, limit: float = 30.0) -> DataFrame:
    """One row: counts of a dry run and the seconds of readable audio."""
    r, p = F.col("is_readable"), "probe."
    off = r & ((F.col(p + "sample_rate") != target) | (F.col(p + "channels") != 1))
    return probed.agg(
        F.count("*").alias("total"), F.count_if(r).alias("readable"), F.count_if(~r).alias("missing"), F.count_if(off).alias("non_conforming"),
        F.count_if(r & (F.col(p + "duration_seconds") > limit)).alias("over_window"), F.coalesce(F.sum(F.when(r, F.col(p + "duration_seconds"))), F.lit(0.0)).alias("seconds"),
    )
