import json
import sys
import wave
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def tone(path, frames, rate=16000, channels=1, hertz=440):
    """A clip of a quarter-loud sine in 16 bits."""
    one = (8192 * np.sin(2 * np.pi * hertz / rate * np.arange(frames))).astype("<i2")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as clip:
        clip.setparams((channels, 2, rate, frames, "NONE", ""))
        clip.writeframes(np.repeat(one, channels).tobytes())
    return path


#: Clips of the test corpus and their frames at 16 kHz.
CLIPS = {"7-31-a": 800, "7-31-b": 4800, "7-31-c": 2400, "22-5-x": 3200, "22-5-y": 1600}
IDS = list(CLIPS)


@pytest.fixture
def corpus(tmp_path):
    """References, their clips, and a configuration over temporary folders."""
    from quillspark.plans import config

    source = tmp_path / "in.tsv"
    source.write_text("".join(f"{own}\tspoken คำ {own[-1]}\n" for own in IDS), encoding="utf-8")
    for own, frames in CLIPS.items():
        tone(tmp_path.joinpath("audio", "train", *own.split("-")[:2], f"{own}.wav"), frames)
    places = {"audio_root": "audio", "output_dir": "out", "checkpoint_dir": "ckpt", "log_dir": "logs", "scratch_dir": "scratch"}
    settings = {"paths": {k: str(tmp_path / v) for k, v in places.items()}, "device": {"prefer": ["cpu"]}, "batch": {"batch_size": 2, "sort_buffer_size": 8}, "runtime": {"io_workers": 2}}
    return source, config.load(None, settings), tmp_path


def dump(path, rows):
    Path(path).write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)
