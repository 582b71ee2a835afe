"""Logs of a session: one configuration for the console and a file, in Bangkok's time."""

from __future__ import annotations

import logging.config
import os
import time
from datetime import datetime, timedelta, timezone

#: Bangkok has kept this offset since 1920.
BANGKOK = timezone(timedelta(hours=7))
LINE = "%(asctime)s %(levelname)s %(name)s %(message)s"


def stamp_of(moment: float) -> str:
    return datetime.fromtimestamp(moment, BANGKOK).strftime("%Y%m%d-%H%M%S")


def local_time(seconds: float | None = None) -> time.struct_time:
    """For logging.Formatter.converter."""
    return datetime.fromtimestamp(time.time() if seconds is None else seconds, BANGKOK).timetuple()


def make_formatter(**_) -> logging.Formatter:
    made = logging.Formatter(LINE, "%Y-%m-%d %H:%M:%S")
    made.converter = local_time
    return made


def begin_session(folder: str, level: str = "INFO") -> str:
    """Send the package's records to the console and to a new file in the folder; the file's path.  A later call replaces both."""
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"session-{stamp_of(time.time())}.log")
    outputs = {
        "console": {"class": "logging.StreamHandler", "formatter": "bangkok", "stream": "ext://sys.stdout"},
        "file": {"class": "logging.FileHandler", "formatter": "bangkok", "filename": target, "encoding": "utf-8"},
    }
    logging.config.dictConfig({
        "version": 1, "disable_existing_loggers": False, "formatters": {"bangkok": {"()": make_formatter}},
        "handlers": outputs, "loggers": {"quillspark": {"level": level, "handlers": list(outputs)}},
    })
    return target
