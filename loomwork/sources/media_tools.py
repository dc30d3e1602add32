"""Probes, frames and audio segments by external programs on the executors; what they print and write is returned as rows.

A task stages an asset in a folder of its own, runs the program there and copies what it wrote below the shared output
folder, so nothing stays on the machine.  Where a program is missing or fails, the asset's row has the error instead.
"""

from __future__ import annotations

import json
import os
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.drive import driven


class ToolError(Exception):
    pass


@dataclass(frozen=True)
class Tools:
    """Programs, seconds that a call may take, and the size of pictures and sound."""

    probe: str = "ffprobe"
    convert: str = "ffmpeg"
    timeout: float = 3600.0
    max_px: int = 480
    quality: int = 80
    sample_rate: int = 16_000
    kbps: int = 64

    def run(self, *arguments: str) -> str:
        """What a program printed, logs included."""
        try:
            done = subprocess.run(arguments, capture_output=True, timeout=self.timeout)
        except FileNotFoundError:
            raise ToolError(f"{arguments[0]} is missing") from None
        except subprocess.TimeoutExpired:
            raise ToolError(f"{arguments[0]} took more than {self.timeout:.0f} s") from None
        if done.returncode:
            raise ToolError(f"{arguments[0]} ended with {done.returncode}: {done.stderr[-200:].decode('utf-8', 'replace').strip()}")
        return (done.stdout + done.stderr).decode("utf-8", "replace")

    # The programs' arguments.
    @property
    def scale(self) -> str:
        return f"scale='min({self.max_px},iw)':'-2'"

    def metadata(self, source: str) -> str:
        return self.run(self.probe, "-v", "error", "-print_format", "json", "-show_format", "-show_streams", source)

    def picture(self, source: str, at: float, target: str) -> None:
        self.run(self.convert, "-y", "-ss", f"{max(0.0, at):.3f}", "-i", source, "-frames:v", "1", "-vf", self.scale, "-q:v", str(self.quality), target)

    def every(self, source: str, seconds: float, pattern: str) -> None:
        self.run(self.convert, "-y", "-i", source, "-vf", f"fps={1 / seconds if seconds > 0 else 1.0:.6f},{self.scale}", "-vsync", "vfr", "-q:v", str(self.quality), pattern)

    def segments(self, source: str, seconds: int, pattern: str) -> None:
        self.run(self.convert, "-y", "-i", source, "-vn", "-ac", "1", "-ar", str(self.sample_rate), "-b:a", f"{self.kbps}k", "-f", "segment", "-segment_time", str(seconds), pattern)

    def scene_log(self, source: str, threshold: float = 0.4) -> str:
        return self.run(self.convert, "-i", source, "-vf", f"scale=320:-2,select='gt(scene,{threshold})',metadata=print:file=-", "-an", "-f", "null", "-")

    def silence_log(self, source: str, decibel: float = -30.0, seconds: float = 2.0) -> str:
        return self.run(self.convert, "-i", source, "-vn", "-af", f"silencedetect=noise={decibel}dB:d={seconds}", "-f", "null", "-")


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _staged(path: str, folder: str) -> str:
    """The source in a task's folder, under its own extension."""
    system, name = _system(path)
    here = os.path.join(folder, "source" + os.path.splitext(name)[1])
    fs.copy_files(name, here, system, fs.LocalFileSystem())
    return here


def _shared(folder: str, names: list[str], out: str) -> list[str]:
    system, base = _system(out)
    system.create_dir(base, recursive=True)
    for n in names:
        fs.copy_files(os.path.join(folder, n), f"{base}/{n}", fs.LocalFileSystem(), system)
    return [f"{out}/{n}" for n in names]


def worked(assets: DataFrame, work: Callable[[str, str, dict], object], *columns: str, workers: int = 1) -> DataFrame:
    """asset, result (JSON), error: work(staged source, task's folder, row) for each row of assets (asset, path, columns)."""

    def worker(row: dict) -> str:
        with tempfile.TemporaryDirectory() as folder:
            found = work(_staged(row["path"], folder), folder, row)
        return found if isinstance(found, str) else json.dumps(found)

    return driven(assets.select("asset", F.struct("asset", "path", *columns).alias("_row")), ["asset"], "_row", worker, workers)


def probed(assets: DataFrame, tools: Tools = Tools()) -> DataFrame:
    """result: the probe's JSON, for functions.media.typed_metadata."""
    return worked(assets, lambda source, folder, row: tools.metadata(source))


def logged(assets: DataFrame, kind: str, tools: Tools = Tools()) -> DataFrame:
    """result: the log of a detector, kind scene or silence, for functions.media.scene_times and silent_intervals."""
    return worked(assets, lambda source, folder, row: tools.scene_log(source) if kind == "scene" else tools.silence_log(source))


def frames(assets: DataFrame, out: str, times: str = "times", tools: Tools = Tools(), prefix: str = "frame") -> DataFrame:
    """result: [path, second] of one picture at each of an asset's times; one that fails is left out, the others stay."""

    def work(source: str, folder: str, row: dict) -> list:
        made = []
        for k, at in enumerate(row[times] or [], start=1):
            name = f"{prefix}_{k:04d}.webp"
            try:
                tools.picture(source, at, os.path.join(folder, name))
            except ToolError as e:
                if "missing" in str(e):
                    raise
            if os.path.exists(os.path.join(folder, name)):
                made.append((name, float(at)))
        paths = _shared(folder, [n for n, _ in made], f"{out}/{row['asset']}")
        return [[p, at] for p, (_, at) in zip(paths, made)]

    return worked(assets, work, times)


def posters(assets: DataFrame, out: str, duration: str = "duration_seconds", tools: Tools = Tools()) -> DataFrame:
    """result: [path, second] of one picture at half of the duration, or an empty list."""
    half = assets.withColumn("times", F.array(F.coalesce(F.col(duration), F.lit(0.0)) / 2))
    return frames(half, out, "times", tools, "poster")


def series(assets: DataFrame, out: str, kind: str, seconds: str = "seconds", tools: Tools = Tools()) -> DataFrame:
    """result: paths, in order, of pictures every so many seconds (kind frames) or of mono sound in windows of so many (kind segments)."""
    pattern, call = {"frames": ("frame_%04d.webp", tools.every), "segments": ("segment_%04d.mp3", tools.segments)}[kind]

    def work(source: str, folder: str, row: dict) -> list[str]:
        call(source, row[seconds], os.path.join(folder, pattern))
        return _shared(folder, sorted(n for n in os.listdir(folder) if n.startswith(pattern.split("%")[0])), f"{out}/{row['asset']}")

    return worked(assets, work, seconds)
