"""Copies of blobs: what a load plan says is copied file by file by the tasks; placeholders are written once and copied where they stand.

File systems are those that pyarrow opens by a path's scheme; a plan's rows are independent, so a task that is lost is
simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Name and content of the shared placeholders: a white and a black picture of one pixel.
PLACEHOLDERS = {"placeholder_blank": "ffffff", "placeholder_redacted": "000000"}
COPIED = "doc_id string, artifact string, action string, copied boolean, bytes bigint"


def _png(colour: str) -> bytes:
    import struct
    import zlib

    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" + bytes.fromhex(colour))) + chunk(b"IEND", b"")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def seed_placeholders(root: str) -> dict[str, str]:
    """Writes the two placeholders below root, unless they are there; returns their paths."""
    out = {}
    system, base = _open(root)
    system.create_dir(f"{base}/placeholders", recursive=True)
    for action, colour in PLACEHOLDERS.items():
        path = f"{base}/placeholders/{action}.png"
        if system.get_file_info(path).type == fs.FileType.NotFound:
            with system.open_output_stream(path) as f:
                f.write(_png(colour))
        out[action] = f"{root}/placeholders/{action}.png"
    return out


def copy_blobs(plan: DataFrame, root: str, sources: str = "") -> DataFrame:
    """COPIED: one row for each row of plan (doc_id, artifact, action, source_path); a source that is missing isn't copied.

    Blobs go to root/doc_id/artifact.  Source paths without a scheme stand below `sources`.  Running it again copies again.
    """
    placeholders = seed_placeholders(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied, sizes = [], []
            for doc, artifact, action, source in zip(*(c.to_pylist() for c in batch.columns)):
                path = placeholders.get(action, source)
                path = path if not path or path.startswith("/") or ":" in path.split("/")[0] else f"{sources}/{path}"
                size = None
                if path:
                    system, name = _open(path)
                    if system.get_file_info(name).type == fs.FileType.File:
                        target, to = _open(f"{root}/{doc}/{artifact}")
                        target.create_dir(to.rsplit("/", 1)[0], recursive=True)
                        fs.copy_files(name, to, system, target)
                        size = system.get_file_info(name).size
                copied.append(size is not None)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(copied, pa.bool_()), pa.array(sizes, pa.int64())], names=["doc_id", "artifact", "action", "copied", "bytes"])

    return plan.select(F.col("doc_id").cast("string").alias("doc_id"), "artifact", "action", "source_path").mapInArrow(run, COPIED)


def flushed(copied: DataFrame) -> DataFrame:
    """Blobs copied and missing and their bytes, by action."""
    return copied.groupBy("action").agg(F.count_if("copied").alias("copied"), F.count_if(~F.col("copied")).alias("missing"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
