"""Runs a plain function over rows: a bounded number of calls at a time in each task, failures as rows.

Spark deals rows to tasks and runs lost ones again; within a task threads help where a call waits for something else.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame


def driven(rows: DataFrame, keys: list[str], value: str, worker: Callable[[object], str | None], workers: int = 1, ahead: int = 2) -> DataFrame:
    """keys, result, error for each row, in the order of each partition: worker(value), or the name and message of what it raised.

    At most workers * ahead calls of a task are waiting or running at any time, so memory doesn't grow with the rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    width = len(keys)

    def safe(x: object) -> tuple[str | None, str | None]:
        try:
            return worker(x), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"[:300]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                waiting: deque = deque()
                out: list[tuple[str | None, str | None]] = []
                for x in batch.column(width):
                    if len(waiting) >= workers * ahead:
                        out.append(waiting.popleft().result())
                    waiting.append(pool.submit(safe, x.as_py()))
                out += [f.result() for f in waiting]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array([r for r, _ in out], pa.string()), pa.array([e for _, e in out], pa.string())], names=[*keys, "result", "error"])

    return rows.select(*keys, value).mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "result string", "error string"]))
