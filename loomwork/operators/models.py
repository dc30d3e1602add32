"""Model-backed operators: gate, dedup, call in batches, join back.

A provider is any picklable object with call(list of inputs) -> list of outputs; it is built once for each
task.  Calls are retried with growing waits; a refused input becomes status `filtered` and isn't retried,
any other failure becomes status `error` and stays without a result, so the next run takes it up again.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.config import Summarise
from loomwork.storage import Scratch


class Refused(Exception):
    """The service refused an input for its content.  Any exception with this `kind` counts."""

    kind = "refused"


class Throttled(Exception):
    """The service asks to come back later.  Any exception with this `kind` counts; `after`: seconds to wait."""

    kind = "throttled"

    def __init__(self, after: float | None = None):
        super().__init__("throttled")
        self.after = after


def with_retries(call: Callable[[list], list], items: list, tries: int, wait: Callable[[float], None] = time.sleep) -> list:
    for n in range(tries):
        try:
            return call(items)
        except Exception as e:
            if getattr(e, "kind", "") != "throttled" or n + 1 == tries:
                raise
            after = getattr(e, "after", None)
            wait(min(60.0, 2.0**n) if after is None else after)
    raise ValueError("tries must be positive")


def called(rows: DataFrame, keys: list[str], text: str, provider: Callable[[], object], result: str, kind: pa.DataType, batch: int = 32, tries: int = 5) -> DataFrame:
    """keys, result, status (ok, filtered, error) for each row; rows go to the provider in batches."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = {pa.list_(pa.float32()): "array<float>", pa.string(): "string"}[kind]
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = provider()

        def safe(items: list) -> list[tuple[object, str]]:
            try:
                return [(x, "ok") for x in with_retries(model.call, items, tries)]
            except Exception as e:
                if getattr(e, "kind", "") != "refused":
                    return [(None, "error")] * len(items)
                return [(None, "filtered")] if len(items) == 1 else [y for x in items for y in safe([x])]

        for whole in batches:
            for low in range(0, whole.num_rows, batch):
                part = whole.slice(low, batch)
                out = safe(part.column(width).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:width], pa.array([x for x, _ in out], kind), pa.array([s for _, s in out])], names=[*keys, result, "status"])

    return rows.select(*keys, text).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{result}` {ddl}, status string")


def embedded(children: DataFrame, seen: DataFrame, provider: Callable[[], object], text: str = "text") -> DataFrame:
    """content_sha, vector, status of the shas that have no vector yet, each called once."""
    # What is seen goes before texts are grouped; a digest has one text, so both are keys and no text is sorted for a minimum.
    todo = children.select("content_sha", text).join(seen.select("content_sha").distinct(), "content_sha", "left_anti").distinct()
    return called(todo, ["content_sha"], text, provider, "vector", pa.list_(pa.float32()))


def full_coverage(children: DataFrame, seen: DataFrame) -> DataFrame:
    """The children, unless one has no vector: then the job fails instead of calling a provider."""
    flagged = children.join(seen.select("content_sha", F.lit(True).alias("_seen")).distinct(), "content_sha", "left")
    return flagged.where(F.assert_true(F.coalesce("_seen", F.lit(False)), "a child has no vector").isNull()).drop("_seen")


def coverage(children: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """key, n_children, n_missing, covered: what full_coverage would stop at, by document."""
    flagged = children.join(seen.select("content_sha", F.lit(True).alias("_seen")).distinct(), "content_sha", "left")
    by = flagged.groupBy(key).agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("_seen").isNull()).alias("n_missing"))
    return by.withColumn("covered", F.col("n_missing") == 0)


def reduced(items: DataFrame, key: str, order: str, text: str, provider: Callable[[], object], cfg: Summarise = Summarise()) -> DataFrame:
    """key, summary, depth: items of each document folded in batches of cfg.batch while their text is over cfg.max_chars and there is more than one, max_depth - 1 levels at most; then one final call.

    Each level is one grouped pass and one written table; documents that are short enough wait for the last call.
    """
    scratch = Scratch(items.sparkSession, "reduce")
    level = scratch.keep(items.select(key, F.col(order).cast("bigint").alias("at"), F.col(text).alias("text"), F.lit(1).alias("depth")), "items")
    for _ in range(cfg.max_depth - 1):
        sizes = level.groupBy(key).agg(F.sum(F.length("text")).alias("_chars"), F.count(F.lit(1)).alias("_n"))
        sized = level.join(sizes, key)
        long = sized.where((F.col("_chars") > cfg.max_chars) & (F.col("_n") > 1))
        if long.isEmpty():
            break
        placed = long.withColumn("at", F.floor((F.row_number().over(W.partitionBy(key).orderBy("at")) - 1) / cfg.batch).cast("bigint"))
        groups = _joined(placed, [key, "at"], "at")
        folded = called(groups, [key, "at", "depth"], "text", provider, "summary", pa.string()).select(key, "at", F.coalesce("summary", F.lit("")).alias("text"), (F.col("depth") + 1).alias("depth"))
        level = scratch.keep(sized.where(~((F.col("_chars") > cfg.max_chars) & (F.col("_n") > 1))).select(key, "at", "text", "depth").unionByName(folded), "level")
    last = _joined(level, [key], "at")
    return called(last, [key, "depth"], "text", provider, "summary", pa.string()).select(key, "summary", "depth", "status")


def _joined(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct(order if order not in keys else F.lit(0).alias("o"), "text")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n\n").alias("text"), F.max("depth").alias("depth"))


# -- local, deterministic providers ------------------------------------------------------------------


class HashEmbedding:
    """Vectors made of a text's digest."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def call(self, items: list[str]) -> list[list[float]]:
        out = []
        for text in items:
            raw = b"".join(hashlib.sha256(f"{k}:{text}".encode()).digest() for k in range(-(-self.dims // 32)))
            out.append([(b - 127.5) / 127.5 for b in raw[: self.dims]])
        return out


class FirstSentence:
    """A summary that is the text's first sentence, 200 characters at most."""

    def call(self, items: list[str]) -> list[str]:
        return [t.split(". ")[0][:200] for t in items]


class KeywordVerdict:
    """A JSON verdict on a caption, by plain words."""

    def call(self, items: list[str]) -> list[str]:
        def one(t: str) -> str:
            if "refuse" in t:
                raise Refused
            return json.dumps({"content_class": "photo" if t.strip() else "blank", "has_visual_content": bool(t.strip()), "confidence": min(1.0, len(t) / 100), "flag": "review" if "weapon" in t else "ok"})

        return [one(t) for t in items]


# -- batch jobs: requests out as JSON lines, results back by id ----------------------------------------


def batch_requests(rows: DataFrame, doc: str, page: str, text: str, most_chars: int = Summarise.max_chars) -> tuple[DataFrame, DataFrame]:
    """Request lines (custom_id, body) for a batch job, and the rows that are too long for it and go one by one."""
    custom = F.concat(F.lit("p"), F.col(doc).cast("string"), F.lit("_"), F.col(page).cast("string"))
    fits = F.length(text) <= most_chars
    return rows.where(fits).select(custom.alias("custom_id"), F.to_json(F.struct(F.col(text).alias("input"))).alias("body")), rows.where(~fits)


def batch_results(lines: DataFrame) -> DataFrame:
    """doc, page, result, status from result lines (value): JSON with custom_id and response or error; other lines are dropped."""
    v = F.col("value")
    parsed = lines.where(F.trim(v) != "").select(F.get_json_object(v, "$.custom_id").alias("id"), F.get_json_object(v, "$.response").alias("result"), F.get_json_object(v, "$.error.code").alias("code"))
    known = parsed.where(F.col("id").rlike(r"^p\d+_\d+$"))
    status = F.when(F.col("code") == "content_filter", "filtered").when(F.col("code").isNotNull() | F.col("result").isNull(), "error").otherwise("ok")
    return known.select(F.regexp_extract("id", r"^p(\d+)_", 1).cast("bigint").alias("doc"), F.regexp_extract("id", r"_(\d+)$", 1).cast("bigint").alias("page"), "result", status.alias("status"))


# States in which a batch job stays.
TERMINAL = ("completed", "failed", "expired", "cancelled")


class BatchFailed(Exception):
    """A batch job ended without output, or didn't end in time."""


def awaited(service, batch_id: str, interval: float = 30.0, most: float = 86_400.0, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep) -> dict:
    """Asks a service (get(batch_id) -> dict with status and output) until the job has ended; raises BatchFailed when `most` seconds are over or it ends without output."""
    deadline = None
    while True:
        job = service.get(batch_id)
        if job.get("status") in TERMINAL:
            if job["status"] != "completed" and not job.get("output"):
                raise BatchFailed(f"batch {batch_id} ended {job['status']} with no output")
            return job
        now = clock()
        deadline = now + most if deadline is None else deadline
        if now >= deadline:
            raise BatchFailed(f"batch {batch_id} is {job.get('status')} after {most:.0f} s")
        wait(interval)


def batch_rounds(rows: DataFrame, service, doc: str, page: str, text: str, out: str, rounds: int = 3, **waiting) -> DataFrame:
    """doc, page, result, status of rows sent as batch jobs, round by round, what failed again in the next one.

    service: submit(folder of request lines) -> batch id, get(batch id) -> dict with status and output, a folder of
    result lines.  Requests and results stay in files, so nothing but names passes through the driver.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "batch")
    todo, done = rows, None
    for n in range(rounds):
        requests, _ = batch_requests(todo, doc, page, text)
        requests.select(F.to_json(F.struct("custom_id", "body")).alias("value")).write.text(f"{out}/requests-{n}")
        job = awaited(service, service.submit(f"{out}/requests-{n}"), **waiting)
        found = scratch.keep(batch_results(spark.read.text(job["output"])), "round")
        sound = found.where("status <> 'error'")
        done = sound if done is None else done.unionByName(sound)
        failed = found.where("status = 'error'").select(F.col("doc").alias(doc), F.col("page").alias(page))
        if failed.isEmpty() or n + 1 == rounds:
            return done.unionByName(found.where("status = 'error'"))
        todo = scratch.keep(rows.join(failed, [doc, page], "left_semi"), "again")
    raise ValueError("rounds must be positive")


def passes(rows: DataFrame, key: str, run: Callable[[DataFrame], DataFrame], most: int = 3) -> DataFrame:
    """Runs the rows, then those that ended in an error again, until none does or `most` passes are over; each pass is written."""
    scratch = Scratch(rows.sparkSession, "passes")
    done = scratch.keep(run(rows), "pass")
    for _ in range(most - 1):
        failed = done.where("status = 'error'").select(key)
        if failed.isEmpty():
            break
        again = run(rows.join(failed, key, "left_semi"))
        done = scratch.keep(done.where("status <> 'error'").unionByName(again), "pass")
    return done


def page_state(flags: Column, status: Column) -> Column:
    """A page's flags after a run: stale marks go, a refusal or failure leaves its own."""
    clean = F.array_except(flags, F.array(F.lit("content_filtered"), F.lit("summary_error")))
    mark = F.when(status == "filtered", F.array(F.lit("content_filtered"))).when(status == "error", F.array(F.lit("summary_error"))).otherwise(F.array().cast("array<string>"))
    return F.concat(clean, mark)


def vision_chain(assets: DataFrame, keys: list[str], look: Callable[[], object], embed: Callable[[], object]) -> DataFrame:
    """keys, content_class, source (pregate or vision), verdict (JSON), status, vector for assets with caption_input and dark_coverage.

    Blank and black images are decided without a call; only the rest goes to the model, and only what it finds worth seeing is embedded.
    """
    from loomwork.operators.routing import pregate

    scratch = Scratch(assets.sparkSession, "vision")
    gated = assets.withColumn("content_class", pregate(F.col("dark_coverage")))
    none = F.lit(None)
    decided = gated.where("content_class IS NOT NULL").select(*keys, "content_class", F.lit("pregate").alias("source"), none.cast("string").alias("verdict"), F.lit("ok").alias("status"))
    seen = scratch.keep(called(gated.where("content_class IS NULL"), keys, "caption_input", look, "verdict", pa.string()), "seen")
    seen = seen.select(*keys, F.get_json_object("verdict", "$.content_class").alias("content_class"), F.lit("vision").alias("source"), "verdict", "status")
    worth = seen.where("status = 'ok' AND get_json_object(verdict, '$.has_visual_content') = 'true'")
    vectors = called(worth, keys, "verdict", embed, "vector", pa.list_(pa.float32())).select(*keys, "vector")
    return decided.unionByName(seen).join(vectors, keys, "left")
