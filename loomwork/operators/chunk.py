"""Parent and child chunks: sentences packed greedily to token targets, page by page.

Token: 4 characters.  A parent takes sentences until its target is reached and never more than its maximum;
children are packed inside their parent in the same way.  A sentence longer than the maximum is cut.
Packing is an ordered scan, so it runs in Arrow batches, one page a row; pages are independent and need no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import Chunk, Embed
from loomwork.functions import text as T

SENTENCE = re.compile(r"(?<=[.!?])\s+")
#: Those of the same breaks that aren't one plain space, with the sign before them, by which they are found faster.
WIDE_BREAK = re.compile(r"([.!?])(?:[^\S ]|\s\s)\s*")
#: Characters of children in an Arrow batch before it is sent on.
BATCH_CHARS = 1 << 20


def pack(parts: list[str], target: int, most: int) -> list[str]:
    """Greedy packing of parts to `target` tokens, `most` at most."""
    out, here, size = [], [], 0
    for part in parts:
        for piece in [part[k : k + 4 * most] for k in range(0, len(part), 4 * most)]:
            n = len(piece) + (1 if here else 0)
            if here and (size + n) // 4 > most or size // 4 >= target:
                out.append(" ".join(here))
                here, size, n = [], 0, len(piece)
            here.append(piece)
            size += n
    if here:
        out.append(" ".join(here))
    return out


def chunked_plainly(text: str | None, cfg: Chunk = Chunk()) -> list[tuple[str, list[str]]]:
    """chunked, sentence by sentence; for any targets."""
    sentences = [s for s in SENTENCE.split((text or "").strip()) if s]
    return [(p, pack([s for s in SENTENCE.split(p) if s], cfg.child_target, cfg.child_max)) for p in pack(sentences, cfg.parent_target, cfg.parent_max)]


def _cut(starts: list[int], ends: list[int], width: int) -> tuple[list[int], list[int]]:
    """Spans of `width` at most."""
    if max(map(sub, ends, starts)) <= width:
        return starts, ends
    cut = [(k, min(k + width, e)) for s, e in zip(starts, ends) for k in range(s, e, width)]
    return [s for s, _ in cut], [e for _, e in cut]


def _packed(starts: list[int], ends: list[int], first: int, last: int, target: int, most: int) -> Iterator[tuple[int, int]]:
    """pack over the spans from first to before last, as ranges of spans; each chunk's end is searched, not walked to."""
    while first < last:
        at = starts[first]
        full = bisect_left(ends, at + 4 * target, first, last) + 1
        over = bisect_left(ends, at + 4 * most + 4, first, last)
        end = max(first + 1, min(full, over, last))
        yield first, end
        first = end


def chunked(text: str | None, cfg: Chunk = Chunk()) -> list[tuple[str, list[str]]]:
    """Parents of a text with their children.

    Each break between sentences is made one space, so chunks are slices of the text.  A cut sentence's full piece
    reaches the target, so it ends its chunk, and no chunk holds two pieces of a sentence; a parent's sentences are
    therefore those of the text.
    """
    if not (0 < cfg.parent_target <= cfg.parent_max and 0 < cfg.child_target <= cfg.child_max):
        return chunked_plainly(text, cfg)
    text = (text or "").strip()
    if not text:
        return []
    text = WIDE_BREAK.sub(r"\1 ", text)
    bare = text.replace("! ", ". ").replace("? ", ". ").split(". ")  # without their signs and spaces
    starts = [0, *accumulate(map((2).__add__, map(len, bare)))]
    starts.pop()
    starts, ends = _cut(starts, [s - 1 for s in starts[1:]] + [len(text)], 4 * cfg.parent_max)
    child_starts, child_ends = _cut(starts, ends, 4 * cfg.child_max)
    out, child = [], 0
    for first, end in _packed(starts, ends, 0, len(starts), cfg.parent_target, cfg.parent_max):
        after = bisect_left(child_starts, ends[end - 1], child)
        children = [text[child_starts[i] : child_ends[j - 1]] for i, j in _packed(child_starts, child_ends, child, after, cfg.child_target, cfg.child_max)]
        out.append((text[starts[first] : ends[end - 1]], children))
        child = after
    return out


SCHEMA = "array<struct<text:string,children:array<string>>>"


def with_chunks(rows: DataFrame, keys: list[str], text: str = "content", cfg: Chunk = Chunk()) -> DataFrame:
    """keys and `parents`: the parents of each row's text with their children's texts."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = rows.select(*keys, F.col(text).alias("_text"))
    element = pa.struct([("text", pa.string()), ("children", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents = [[{"text": p, "children": c} for p, c in chunked(t.as_py(), cfg)] for t in batch.column(len(keys))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(parents, pa.list_(element))], names=[*keys, "parents"])

    return kept.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", parents {SCHEMA}")


def children_of(pages: DataFrame, document: str, case: str, dataset: str, page: str = "page_number", kind: str = "text") -> DataFrame:
    """One row for each child: its document, page, parent's and own place, texts, tokens and content sha.  Parents are numbered through a document by its pages."""
    packed = with_chunks(pages.where(F.trim("content") != ""), [document, case, dataset, page])
    rows = packed.select(document, case, dataset, page, F.posexplode("parents").alias("parent_in_page", "parent"))
    rows = rows.select(document, case, dataset, page, "parent_in_page", F.length("parent.text").alias("parent_chars"), F.posexplode("parent.children").alias("child_index", "text"))
    prefix = T.context_prefix(F.col(document).cast("string"), F.col(case).cast("string"), F.col(dataset).cast("string"), F.concat(F.lit("page "), F.col(page).cast("string")))
    return rows.select(
        document, case, dataset, page, "parent_in_page", "child_index", "text", prefix.alias("context_prefix"),
        F.floor(F.length("text") / 4).cast("bigint").alias("token_count"), F.floor(F.col("parent_chars") / 4).cast("bigint").alias("parent_tokens"),
        T.content_sha(F.lit(Embed.model), prefix, F.col("text")).alias("content_sha"), F.lit(kind).alias("chunk_kind"),
    )


PARTS = "array<struct<section:string,kind:string,page:bigint,start_ms:bigint,end_ms:bigint,speaker:string,text:string>>"
TOLD = {"section": pa.string(), "kind": pa.string(), "page": pa.int64(), "start_ms": pa.int64(), "end_ms": pa.int64(), "speaker": pa.string()}
PLACES = ("parent_index", "chunk_index", "parent_in_part", "child_index", "parent_chars")


def packed_batches(batches: Iterator[pa.RecordBatch], keys: list[str], cfg: Chunk = Chunk()) -> Iterator[pa.RecordBatch]:
    """Batches of keys and parts to batches of children, BATCH_CHARS and a parent long at most; what is told of a part is taken from the input's columns."""
    for batch in batches:
        lists = batch.column(len(keys))
        parts = lists.flatten()
        fields = dict(zip((f.name for f in parts.type), parts.flatten()))
        texts = fields["text"]

        def made() -> pa.RecordBatch:
            own = [batch.column(k).take(pa.array(row_of, pa.int64())) for k in range(len(keys))]
            of_part = [fields[c].take(pa.array(part_of, pa.int64())).cast(kind) for c, kind in TOLD.items()]
            return pa.RecordBatch.from_arrays([*own, *of_part, *(pa.array(c, pa.int64()) for c in places), pa.array(children, pa.string())], names=[*keys, *TOLD, *PLACES, "text"])

        row_of, part_of, children, places, chars = [], [], [], [[] for _ in PLACES], 0
        first = 0
        for row, n_parts in enumerate(pc.fill_null(pc.list_value_length(lists), 0).to_pylist()):
            parent_index = chunk_index = 0
            for at in range(first, first + n_parts):
                for p, (parent, own_children) in enumerate(chunked(texts[at].as_py(), cfg)):
                    n = len(own_children)
                    row_of.extend([row] * n)
                    part_of.extend([at] * n)
                    children.extend(own_children)
                    for column, values in zip(places, ([parent_index] * n, range(chunk_index, chunk_index + n), [p] * n, range(n), [len(parent)] * n)):
                        column.extend(values)
                    chunk_index += n
                    parent_index += 1
                    chars += len(parent)
                    if chars >= BATCH_CHARS:
                        yield made()
                        row_of, part_of, children, places, chars = [], [], [], [[] for _ in PLACES], 0
            first += n_parts
        if children:
            yield made()


def pack_documents(rows: DataFrame, keys: list[str], cfg: Chunk = Chunk()) -> DataFrame:
    """Children of rows that hold whole documents: keys, and parts (PARTS) in order.

    One row for each child: keys, section, chunk_kind, page, start_ms, end_ms, speaker, parent_index and chunk_index
    (through the document), parent_in_part, child_index, text, parent_chars.  Numbering is done while packing, so
    texts aren't shuffled for it.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed_batches(batches, keys, cfg)

    schema = [f"`{k}` {kinds[k]}" for k in keys] + ["section string, kind string, page bigint, start_ms bigint, end_ms bigint, speaker string"] + [f"{c} bigint" for c in PLACES] + ["text string"]
    return rows.select(*keys, F.col("parts").cast(PARTS).alias("parts")).mapInArrow(run, ", ".join(schema)).withColumnRenamed("kind", "chunk_kind")


def part(text: Column, section: Column, kind: str | Column = "text", page: Column | None = None, start_ms: Column | None = None, end_ms: Column | None = None, speaker: Column | None = None) -> Column:
    """A part of a document for pack_documents."""
    none = F.lit(None)
    kind = F.lit(kind) if isinstance(kind, str) else kind
    values = (section.cast("string"), kind, *((none if c is None else c).cast("bigint") for c in (page, start_ms, end_ms)), (none if speaker is None else speaker).cast("string"), text)
    return F.struct(*(v.alias(n) for n, v in zip(("section", "kind", "page", "start_ms", "end_ms", "speaker", "text"), values)))


def with_identity(children: DataFrame, document: str, case: str, dataset: str) -> DataFrame:
    """Children with context_prefix, token_count, parent_tokens and content_sha."""
    prefix = T.context_prefix(F.col(document).cast("string"), F.col(case).cast("string"), F.col(dataset).cast("string"), F.col("section"))
    rows = children.withColumn("context_prefix", prefix)
    return rows.select(
        "*", F.floor(F.length("text") / 4).cast("bigint").alias("token_count"), F.floor(F.col("parent_chars") / 4).cast("bigint").alias("parent_tokens"),
        T.content_sha(F.lit(Embed.model), F.col("context_prefix"), F.col("text")).alias("content_sha"),
    )


def chunk_documents(docs: DataFrame, pages: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Children of all documents that may be chunked, and one result row for each document.

    docs: doc_id, status, n_pages, chunked, document_name, case_key, dataset_key; pages: doc_id, page_number, content.
    Results: doc_id, action (no_sidecar, skipped_status, no_stage1, skipped_done, error, chunked), parents, children,
    skipped_pages (white space only), empty.
    """
    action = F.when(F.col("status").isNull(), "no_sidecar").when(F.col("status") != "ok", "skipped_status").when(F.coalesce("n_pages", F.lit(0)) == 0, "no_stage1")
    if not force:
        action = action.when(F.coalesce("chunked", F.lit(False)), "skipped_done")
    unnamed = F.col("document_name").isNull() | F.col("case_key").isNull() | F.col("dataset_key").isNull()
    gated = docs.withColumn("action", action.when(unnamed, "error").otherwise("chunked"))
    run = gated.where("action = 'chunked'").select("doc_id", "document_name", "case_key", "dataset_key")
    own = pages.join(run, "doc_id")
    blank = F.regexp_replace(F.coalesce("content", F.lit("")), r"(?U)\s+", "") == ""
    children = children_of(own.where(~blank), "document_name", "case_key", "dataset_key")
    made = children.groupBy("document_name").agg(F.count(F.lit(1)).alias("children"), F.count_if(F.col("child_index") == 0).alias("parents"))
    skipped = own.groupBy("doc_id").agg(F.count_if(blank).alias("skipped_pages"))
    rows = gated.join(made, "document_name", "left").join(skipped, "doc_id", "left")
    count = lambda c: F.when(F.col("action") == "chunked", F.coalesce(c, F.lit(0))).otherwise(0).alias(c)
    return children, rows.select("doc_id", "action", count("parents"), count("children"), count("skipped_pages"), ((F.col("action") == "chunked") & F.col("children").isNull()).alias("empty"))
