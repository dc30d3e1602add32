"""The corpus pipeline: toxicity, language, near duplicates, mixing, encoding.  Part of subpackage llm.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame;
all but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm.byte_bpe import ByteBpe
from loomwork.llm.language_id import LanguageId
from loomwork.llm.near_dedup import NearDuplicates
from loomwork.llm.source_mix import SourceMix
from loomwork.llm.toxicity import Toxicity
from loomwork.storage import Scratch, lies_in_files, read_table, spread, with_written_place


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; rows without an id or text are kept."""
    op = Toxicity(threshold=0.7)
    lexicon = op.fit(docs, read_table(spark, sf_dir, "labels"))
    return op.keep(lexicon, docs)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text or no letter) go; a missing language is filled in."""
    op = LanguageId()
    return op.keep(op.fit(docs), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id; of repeated rows one stays.

    Documents are held against the ids that go or repeat, which are fewer than those that stay; while they are few, no text is shuffled.
    """
    scratch = Scratch(spark, "near-duplicates")
    by = NearDuplicates(words=5, percent=80, bands=30).apply(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    marked = scratch.keep(by.where("NOT kept OR n > 1").select(F.col("doc_id").alias("__id"), "kept"), "marked")
    alone = docs.join(marked, docs["doc_id"] == marked["__id"], "left_anti")
    again = marked.where("kept").select("__id")
    return alone.unionByName(docs.join(again, docs["doc_id"] == again["__id"], "left_semi").dropDuplicates(["doc_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes stay, in the order of its schedule; those that it takes a second time are there twice; the one that the end of a source's target cuts is taken whole."""
    mix = SourceMix()
    copies, slots = mix.copies(docs)
    places = copies.select(F.col("doc_id").alias("__mixed_id"), F.struct("slot", "start").alias("__place"))
    placed = docs.join(places, docs["doc_id"].eqNullSafe(places["__mixed_id"])).select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "__place.slot", "__place.start")
    return mix.in_order(placed, slots).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_chars, place: from 0, where the row stands in the order in which docs were written, that of the mix; rows are in that order.

    Only digests are dealt out by place, no texts.
    """
    table = docs if lies_in_files(docs) else Scratch(spark, "encode").keep(docs)
    placed, files, total = with_written_place(table)
    digests = ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).digests(placed, also=("__file", "__row"))
    rows = digests.join(files, "__file").withColumn("place", F.col("before") + F.col("__row")).drop("__file", "__row", "before")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(parts, F.floor(F.col("place") * parts / max(1, total)).cast("int")).sortWithinPartitions("place")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: The stages' methods (learned models, minimum hashes, merges) can't be expressed in SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read_table(spark, sf_dir, "documents"), "doc_id")
    scratch, before = Scratch(spark, "pipeline"), ()
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)
        before = (name,)
    return STAGES[-1][1](spark, docs, sf_dir)
