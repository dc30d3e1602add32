"""Language identification by error-correcting output codes.

Method: every language has a codeword of bits; for each bit a binary classifier over hashed character
n-grams (byte bigrams and trigrams of the folded text) tells the languages with a one from those with a
zero; decoding weighs each bit by its loss and takes the nearest codeword.  A small gap between the two
nearest codewords marks the result as ambiguous.

Training counts n-grams by language over a bounded sample: PER_LANGUAGE documents of each language at
most, chosen by a hash of their id.  Texts are used whole, in training and in prediction.  The model is
langs x 2^14 counts, whatever the input; more than MAX_LANGUAGES languages are an error.

Defined results: a text that is null or has no letter is `und` with score 0; so is every text when there
is nothing to learn from.  Rows without an id are predicted but never learned from.  Repeated rows get
equal results.  Columns other than id, text and language are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the documents of one language that training reads.
PER_LANGUAGE = 4000
BITS = 13
SIZE = 2 << BITS
#: Bound of the languages that are learned.
MAX_LANGUAGES = 1000
#: Bytes of a text whose n-grams are hashed at once, and texts that are decoded at once.
PIECE, ROWS = 1 << 18, 32


def _folded() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    table[128:] = np.arange(128, 256)
    for c in range(26):
        table[65 + c] = table[97 + c] = 97 + c
    return table


FOLD = _folded()


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed bigrams (first half) and trigrams (second half) of the whole text; runs of other signs are one space."""
    out = np.zeros(SIZE, np.float32)
    whole = FOLD[np.frombuffer(b" " + text.encode("utf-8", "surrogatepass") + b" ", np.uint8)]
    gap = whole == 32
    whole = whole[np.concatenate(([True], ~(gap[1:] & gap[:-1])))]
    for low in range(0, len(whole) - 1, PIECE):
        # PIECE bigrams and trigrams start in a piece; the bytes beyond it belong to the last ones.
        b = whole[low : low + PIECE + 2].astype(np.uint32)
        two = b[:-1] << 8 | b[1:]
        if len(b) > 2:
            three = two[:-1] << 8 | b[2:]
            out[1 << BITS :] += np.bincount((three * np.uint32(2246822519)) >> np.uint32(32 - BITS), minlength=1 << BITS)
        two = two[:PIECE]
        out[: 1 << BITS] += np.bincount((two * np.uint32(2654435769)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return out


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n x bits of +1 and -1: the exhaustive code for few languages, else a random dense code with distant rows."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 6:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.float32).T.copy()
    r = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(200):
        code = r.choice(np.array([1, -1], np.float32), (n, bits))
        least = int(min((bits - code @ code.T)[np.triu_indices(n, 1)]) / 2)
        if least > far and (np.abs(code.sum(0)) < n).all():
            best, far = code, least
    return best


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, smooth: float = 0.5):
        self.langs, self.code = langs, codewords(len(langs))
        weights = np.zeros((SIZE, self.code.shape[1]))
        for half in (slice(0, 1 << BITS), slice(1 << BITS, SIZE)):
            c = counts[:, half] + smooth
            share = c / c.sum(axis=1, keepdims=True)
            for k, bit in enumerate(self.code.T):
                if (bit < 0).any():
                    weights[half, k] = np.log(share[bit > 0].mean(0)) - np.log(share[bit < 0].mean(0))
        self.weights = weights.astype(np.float32)

    def decode(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's index, score and gap to the next, for rows of gram counts."""
        n = grams.sum(axis=1, keepdims=True)
        margin = (grams @ self.weights) / np.maximum(n, 1)
        margin = np.clip(margin * np.minimum(20, 2 * np.sqrt(n)), -8, 8)
        loss = np.log1p(np.exp(-margin[:, None, :] * self.code[None])).sum(axis=2)
        like = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        like /= like.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        top = np.sort(like, axis=1)
        gap = top[:, -1] - top[:, -2] if like.shape[1] > 1 else np.ones(len(like))
        return best, top[:, -1], gap


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def identify(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and gap to the next language of each text."""
    lang, score, gap = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    at = [k for k, t in enumerate(texts) if t and model and LETTER.search(t)]
    if at:
        best, score[at], gap[at] = model.decode(np.stack([gram_counts(texts[k]) for k in at]))
        for k, i in zip(at, best):
            lang[k] = model.langs[i]
    return lang, score, gap


LETTER = regex.compile(r"\p{L}")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


class LanguageId:
    """per_language: bound of the training documents of a language; least_gap: below it a result is ambiguous."""

    def __init__(self, per_language: int = PER_LANGUAGE, least_gap: float = 0.2):
        self.per_language, self.least_gap = per_language, least_gap

    def fit(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
        sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
        if not sizes:
            return None
        if len(sizes) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        langs = sorted(sizes)
        share = F.create_map(*[F.lit(x) for l in langs for x in (l, min(1.0, self.per_language / sizes[l]))])
        sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[str, np.ndarray] = {}
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    grams = gram_counts(text.as_py() or "")
                    total[lang] = total[lang] + grams if lang in total else grams.astype(np.float64)
            for lang, grams in total.items():
                at = grams.nonzero()[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(grams[at].astype(np.int64))], names=["lang", "gram", "n"])

        counts = np.zeros((len(langs), SIZE))
        found = sample.mapInArrow(run, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        for r in found.toLocalIterator():
            counts[langs.index(r["lang"]), r["gram"]] = r["n"]
        return Model(langs, counts)

    def predict(self, model: Model | None, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, held_out, lang_pred, score, ambiguous: one row for each row of docs."""
        docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        least_gap = self.least_gap

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in pieces(batches):
                lang, score, gap = identify(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(gap < least_gap)], names=["doc_id", "lang_pred", "score", "ambiguous"])

        found = docs.mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")
        return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")

    def keep(self, model: Model | None, docs: DataFrame) -> DataFrame:
        """The rows of docs, all columns, that have a letter; where lang is null it is filled in (und without a model)."""
        text_at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in pieces(batches):
                texts = part.column(text_at).to_pylist()
                lang, _, _ = identify(model, texts)
                columns = list(part.columns)
                columns[lang_at] = pa.array([a if a is not None else b for a, b in zip(columns[lang_at].to_pylist(), lang)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names).filter(pa.array([bool(t and LETTER.search(t)) for t in texts], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    def apply(self, docs: DataFrame) -> DataFrame:
        return self.predict(self.fit(docs), docs)
