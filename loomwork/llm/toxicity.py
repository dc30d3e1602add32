"""Toxicity scores from a weighted lexicon.

Method: texts are folded (case, accents, look-alike letters, digits and signs that stand for letters),
the lexicon's terms are found by an Aho-Corasick automaton in one pass over the whole text, occurrences
inside an exception phrase don't count, and the sum of the weights is normalised by the length of the text.
A logistic curve over the sum and the normalised sum gives a score between 0 and 1.

Digits that can stand for a letter, or end a word, are read in every way: 2, 6, 8 and 9 as a gap, as
z, g, b and g, and 6 also as b; a term counts where any reading has it.  Letters of other scripts stay
letters, so terms in them are learned and found.

Terms (whole words, and stems that start words) and their weights are learned from labelled rows, as is
the curve.  A term's documents among the toxic and the clean ones of the sample decide alone whether it is
taken up; there is no bound on their number but the sample.  Training reads a bounded sample, MAX_LABELLED
rows (in expectation, 2 * MAX_LABELLED at most) chosen by a hash of their id.  Labels of rows in the
held-out fold are never read.  Exception phrases are a parameter.

Defined results: null and empty texts get the score of a text without any term; without labelled rows
every score is 0.  Rows without an id are scored but never learned from.  Repeated rows get equal scores;
labels that contradict each other are averaged.  Columns other than those named are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.storage import Scratch

#: Bound of the labelled rows that training reads.
MAX_LABELLED = 12_000
#: Documents that a term must be in to be tried.
LEAST = 5
#: Lengths of the stems that are tried beside whole words.
STEMS = range(4, 9)
#: Bound of the terms that a worker counts before it passes its counts on.
COUNTED = 400_000

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKE = str.maketrans("авекмнорстухіјѕԁɡһԛԝѵαβεηικνορτυχϲıſ", "abekmhopctyxijsdghqwvabenikvoptuxcis")
#: Digits and signs written for letters; 1, ! and l all become i.
SIGN = str.maketrans("013457@$!", "oieastasi")
SIGN_IN_WORD = re.compile(r"[013457@$!]{1,2}(?=[a-z])|(?<=[a-z])[01345@](?![\w@$!])")
#: Digits that may be letters or numbers, in each further reading, where they touch a letter.
UNSURE = re.compile(r"(?<=[^\W\d_])[2689]{1,2}|[2689]{1,2}(?=[^\W\d_])")
READINGS = (str.maketrans("2689", "zgbg"), str.maketrans("2689", "zbbg"))
NOT_ASCII = re.compile(r"[^\x00-\x7f]+")
#: What isn't a letter; the second, slower one for texts with marks (vowel signs and the like), which are parts of words, or with signs that count as digits.
NO_LETTER, NO_LETTER_OR_MARK = re.compile(r"[\W\d_]"), regex.compile(r"[^\p{L}\p{M}]")

EXCEPTIONS = ("trash can", "trash bin", "clown fish", "circus clown", "pathetic fallacy", "pond scum")


def _latin() -> dict[int, str]:
    """Every other character that decomposes to one of a-z after lower-casing (accents, wide and styled letters)."""
    out = {}
    for c in [*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0x2100, 0x2150), *range(0x24B6, 0x24EA), *range(0xFF21, 0xFF5B), *range(0x1D400, 0x1D6A4)]:
        base = unicodedata.normalize("NFKD", chr(c)).lower()[:1]
        if "a" <= base <= "z":
            out[c] = base
    return out


TO_LATIN = _latin() | LOOK_ALIKE | dict.fromkeys(range(0x300, 0x370), "") | dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF), "")
LETTERS = bytes(c if 97 <= c <= 122 else 32 for c in range(256)).replace(b"l", b"i")


def _letters(t: str) -> str:
    """Words of letters (l is written i) between single or repeated spaces, with a space at both ends."""
    t = SIGN_IN_WORD.sub(lambda m: m[0].translate(SIGN), t)
    if not t.isascii():
        others = set("".join(NOT_ASCII.findall(t)))
        marks = any(unicodedata.category(c)[0] == "M" or c.isalnum() and not c.isalpha() for c in others)
        if marks or any(c.isalpha() for c in others):
            return " " + (NO_LETTER_OR_MARK if marks else NO_LETTER).sub(" ", t).replace("l", "i") + " "
    return " " + t.encode("ascii", "replace").translate(LETTERS).decode("ascii") + " "


def readings(text: str | None) -> list[str]:
    """The folded text, and where digits may stand for letters its other readings, all of one length."""
    t = (text or "").lower()
    if not t.isascii():
        t = t.translate(TO_LATIN)
    if not ("2" in t or "6" in t or "8" in t or "9" in t) or not UNSURE.search(t):
        return [_letters(t)]
    return list(dict.fromkeys([_letters(t), *(_letters(UNSURE.sub(lambda m: m[0].translate(r), t)) for r in READINGS)]))


def fold(text: str | None) -> str:
    return readings(text)[0]


def terms(read: list[str]) -> set[str]:
    """Candidates for the lexicon in any reading: ` word ` and ` stem`."""
    words = {w for folded in read for w in folded.split()}
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:k]}" for w in words for k in STEMS if len(w) >= k}


class Lexicon:
    def __init__(self, weights: dict[str, float], curve: tuple[float, float, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights, self.curve, self.exceptions = weights, curve, exceptions

    def automaton(self) -> ahocorasick.Automaton | None:
        tree = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            tree.add_word(term, (len(term), weight))
        for phrase in self.exceptions if self.weights else ():
            phrase = fold(phrase)
            tree.add_word(phrase, (len(phrase), None))
        if not len(tree):
            return None
        tree.make_automaton()
        return tree

    def features(self, tree: ahocorasick.Automaton | None, text: str | None) -> tuple[float, float, int]:
        """Logarithms of the sum of the weights and of the sum by length; number of occurrences."""
        read = readings(text)
        if not tree:
            return 0.0, 0.0, 0
        hits = []
        for folded in read:
            found, free = [], []
            for end, (n, weight) in tree.iter(folded):
                (free if weight is None else found).append((end - n + 1, end, weight or 0.0))
            if free and found:
                free.sort()
                starts = [a for a, _, _ in free]
                reach = list(accumulate((b for _, b, _ in free), max))  # how far the exceptions that start up to here go
                found = [h for h in found if not ((k := bisect_right(starts, h[0])) and h[1] <= reach[k - 1])]
            hits += found
        if not hits:
            return 0.0, 0.0, 0
        best: dict[int, float] = {}
        for a, _, w in hits:  # a word counts once, with its heaviest term
            best[a] = max(w, best.get(a, 0.0))
        total = sum(best.values())
        return float(np.log1p(total)), float(np.log1p(1000 * total / (read[0].count(" ") + 10))), len(best)

    def score(self, a: float, b: float) -> float:
        if not self.weights:
            return 0.0
        c = self.curve
        return float(1 / (1 + np.exp(-(c[0] + c[1] * a + c[2] * b))))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


#: Least logarithm of a term's odds, and of how unlikely its documents are by chance beyond the number of terms tried.
LEAST_ODDS, LEAST_GAIN = 3.0, 2.3


def choose(rows: list[tuple[str, int, int]], toxic: int, clean: int, tried: int) -> dict[str, float]:
    """Weights of the terms whose documents are toxic far more often than chance allows among as many candidates as were tried."""
    if not toxic or not clean:
        return {}
    prior = toxic / (toxic + clean)
    kept: dict[str, tuple[int, float]] = {}
    for term, a, c in rows:
        odds = float(np.log((a + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        p = a / (a + c)
        gain = a * np.log(p / prior) + (c * np.log((1 - p) / (1 - prior)) if c else 0.0)
        if p > prior and odds >= LEAST_ODDS and gain >= np.log(max(tried, 1)) + LEAST_GAIN:
            kept[term] = (a, odds)
    # A stem goes if one longer by a letter, or the whole word, is in nearly all of its toxic documents.
    longer = {t[:-1]: a for t, (a, _) in sorted(kept.items(), key=lambda x: x[1][0])}
    return {t: odds for t, (a, odds) in kept.items() if longer.get(t, 0) < 0.95 * a}


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a weak penalty, by Newton's method; x: rows of two features."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 0.05 * w
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 0.05 * np.eye(3), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


class Toxicity:
    """threshold: scores from it on are predicted toxic; exceptions: phrases in which terms don't count."""

    def __init__(self, threshold: float = 0.7, max_labelled: int = MAX_LABELLED, exceptions: tuple[str, ...] = EXCEPTIONS):
        self.threshold, self.max_labelled, self.exceptions = threshold, max_labelled, exceptions

    def fit(self, docs: DataFrame, labels: DataFrame) -> Lexicon:
        """docs: doc_id, text; labels: doc_id, toxic."""
        known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("double").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        known = known.where(~held_out(F.col("doc_id")))
        n = known.count()
        part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < min(1.0, self.max_labelled / max(1, n)) * (1 << 20)
        known = known.where(part).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).alias("toxic"))
        scratch = Scratch(docs.sparkSession, "toxicity")
        known = scratch.keep(known, "known")
        if known.count() > 2 * self.max_labelled:  # ids whose hashes crowd
            raise ValueError("the sample of labelled rows is more than twice its bound")
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        # The sample's ids have been counted, so sending them to all tasks is safe; rows that repeat count once.
        sample = scratch.keep(texts.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id", "text"]).select("text", "toxic"), "sample")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[str, list[int]] = {}

            def counted() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(seen.keys(), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], names=["term", "a", "c"]
                )

            for batch in batches:
                for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                    for term in terms(readings(text.as_py())):
                        seen.setdefault(term, [0, 0])[toxic] += 1
                    if len(seen) > COUNTED:
                        yield counted()
                        seen.clear()
            yield counted()

        sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        counts = scratch.keep(
            sample.mapInArrow(count, "term string, a bigint, c bigint").groupBy("term").agg(F.sum("a").alias("a"), F.sum("c").alias("c")).where(f"a + c >= {LEAST}"), "counts"
        )
        toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
        # The same odds as choose() takes, so that only terms that stand a chance come to the driver.
        odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
        found = counts.where(odds >= LEAST_ODDS - 1e-6).where(f"a >= {LEAST}").orderBy("term").collect()
        weights = choose([tuple(r) for r in found], toxic, clean, counts.count())
        draft = Lexicon(weights, (0.0, 0.0, 0.0), self.exceptions)
        rows = self._features(draft, sample, "toxic", "boolean").select("a", "b", "key").collect()
        x, y = np.array([(r["a"], r["b"]) for r in rows] or np.zeros((0, 2))), np.array([float(r["key"]) for r in rows])
        scratch.drop("known", "sample", "counts")
        return Lexicon(weights, fit_curve(x, y) if weights else (0.0, 0.0, 0.0), self.exceptions)

    def _features(self, lexicon: Lexicon, texts: DataFrame, key: str, kind: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = lexicon.automaton()
            for batch in batches:
                found = [lexicon.features(tree, t.as_py()) for t in batch.column(1)]
                scores = [lexicon.score(a, b) for a, b, _ in found]
                a, b, n = (list(x) for x in zip(*found)) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(a, pa.float64()), pa.array(b, pa.float64()), pa.array(n, pa.int64()), pa.array(scores, pa.float64())], names=["key", "a", "b", "n_hits", "score"]
                )

        return texts.select(key, "text").mapInArrow(run, f"key {kind}, a double, b double, n_hits bigint, score double")

    def score(self, lexicon: Lexicon, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, score, predicted, n_hits: one row for each row of docs."""
        docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        found = self._features(lexicon, docs, "doc_id", "bigint").withColumnRenamed("key", "doc_id")
        return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= self.threshold).cast("int").alias("predicted"), "n_hits")

    def keep(self, lexicon: Lexicon, docs: DataFrame) -> DataFrame:
        """The rows of docs, all columns, whose whole text scores below the threshold."""
        at, threshold = docs.columns.index("text"), self.threshold

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = lexicon.automaton()
            for batch in batches:
                good = [lexicon.score(*lexicon.features(tree, t.as_py())[:2]) < threshold for t in batch.column(at)]
                yield batch.filter(pa.array(good, pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    def apply(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        return self.score(self.fit(docs, labels), docs)
