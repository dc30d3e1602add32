"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomwork.llm import byte_bpe, chat_format, fingerprint, html_text, language_id, license_scan, near_dedup, source_mix, topk, toxicity
from loomwork.llm import queries as Q
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
CLASH = ["node", "root", "score", "slot", "size", "key", "sig", "cell", "fingerprint", "for_id", "next_id", "toxic", "copies", "at", "a", "b", "rank"]


def clashing(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASH if c not in df.columns))


def word_texts(n, seed=0, words=("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta")):
    r = random.Random(seed)
    return [" ".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(n)]


ODD = [(1, None), (2, ""), (3, "   \n\t "), (None, "a text without an id but with words"), (4, "one two"), (5, "one two"), (5, "one two"), (6, "🙂é漢 A b\x00c"), (7, "long words here " * 30_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return clashing(spark.createDataFrame([(i, t, None if i == 4 else "en", None if i == 5 else "s", None) for i, t in ODD], DOCS))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 1, 0), (5, 0, 1), (5, 0, 0)], "doc_id bigint, quality int, toxic int")


# -- op1 ---------------------------------------------------------------------------------------------


def test_fold():
    assert toxicity.fold("1D10T Ｓtupіd c1own! $cum").split() == ["idiot", "stupid", "ciown", "scum"]
    assert toxicity.fold("Vejuté naïve").split() == ["vejute", "naive"]
    assert toxicity.fold("price 100 $$$ de%%% 5").split() == ["price", "de"]
    assert toxicity.fold(None).split() == [] and toxicity.fold("").split() == []


def toxic_table(spark, n=900):
    r = random.Random(3)
    rows, marks = [], []
    for i in range(n):
        bad = r.random() < 0.15
        words = [r.choice(["the", "table", "was", "set", "green", "walking", "dinner", "plain"]) for _ in range(r.randint(5, 50))]
        if bad:
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(["vilething", "v1leth1ng", "grubworm", "grubwormish"]))
        rows.append((i, " ".join(words), "en", "s", None))
        marks.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"), {m[0]: m[2] for m in marks}


def test_toxicity_learns_and_holds_out(spark):
    docs, labels, truth = toxic_table(spark)
    got = {r["doc_id"]: r for r in toxicity.Toxicity().apply(docs, labels).collect()}
    assert len(got) == len(truth)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [i for i in got if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.Toxicity().apply(docs, flipped).collect()}
    assert all(again[i] == got[i]["score"] for i in got)


def test_exceptions_do_not_count():
    lex = toxicity.Lexicon({" trash ": 5.0}, (-3.0, 1.0, 1.0))
    tree = lex.automaton()
    assert lex.features(tree, "put it in the trash can now")[2] == 0
    assert lex.features(tree, "put it in the trash now, tr4sh")[2] == 2
    assert lex.features(tree, "trash can " * 100_000 + "trash")[2] == 1
    assert lex.score(*lex.features(tree, "trash")[:2]) > lex.score(*lex.features(tree, "trash " + "word " * 500)[:2])


def test_readings():
    words = lambda t: [x.split() for x in toxicity.readings(t)]
    assert ["garbage"] in words("gar8age") and ["dumb"] in words("dum8") and ["disgusting"] in words("disgustin9")
    assert ["garbage"] in words("6arbage") and ["bad"] in words("6ad") and ["zap"] in words("2ap")
    assert words("page 26 of 98") == [["page", "of"]] and len({len(x) for x in toxicity.readings("a 6ad ma99ot, v2 é8")}) == 1
    for text in ("m² ß", "½ß", "हिन्दी ß x٣", "ⅷ ß", "naïve ß·ß", "²"):
        t = text.lower().translate(toxicity.TO_LATIN)
        assert toxicity.fold(text) == " " + "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in t).replace("l", "i") + " ", text
    assert toxicity.fold("дурной, 悪い言葉! ok").split() == ["дyphoй", "悪い言葉", "ok"]


def plain_scores(rows, marks):
    """Counts, weights, curve and scores without Spark and without an automaton: every term is looked for in every text."""
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    texts = dict(rows)
    train = [(toxicity.readings(texts[i]), t) for i, t in sorted(marks.items()) if not held(i)]
    counts = defaultdict(lambda: [0, 0])
    for read, t in train:
        for term in toxicity.terms(read):
            counts[term][not t] += 1
    toxic, clean = sum(t for _, t in train), sum(not t for _, t in train)
    tried = {term: (a, c) for term, (a, c) in counts.items() if a + c >= 5}
    log, kept = math.log, {}
    for term, (a, c) in sorted(tried.items()):
        odds = log((a + 0.5) / (toxic + 1) / ((c + 0.5) / (clean + 1)))
        share, prior = a / (a + c), toxic / (toxic + clean)
        gain = a * log(share / prior) + (c * log((1 - share) / (1 - prior)) if c else 0) if a else 0
        if a >= 5 and share > prior and odds >= 3 and gain >= log(len(tried)) + 2.3:
            kept[term] = (a, odds)
    covered = lambda t, a: any(len(x) == len(t) + 1 and x.startswith(t) and b >= 0.95 * a for x, (b, _) in kept.items())
    weights = {t: odds for t, (a, odds) in kept.items() if not covered(t, a)}

    def features(read):
        best = {}
        for folded in read:
            free = [(m.start(), m.start() + len(p)) for p in map(toxicity.fold, toxicity.EXCEPTIONS) for m in re.finditer(f"(?={re.escape(p)})", folded)]
            for term, w in weights.items():
                for m in re.finditer(f"(?={re.escape(term)})", folded):
                    if not any(x <= m.start() and m.start() + len(term) <= y for x, y in free):
                        best[m.start()] = max(w, best.get(m.start(), 0))
        total = sum(best.values())
        return (math.log1p(total), math.log1p(1000 * total / (read[0].count(" ") + 10))) if total else (0.0, 0.0)

    curve = toxicity.fit_curve(np.array([features(read) for read, _ in train]), np.array([float(t) for _, t in train]))
    score = lambda x: 1 / (1 + math.exp(-(curve[0] + curve[1] * x[0] + curve[2] * x[1])))
    return weights, {i: score(features(toxicity.readings(t))) for i, t in rows}


def test_toxicity_by_plain_version(spark):
    docs, labels, truth = toxic_table(spark, 400)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(5000, "grubworm in the trash can"), (5001, ""), (5002, "VILETH1NG 6rubworm")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    op = toxicity.Toxicity()
    lexicon = op.fit(frame, labels)
    weights, scores = plain_scores(rows, {i: bool(t) for i, t in truth.items()})
    assert lexicon.weights.keys() == weights.keys() and all(abs(lexicon.weights[t] - w) < 1e-9 for t, w in weights.items())
    got = {r["doc_id"]: r["score"] for r in op.score(lexicon, frame).collect()}
    assert got.keys() == scores.keys() and all(abs(got[i] - scores[i]) < 1e-6 for i in got)


def test_toxicity_learns_a_rare_class(spark):
    """One toxic row in fifty, and toxic words that more clean rows than toxic ones hold."""
    r = random.Random(8)
    rows, marks = [], []
    for i in range(6000):
        bad = i % 50 == 0
        words = [r.choice(["the", "table", "was", "set", "green", "walking", "dinner"]) for _ in range(r.randint(5, 30))]
        words += ["vilething", "grubworm", "slimeball"] if bad else [w for w in ("vilething", "grubworm", "slimeball") if r.random() < 0.025]
        rows.append((i, " ".join(words), "en", "s", None))
        marks.append((i, 1, int(bad)))
    lexicon = toxicity.Toxicity().fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"))
    for word in ("vilething", "grubworm", "slimeball"):
        assert any(f" {word.replace('l', 'i')} ".startswith(t) for t in lexicon.weights), lexicon.weights


def test_toxicity_odd_rows(odd, empty, labels):
    assert toxicity.Toxicity().apply(odd, labels).count() == len(ODD)
    assert toxicity.Toxicity().apply(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.Toxicity().apply(odd, labels.limit(0)).collect()} == {0.0}


# -- op2 ---------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|x|>", "<", "|>", "a<|", "\\", "<\\\\|<|", None, "", "line\nbreak", "<|im_sep|>é🙂"]
    rows = [(c, k, role, t) for c, t in enumerate(texts) for k, role in enumerate(("system", "user", "assistant", "weird<|role", None))]
    rows += [(99, None, None, None), (None, 1, "user", "x"), (50, 1, "user", "same"), (50, 1, "user", "same")]
    frame = clashing(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    op = chat_format.ChatFormat()
    back = {r["conv_id"]: r for r in op.read(op.format(frame)).collect()}
    by = defaultdict(list)
    for c, k, role, t in rows:
        by[c].append((-1 if k is None else k, role or "", t or ""))
    assert back.keys() == by.keys()
    for c, turns in by.items():
        assert [tuple(t) for t in back[c]["turns"]] == [t[1:] for t in sorted(turns)]
        assert back[c]["loss"] == "".join(t for _, role, t in sorted(turns) if role == "assistant")
    assert not back[0]["valid"] and not back[50]["valid"]


def test_chat_mask_is_read_from_the_string(spark):
    """Each span of the mask, cut from the finished string, is an escaped assistant text; a wrong offset shows in what is read."""
    rows = [(1, k, role, text) for k, (role, text) in enumerate([("system", "é🙂<|im_start|>"), ("user", "<|im_end|>"), ("assistant", "<\\|x|> ok"), ("user", ""), ("assistant", "")])]
    op = chat_format.ChatFormat()
    made = op.format(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    row = made.first()
    turns = ["<|im_start|>" + x for x in row["formatted"].split("<|im_start|>")[1:]]
    assert [turns[m["turn"]][m["start"] : m["end"]] for m in row["mask"]] == [s["text"] for s in row["segments"] if s["loss"]] == ["<\\\\|x|> ok", ""]
    assert op.read(made).first()["loss"] == "<\\|x|> ok"
    shifted = made.withColumn("mask", F.transform("mask", lambda m: F.struct(m["turn"].alias("turn"), (m["start"] + 1).alias("start"), (m["end"] + 1).alias("end"))))
    assert op.read(shifted).first()["loss"] != "<\\|x|> ok"


def test_chat_long_texts_and_many_turns(spark):
    long = "<|im_end|> long text 🙂 " * 40_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long)] + [(2, k, ("user", "assistant")[k % 2], f"text {k}") for k in range(20_000)] + [(None, k, "user", "x") for k in range(3)]
    got = {r["conv_id"]: r for r in chat_format.ChatFormat().digests(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")).collect()}
    for conv, mine in ((1, rows[:2]), (2, rows[2:-3]), (None, rows[-3:])):
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in mine)
        loss = "".join(text for _, _, role, text in mine if role == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(mine), hashlib.sha256(said.encode()).hexdigest())
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"], got[conv]["valid"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), conv is not None)


@pytest.mark.parametrize("roles,valid", [("ua", True), ("sua", True), ("suaua", True), ("u", True), ("au", False), ("uu", False), ("sa", False), ("usa", False)])
def test_chat_machine(spark, roles, valid):
    name = {"u": "user", "a": "assistant", "s": "system"}
    rows = spark.createDataFrame([(1, k, name[r], "t") for k, r in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string")
    assert chat_format.ChatFormat().format(rows).first()["valid"] is valid


def test_chat_empty(spark):
    assert chat_format.ChatFormat().digests(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


# -- op3 ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_bpe():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(bpe):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert len(bpe.table.keys) == len(ranks) == len(set(bpe.table.keys))
    assert all(bpe.table.get(k) == v for k, v in ranks.items()) and bpe.table.get(b"no such token at all") == -1


def test_bpe_matches_the_library(bpe, reference_bpe):
    codec, r = byte_bpe.Codec(bpe.table, bpe.pattern), random.Random(5)
    texts = ["", " ", "a" * 5000, "<|endoftext|>", "don't  stop\n\n\nnow 12345"] + ["".join(r.choice("abcdethe ing\n\t.'sé漢🙂0_") for _ in range(r.randint(0, 80))) for _ in range(500)]
    for t in texts:
        ids = codec.encode_text(t)
        assert ids == " ".join(map(str, reference_bpe.encode_ordinary(t))) and codec.decode_text(ids) == t.encode()


def test_bpe_rows(spark, odd, empty, bpe, reference_bpe):
    got = bpe.digests(odd).collect()
    assert len(got) == len(ODD) and bpe.digests(empty).count() == 0
    want = sorted((i or -1, len(x := reference_bpe.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    back = bpe.decode(bpe.encode(odd)).collect()
    assert sorted(bytes(r["data"]).decode() for r in back) == sorted(t or "" for _, t in ODD)


# -- op4 ---------------------------------------------------------------------------------------------


def test_topk_by_brute_force(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(300, 6)).round(1)
    v[100:200] = v[0]  # ties
    rows = [(i, [float(x) for x in v[i]]) for i in range(300)]
    rows += [(1000, None), (1050, [None] + [0.5] * 5), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (None, [1.0] * 6), (1200, [1.0, 2.0]), (1201, [3.0, 4.0]), (1250, [])]
    frame = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = defaultdict(list)
    for x in topk.TopK().apply(frame).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    good = [(i, np.floor(256 * np.array(e, np.float32).astype(float)).astype(int)) for i, e in rows if i is not None and e is not None and not any(x is None or not np.isfinite(x) for x in e)]
    for q, e in good:
        if q % 50 == 0:
            s = sorted((-int(e @ f), i) for i, f in good if i != q and len(f) == len(e))[:5]
            assert got.pop(q, []) == [(k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert not got


def best_by_brute_force(rows, q, own, k=5, wrap=False):
    """Scores and ids of a query's k best of all rows (id, vector) but row number own."""
    score = lambda e: (s := sum(int(a) * int(b) for a, b in zip(q, e))) if not wrap else (s := sum(int(a) * int(b) for a, b in zip(q, e))) + 2**63 - ((s + 2**63) // 2**64) * 2**64 - 2**63
    found = sorted((-score(e), i) for n, (i, e) in enumerate(rows) if n != own and len(e) == len(q))[:k]
    return [(i, -s) for s, i in found]


def test_topk_repeated_ids_and_huge_components(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=3).round(2)]) for i in range(60)]
    rows += [(0, [9.0, 9.0, 9.0]), (0, rows[0][1]), (0, rows[0][1]), (50, [-1e20, 0.0, 0.0]), (7, [-1e20, 0.5, 0.5])]
    got = defaultdict(list)
    for x in topk.TopK().apply(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    ints = [(i, [max(-(2**63), min(2**63 - 1, int(np.floor(256 * x)))) for x in e]) for i, e in rows]
    for q in (0, 50):
        own = min((e, n) for n, (i, e) in enumerate(ints) if i == q)[1]
        assert got.pop(q) == best_by_brute_force(ints, ints[own][1], own, wrap=True), q
    assert not got


def test_topk_stops_early(spark, monkeypatch):
    """Where few dimensions decide, the bound ends the search of a block, and floors carried over skip most blocks."""
    monkeypatch.setattr(topk, "ROWS", 128)
    r = np.random.default_rng(5)
    v = r.normal(size=(4000, 8)) * 0.3 ** np.arange(8) * r.lognormal(0, 1, (4000, 1))
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(v)]
    got = defaultdict(list)
    for x in topk.TopK(count_reads=True).apply(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"], x["rows_read"]))
    ints = [(i, [int(np.floor(256 * x)) for x in e]) for i, e in rows]
    read = []
    for q in range(0, 4000, 50):
        assert [x[:2] for x in got[q]] == best_by_brute_force(ints, ints[q][1], q)
        read.append(got[q][0][2])
    assert max(read) <= 4000 and np.mean(read) < 1000, (np.mean(read), max(read))


def test_topk_empty(spark):
    assert topk.TopK().apply(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


# -- op5 ---------------------------------------------------------------------------------------------


def brute_components(rows, percent, words=5):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows():
    r = random.Random(2)
    base = [[f"w{r.randint(0, 400)}" for _ in range(r.randint(8, 120))] for _ in range(60)]
    rows = []
    for k, words in enumerate(base):
        for _ in range(r.choice((1, 1, 2, 3, 8))):
            own = list(words)
            for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
                own[r.randrange(len(own))] = f"x{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(own)))
    family = [f"f{k}" for k in range(200)]
    for _ in range(150):  # one large family, of which some are linked only through others
        own = list(family)
        for _ in range(r.randint(0, 6)):
            own[r.randrange(200)] = f"y{r.randint(0, 10**6)}"
        rows.append((len(rows), " ".join(own)))
    return rows + [(len(rows) + k, "same text in many copies here") for k in range(40)]


@pytest.mark.parametrize("percent,bands", [(85, 20), (80, 30)])
def test_near_dedup_by_brute_force(spark, percent, bands):
    rows = near_rows()
    got = near_dedup.NearDuplicates(percent=percent, bands=bands).apply(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)).collect()
    want = brute_components(rows, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("percent,bands", [(85, 20), (80, 30)])
def test_near_dedup_finds_all_links_of_the_documents(spark, percent, bands):
    """Recall is 1 against all pairs of the 1,000 documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = near_dedup.NearDuplicates(percent=percent, bands=bands).apply(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], percent)


def test_near_dedup_id_with_two_texts(spark):
    words = [f"w{k}" for k in range(100)]
    near = [*words[:-1], "other"]
    rows = [(1, "quite another text of its own"), (1, " ".join(words)), (2, " ".join(near)), (3, "quite another text of its own")]
    for k in range(2):  # whichever of the two texts has the smaller hash
        got = near_dedup.NearDuplicates().apply(spark.createDataFrame([(i, t.replace("quite", "quite" * (k + 1)), None, None, None) for i, t in rows], DOCS)).collect()
        assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(1, 2, 1), (1, 96, 1), (2, 96, 1), (3, 2, 1)}


def test_near_dedup_hot_bucket_of_unlinked_texts(spark, monkeypatch):
    """Texts that share most of their words with one leader but not with each other: members are compared block by block, by size."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    r = random.Random(4)
    common = [f"c{k}" for k in range(150)]
    rows = []
    for k in range(80):
        own = [f"x{k // 2}-{j}" for j in range(r.randint(20, 60))]  # twins share their own words too
        rows.append((k, " ".join(common + own)))
    got = near_dedup.NearDuplicates(bands=60, rows=2).apply(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 85)


def test_near_dedup_odd_rows(odd, empty):
    got = near_dedup.NearDuplicates().apply(odd).collect()
    assert len(got) == len(ODD)
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in got) == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (-1, 4, -1, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (6, 1, 6, True), (7, 3, 7, True)]
    )
    assert near_dedup.NearDuplicates().apply(empty).count() == 0


def test_components(spark):
    from loomwork.storage import Scratch

    chain = [(k + 1, k) for k in range(40)] + [(100, 50), (101, 100), (101, 50), (7, 7)]
    got = dict(map(tuple, near_dedup.components(spark.createDataFrame(chain, "a bigint, b bigint"), Scratch(spark, "t")).collect()))
    assert got == {**{k: 0 for k in range(41)}, 50: 50, 100: 50, 101: 50}


def test_intersections():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 9000, 3000)).astype(np.uint64) for _ in range(7)]
    common = near_dedup.intersections(sets, np.arange(3), np.arange(7))
    assert all(common[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(3) for j in range(7) if i != j)


# -- op6 ---------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_license(text, scan):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, base, best = [], set(), {}
    for phrase, label in scan.phrases.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                at.append(k)
                base.add(label)
    for label, template in scan.templates.items():
        t = set(WORD.findall(template.lower()))
        width = max(2 * len(t), len(WORD.findall(template.lower())))
        starts = [k for k, w in enumerate(words) if w in t]  # the best window can start at a token
        for k in starts:
            share = len(t & set(words[k : k + width])) / len(t)
            if share >= scan.threshold - 1e-9:
                best[label] = max(share, best.get(label, 0))
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | best.keys())), 1.0 if base else max(best.values(), default=0.0))


def test_license_by_brute_force(spark, odd, empty):
    scan, r = license_scan.LicenseScan(), random.Random(4)
    texts = [t for _, t in ODD]
    for label, template in scan.templates.items():
        words = template.split()
        for _ in range(6):
            cut = [w for w in words if r.random() > r.choice((0, 0.1, 0.3))]
            texts.append(" ".join(word_texts(1, r.random())) + "\n" + ("\n" if r.random() < 0.5 else " ").join(cut) + "\n" + " ".join(word_texts(1, r.random())))
    frame = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {x["doc_id"]: tuple(x[n] for n in names) for x in scan.apply(frame).collect()}
    assert got == {i: brute_license(t, scan) for i, t in enumerate(texts)}
    assert scan.apply(odd).count() == len(ODD) and scan.apply(empty).count() == 0


def test_license_passages_at_every_offset():
    scan, r = license_scan.LicenseScan(), random.Random(8)
    for label, template in scan.templates.items():
        words = license_scan.words_of(template)
        tokens = sorted(set(words))
        need = max(1, -(-len(tokens) * 8 // 10))
        for offset in range(2 * len(words)):
            kept = set(r.sample(tokens, need))
            text = b" ".join([b"zzz"] * offset + [w if w in kept else b"yyy" for w in words] + [b"zzz"] * r.randint(0, 90)).decode()
            found = license_scan.Index({label: template}, 0.8, {}).matches(license_scan.words_of(text), set(license_scan.words_of(text)))
            assert found == {label: need / len(tokens)}


def test_license_blocks_by_brute_force():
    scan, r = license_scan.LicenseScan(), random.Random(9)
    index = license_scan.Index(scan.templates, 0.6, {})
    for _ in range(200):
        label = r.choice(sorted(scan.templates))
        words = [w for w in license_scan.words_of(scan.templates[label] * r.randint(1, 2)) for w in (w, *[b"zzz"] * (r.random() < 0.8))]
        words = [b"of"] * r.randint(0, 70) + [w for w in words if r.random() < 0.85] + [b"the"] * r.randint(0, 70)
        want = {}
        for name, template in scan.templates.items():
            t, width = set(license_scan.words_of(template)), max(2 * len(set(license_scan.words_of(template))), len(license_scan.words_of(template)))
            share = max(len(t & set(words[k : k + width])) for k in range(len(words))) / len(t)
            if share >= 0.6 - 1e-9:
                want[name] = share
        assert index.matches(words, set(words)) == want


def test_license_filters_send_candidates_away_before_counting():
    templates = {"x": "alpha beta gamma delta epsilon", "y": "one two three four five six seven eight"}
    rare = ["one", "two", "three", "four", "five", "six", "alpha", "beta", "gamma", "delta", "epsilon", "seven", "eight"]
    index = license_scan.Index(templates, 0.8, {w.encode(): n for n, w in enumerate(rare)})

    def seen(text):
        index.seen.clear()
        words = license_scan.words_of(text)
        return index.matches(words, set(words)), dict(index.seen)

    assert seen("no token of a prefix: delta epsilon seven eight gamma") == ({}, {})
    assert seen("alpha beta and nothing else") == ({}, {"length": 1})
    # Four tokens for x in all, but only two of them from its first prefix token on; y has too few from its own.
    assert seen("five six alpha beta")[1] == {"position": 1}
    assert seen("alpha beta gamma delta") == ({"x": 0.8}, {"counted": 1})
    got, counts = seen("alpha beta gamma seven eight " + "w " * 30)
    assert got == {} and counts == {"counted": 1}  # the filters can't tell other templates' commoner tokens


def test_license_templates_from_a_table(spark):
    r = random.Random(11)
    full = " ".join(f"term{r.randint(0, 400)}" for _ in range(1500))
    table = clashing(spark.createDataFrame([("full", full), ("full", "zzz"), ("none", "..."), (None, "x"), ("null", None), ("short", "all rights kept")], "label string, text string"))
    templates = license_scan.templates_of(table)
    assert templates == {"full": full, "short": "all rights kept"}
    changed = " ".join(w if r.random() < 0.9 else "changed" for w in full.split())
    rows = [(1, "before " * 5000 + changed + " after" * 900), (2, full[: len(full) // 3]), (3, "All rights, kept.")]
    scan = license_scan.LicenseScan(templates=templates)
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = {x["doc_id"]: (x["labels"], x["score"]) for x in scan.apply(frame).collect()}
    assert got == {i: (w[5], w[6]) for i, w in ((i, brute_license(t, scan)) for i, t in rows)}
    assert got[1][0] == "full" and got[2][0] == "" and got[3][0] == "short"


# -- op7 ---------------------------------------------------------------------------------------------


def reshared(sizes, weights=(5, 2, 1), budget=1.5, most=2.0):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] >= most * sizes[s]}
        for s in over or open_:
            out[s] = most * sizes[s] if over else level * w[s]
        left -= sum(out[s] for s in over)
        open_ -= over or open_
    return out


def test_mix(spark):
    r = random.Random(6)
    rows = [(i, " ".join(["w"] * r.randint(0, 3000)), None, r.choice(["a", "b", "b", "b", "é", "z", None, "Z"]), None) for i in range(400)] + [(1000, None, None, "a", None), (1001, "x", None, "only", None)]
    frame = clashing(spark.createDataFrame(rows, DOCS))
    op = source_mix.SourceMix()
    got = op.apply(frame).collect()
    sizes = defaultdict(int)
    for i, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    targets = reshared(sizes)
    source = {r_[0]: r_[3] for r_ in rows}
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for x in got:
        s = source[x["doc_id"]]
        assert x["source_size"] == sizes[s] and abs(x["target"] - targets[s]) < 1e-6 * max(1, targets[s]) and 0 <= x["taken"] <= 2 * x["size"]
        taken[s] += x["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    assert sorted(map(str, op.apply(frame.repartition(7)).collect())) == sorted(map(str, got))


def test_mix_schedule_is_even(spark):
    plan = spark.createDataFrame([("a", 0, 900_000, 9, 1_000_000.0), ("b", 1, 900_000, 9, 500_000.0), ("c", 2, 10, 9, 20.0)], "source string, sid int, source_size bigint, docs bigint, target double")
    op = source_mix.SourceMix(block=1000)
    slots = op.schedule(plan, op.shape(plan)).collect()
    assert len({s["slot"] for s in slots}) == len(slots)
    main = sorted((s["slot"], s["sid"]) for s in slots if s["slot"] < 2048)
    assert len({s for s, _ in main}) == len(main) >= 2045 and main[-1][0] < 2048  # at most one slot of a source has nothing left to take
    for n in (64, 256, 1000):  # every beginning of the schedule has nearly its share of each source
        assert abs(sum(s == 0 for _, s in main[:n]) - n * 2 / 3) <= 8
    for sid, target in ((0, 1_000_000), (1, 500_000), (2, 20)):
        own = sorted((s["rank"], s["low"], s["high"]) for s in slots if s["sid"] == sid)
        assert own[0][1] == 0 and own[-1][2] == target and all(a[2] == b[1] for a, b in zip(own, own[1:]))


def test_mix_order_follows_the_schedule(spark):
    """Rows dealt out by slot, walked file by file: every beginning holds nearly its share of each source."""
    rows = [(i, " ".join(["w"] * 40), None, "abc"[i % 8 // 3], None) for i in range(4000)]
    op = source_mix.SourceMix(block=64)
    frame = spark.createDataFrame(rows, DOCS)
    copies, slots = op.copies(frame)
    walked = [(r["slot"], r["doc_id"]) for r in op.in_order(copies, slots).collect()]
    assert [s for s, _ in walked] == sorted(s for s, _ in walked)
    got = {r["doc_id"]: r for r in op.apply(frame).collect()}
    assert all(got[i]["first_slot"] == min(s for s, j in walked if j == i) for i in list(got)[:50] if got[i]["taken"])
    assert all((r["first_slot"] is None) == (r["taken"] == 0) for r in got.values())
    whole = [sum("abc"[i % 8 // 3] == s for _, i in walked) / len(walked) for s in "abc"]
    for n in (200, 1000, 3000):
        assert all(abs(sum("abc"[i % 8 // 3] == s for _, i in walked[:n]) / n - w) < 0.06 for s, w in zip("abc", whole)), n


def test_mix_odd_rows(odd, empty):
    got = source_mix.SourceMix().apply(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] == 0 and r["first_slot"] is None for r in got if not r["size"])
    assert source_mix.SourceMix().apply(empty).count() == 0


# -- op8 ---------------------------------------------------------------------------------------------


def test_codewords_are_apart():
    for n in (2, 4, 6, 7, 20, 60):
        code = language_id.codewords(n)
        assert min(int((a != b).sum()) for a, b in combinations(code, 2)) >= max(1, code.shape[1] // 5)


def test_language_id(spark):
    r = random.Random(8)
    makers = {"xx": ["kra", "plo", "sti"], "yy": ["lami", "nora", "sela"], "zz": ["öth", "ükn", "räm"]}
    rows = [(i, " ".join("".join(r.choice(makers[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 40))), lang, "s", None) for i in range(600) for lang in [r.choice(list(makers))]]
    docs = spark.createDataFrame(rows, DOCS)
    op = language_id.LanguageId()
    got = {x["doc_id"]: x for x in op.apply(docs).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _, _ in rows if got[i]["held_out"]]) > 0.98
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i]["score"] <= 1 for i in got)
    mixed = spark.createDataFrame([(1, "kraplo stikra " * 5 + "öthükn rämöth " * 5, None, None, None), (2, "kraplo stikra " * 9, None, None, None)], DOCS)
    found = {x["doc_id"]: x for x in op.predict(op.fit(docs), mixed).collect()}
    assert found[2]["score"] > 0.99 and not found[2]["ambiguous"]
    taught = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:60]
    twins = spark.createDataFrame([(i, "kraplo stikra", ("xx", "ww")[k % 2], "s", None) for k, i in enumerate(taught)], DOCS)
    tie = op.apply(twins).collect()  # two languages of the same texts can't be told apart
    assert all(x["ambiguous"] and x["score"] < 0.7 for x in tie) and len({x["lang_pred"] for x in tie}) == 1


def plain_grams(text):
    raw = b" " + text.encode() + b" "
    folded = bytes(c if c >= 128 else c | 32 if chr(c).isalpha() else 32 for c in raw)
    folded = re.sub(b" +", b" ", folded)
    out = np.zeros(language_id.SIZE)
    for n, factor, base in ((2, 2654435769, 0), (3, 2246822519, 1 << language_id.BITS)):
        for k in range(len(folded) - n + 1):
            out[base + (int.from_bytes(folded[k : k + n], "big") * factor % 2**32 >> 32 - language_id.BITS)] += 1
    return out


def test_grams_by_plain_version(monkeypatch):
    texts = ["", "a", "Ab  c, 12 é!", "x" * 50 + "   " * 20 + "öß z" * 30, " ", "abc"]
    for piece in (1, 2, 7, 64, 1 << 18):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert all((language_id.gram_counts(t) == plain_grams(t)).all() for t in texts), piece


def test_language_by_plain_version(spark):
    """Counts, weights, losses and nearest codewords row by row in plain Python, over all training documents."""
    r = random.Random(9)
    makers = {"xx": ["kra", "plo", "sti"], "yy": ["lami", "nora", "kra"], "zz": ["öth", "plo", "räm"]}
    rows = [(i, " ".join("".join(r.choice(makers[lang]) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 8))), lang, "s", None) for i in range(150) for lang in [r.choice(list(makers))]]
    got = {x["doc_id"]: x for x in language_id.LanguageId().apply(spark.createDataFrame(rows, DOCS)).collect()}
    langs = sorted(makers)
    counts = {x: sum((plain_grams(t) for i, t, lang, _, _ in rows if lang == x and zlib.crc32(str(i).encode()) % 5), np.zeros(language_id.SIZE)) for x in langs}
    code, half = language_id.codewords(3), 1 << language_id.BITS
    share = {x: np.concatenate([(c[k] + 0.5) / (c[k] + 0.5).sum() for k in (slice(0, half), slice(half, None))]) for x, c in counts.items()}
    for i, t, _, _, _ in rows:
        grams = plain_grams(t)
        loss = dict.fromkeys(langs, 0.0)
        for bit in code.T:
            ones, zeros = [x for x, b in zip(langs, bit) if b > 0], [x for x, b in zip(langs, bit) if b < 0]
            weight = np.log(np.mean([share[x] for x in ones], axis=0)) - np.log(np.mean([share[x] for x in zeros], axis=0))
            margin = max(-8.0, min(8.0, float(grams @ weight) / grams.sum() * min(20.0, 2 * grams.sum() ** 0.5)))
            for x, b in zip(langs, bit):
                loss[x] += math.log1p(math.exp(-margin * b))
        like = {x: math.exp(min(loss.values()) - v) for x, v in loss.items()}
        assert abs(got[i]["score"] - max(like.values()) / sum(like.values())) < 1e-3
        assert loss[got[i]["lang_pred"]] - min(loss.values()) < 1e-3


def test_language_odd_rows(odd, empty):
    op = language_id.LanguageId()
    got = {(r["doc_id"], r["lang_pred"]) for r in op.apply(odd).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= got and (7, "en") in got
    assert op.apply(empty).count() == 0
    assert {r["lang_pred"] for r in op.predict(None, odd).collect()} == {"und"}


def test_language_keeps_texts_without_a_model(spark):
    import corpus_pipeline as C

    rows = [(1, "some words", None, "s", None), (2, "12 34", None, "s", None), (3, "", None, "s", None), (4, None, None, "s", None), (None, "漢", None, "s", None)]
    got = C.drop_unknown_language(spark, spark.createDataFrame(rows, DOCS), SF).collect()
    assert sorted((r["text"], r["lang"]) for r in got) == [("some words", "und"), ("漢", "und")]


# -- op9 ---------------------------------------------------------------------------------------------

ARTICLE = "<h1>Title &amp; more</h1><p>First <b>bold</b> text\n of the   article, long enough to matter.<p>Second&nbsp;one with <a href=x>a link</a> inside of it.</p><ul><li>item one<li>item two</ul>"
TEXT = "Title & more\nFirst bold text of the article, long enough to matter.\nSecond one with a link inside of it.\nitem one\nitem two"
NOISE = "<nav><ul><li><a href=/a>Home</a></li></ul></nav>", "<div class=ad>Buy now &lt;b&gt;</div>", "<script>var t='</p>';</script><style>p{}</style>", "<aside>see also</aside>", "<form>mail <input name=q><button>go</button></form>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div><div id=x>{}</div></div>"])
def test_html_shapes(wrap):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body><header>Site</header>{''.join(NOISE)}{wrap.format(ARTICLE)}<div class='comments'><p>a reader's comment</p></div><footer>&copy; us</footer></body></html>"
    assert html_text.main_text(page) == TEXT
    assert html_text.main_text(page.replace("</body></html>", "")) == TEXT


def test_html_notices_inside_the_article():
    inner = ARTICLE.replace("<p>Second", "<div class='notice'>Subscribe!</div><p>Second")
    assert html_text.main_text(f"<body><article>{inner}</article></body>") == TEXT


def paragraph(k, n=300):
    return (f"paragraph {k} " + "words of the text go on and on " * 20)[:n].strip()


@pytest.mark.parametrize("sections, each, first", [(2, 6, 300), (3, 20, 300), (3, 8, 500), (5, 8, 500), (3, 8, 100)])
@pytest.mark.parametrize("wrap", ["<div>{}</div>", "{}", "<div id=a><div id=b>{}</div></div>"])
@pytest.mark.parametrize("tag", ["section", "div"])
def test_html_text_split_over_sections(sections, each, first, wrap, tag):
    want, html = ["The title"], "<h1>The title</h1>"
    for s in range(sections):
        texts = [paragraph(f"{s} {k}", first if s == 0 else 300) for k in range(each)]
        want += [f"Part {s}", *texts]
        html += f"<{tag}><h2>Part {s}</h2>{''.join(f'<p>{t}</p>' for t in texts)}</{tag}>"
    links = "<div>" + "".join(f"<div><a href=/{k}>Place {k}</a></div>" for k in range(8)) + "</div>"
    page = f"<html><body>{links}{wrap.format(html)}<div>Site by us</div>{links}</body></html>"
    assert html_text.main_text(page) == "\n".join(want)


@pytest.mark.parametrize(
    "block",
    ['<section id="related-work">{}</section>', '<section id="legal-history">{}</section>', '<section id="legal">{}</section>', '<div class="social-sciences">{}</div>', '<section aria-label="A hidden valley">{}</section>', "<section title=' class=ad '>{}</section>", '<section data-x="the id=menu of it">{}</section>'],
)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div>{}</div>", '<div id="side-content">{}</div>', '<div id="side-content"><article>{}</article></div>', '<div class="sidebar"><main>{}</main></div>'])
def test_html_names_do_not_drop_text(block, around):
    texts = [paragraph(k) for k in range(4)]
    inner = f'<h1>Search</h1><p>{texts[0]}</p>' + block.format(f'<h2 id="search-algorithms">Algorithms</h2><p>{texts[1]}</p><p title="The hidden cost">{texts[2]}</p>') + f'<p>{texts[3]}</p>'
    page = f"<body>{around.format(inner)}<div class='social-links'><a href=x>One</a> <a href=y>Two</a></div></body>"
    assert html_text.main_text(page) == "\n".join(["Search", texts[0], "Algorithms", *texts[1:]])


@pytest.mark.parametrize("named", ["class=comments", "id='comments'", "class='comment-list'", 'class="x cookie-banner"', "class=ad", "hidden", "style='display: none'", "title='a > b' aria-hidden=true"])
def test_html_names_drop_comments_and_notices(named):
    texts = [paragraph(k) for k in range(6)]
    page = f"<body><div><h1>Title</h1>{''.join(f'<p>{t}</p>' for t in texts)}</div><div {named}><p>{paragraph('of a reader')}</p><p>{paragraph('of another')}</p></div></body>"
    assert html_text.main_text(page) == "\n".join(["Title", *texts])


@pytest.mark.parametrize(
    "linked, want",
    [
        ("<h2><a href=x>Heading</a></h2>", ["Heading"]),
        ("<h2><a href=x>Head</a><a href=y>ing</a></h2>", ["Heading"]),
        ("<p><a href=x>A linked paragraph</a></p>", ["A linked paragraph"]),
        ("<ul><li><a href=x>one</a></li><li>two</li><li><a href=y>three</a></li></ul>", ["one", "two", "three"]),
        ("<table><tr><td><a href=x>a</a></td><td><a href=y>b</a></td></tr><tr><td>c</td><td><a href=z>d</a></td></tr></table>", ["a", "b", "c", "d"]),
        ("<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul>", ["one", "two"]),
        ("<ul><li>two of them:<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul></li></ul>", ["two of them:", "one", "two"]),
    ],
)
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div>{}</div>"])
def test_html_linked_text_of_the_article(linked, want, around):
    first, second, menu = paragraph(1), paragraph(2), "<ul><li><a href=/1>Home</a></li><li><a href=/2>News</a></li></ul>"
    page = f"<body><div>{menu}</div>{around.format(f'{menu}<h1>Title</h1><p>{first}</p>{linked}<p>{second}</p>{menu}<div><div><a href=/3>More</a></div><div><a href=/4>Less</a></div></div>')}{menu}</body>"
    assert html_text.main_text(page) == "\n".join(["Title", first, *want, second])
    texts = [paragraph(k) for k in range(6)]
    sections = [f"<div>{''.join(f'<p>{t}</p>' for t in part)}</div>" for part in (texts[:3], texts[3:])]
    page = f"<body>{menu}<div>{sections[0]}{linked}{sections[1]}</div>{menu}</body>"
    assert html_text.main_text(page) == "\n".join([*texts[:3], *want, *texts[3:]])


@pytest.mark.parametrize("piece", ["<a", '<a "', "<p>", "<div a='", "<!--", "<li>", "&amp", "</div>", "<tr><td>a", "<script>", "<div>", "<b>", "<b><hr>", "<div><li>x", "<div class=ad>y", "<article><header><h1>t", "<ul><li><b>", "<a href=x>z"])
def test_html_hostile_pages_take_linear_time(piece):
    import time

    began = time.perf_counter()
    html_text.main_text(piece * 50_000)
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("levels", [10, 100, 250, 5000])
def test_html_menus_at_any_depth(levels):
    texts = [paragraph(k) for k in range(5)]
    inner = "<nav><a href=a>Home</a> <a href=b>News</a></nav>" + "".join(f"<p>{t}</p>" for t in texts) + "<aside>see also this</aside>"
    assert html_text.main_text("<body>" + "<div>" * levels + inner + "</div>" * levels + "</body>") == "\n".join(texts)


def test_html_article_headers_keep_titles():
    texts = [paragraph(k) for k in range(3)]
    head = "<header><div><h1>The <i>title</i></h1></div><p>by a writer, at a time</p><nav><h2>Menu</h2><a href=x>Home</a></nav></header>"
    page = f"<body><header><h2>The site</h2></header><article>{head}{''.join(f'<p>{t}</p>' for t in texts)}</article></body>"
    assert html_text.main_text(page) == "\n".join(["The title", *texts])


def test_html_densities_by_plain_version():
    """Characters, tags, links, densities and their sums of random trees, by recursion over the tree that the pages were written from."""
    r = random.Random(12)

    def tree(depth):
        kids = [tree(depth - 1) if depth and r.random() < 0.6 else " ".join(["ab", "c"] * r.randint(1, 30)) for _ in range(r.randint(0, 4))]
        return r.choice(["div", "section", "span", "a", "blockquote"]) if depth < 6 else "body", kids

    def written(node):
        return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(written, node[1]))}</{node[0]}>"

    def counted(node):
        """chars, tags, linked chars, linked tags of a node."""
        out = [0, 0, 0, 0]
        for p in node[1]:
            c = [len(p.replace(" ", "")), 0, 0, 0] if isinstance(p, str) else counted(p)
            linked = not isinstance(p, str) and p[0] == "a"
            for k, x in enumerate((c[0], c[1] + (not isinstance(p, str)), c[0] if linked else c[2], c[3] + linked)):
                out[k] += x
        return out

    for _ in range(40):
        top = tree(6)
        whole = counted(top)
        share = whole[2] / whole[0] if whole[0] else 0.0

        def density(node):
            c, t, lc, lt = counted(node)
            if not c:
                return 0.0
            t, lt = max(1, t), max(1, lt)
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            inner = math.log(max(1.0, c / max(1, lc) * t / lt))
            return c / t * (inner / math.log(base) if base > 1 else inner)

        body = html_text.measure(html_text.parse(written(top)))
        todo = [(top, body)]
        for node, got in todo:
            assert [got.chars, got.tags, got.link_chars, got.link_tags] == counted(node)
            assert abs(got.density - density(node)) < 1e-6 * max(1, got.density)
            assert abs(got.total - sum(density(p) for p in node[1] if not isinstance(p, str))) < 1e-6 * max(1, got.total) or not got.chars
            todo += zip([p for p in node[1] if not isinstance(p, str)], [p for p in got.parts if not isinstance(p, str)])


def test_html_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<<<>>>"), (None, "u", "plain"), (5, "u", "<div>" * 5000 + "deep" + "</div>" * 5000), (6, "u", "<p>a<br>b&#233;&eacute;&bogus;"), (6, "u", "<p>a<br>b&#233;&eacute;&bogus;")]
    frame = clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = sorted((r["page_id"] or -1, r["text"]) for r in html_text.HtmlText().apply(frame).collect())
    assert got[0] == (-1, "plain") and got[1:3] == [(1, ""), (2, "")] and got[4] == (5, "deep") and got[5] == got[6] == (6, "a béé&bogus;")
    assert html_text.HtmlText().apply(frame.limit(0)).count() == 0


# -- op10 --------------------------------------------------------------------------------------------


def test_fingerprints_by_brute_force(spark):
    rows = [(i * 3 % 101, t) for i, t in enumerate(word_texts(101, 9))]
    rows += [(200 + i, f"{t} and" * 9 + f" end {i}") for i, (_, t) in enumerate(rows[:60])] + [(300 + i, f"{t} and" * 9 + f" end {i + 7}") for i, (_, t) in enumerate(rows[:60])]
    rows += [(500, ""), (501, None), (502, "🙂é漢" * 40)]
    frame = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS))
    got = {r["doc_id"]: r for r in fingerprint.Fingerprints().apply(frame).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 4
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - m] + following[:m]).encode()).hexdigest()
        one, edit, nxt = (int(x, 16) for x in (got[i]["fingerprint"], got[i]["edited_fingerprint"], got[order[(k + 1) % len(order)][0]]["fingerprint"]))
        others = {int(x["fingerprint"], 16) for x in got.values()} - {one}
        assert got[i]["n_links"] == sum(bin(one ^ x).count("1") <= 3 for x in others)
        assert got[i]["near_edited"] == 1 - bin(one ^ edit).count("1") / 64 and got[i]["near_next"] == 1 - bin(one ^ nxt).count("1") / 64


def test_both_fingerprints(spark):
    """Fingerprints of texts and edited texts side by side are those of each alone, wherever the cut goes; rows of one id are told apart."""
    r = random.Random(13)
    texts = word_texts(60, 14) + ["", " ", "a", "ab", "abc", "a b", " a b ", "word" * 9, "ΑΣ ΑΣΑ ΟΣΟΣ" * 5, "x  " * 7] + ["same start " * 6 + end for end in ("one end", "two end")]
    rows = [(k, t, r.choice(texts)) for k, t in enumerate(texts)] + [(900, "same start " * 6 + end, "zzz") for end in ("one end", "two end")]
    made = fingerprint._with_edit(spark.createDataFrame(rows, "doc_id bigint, text string, start string"))
    whole = {(x["doc_id"], x["t"]): x["fingerprint"] for c in ("text", "edited_text") for x in fingerprint.fingerprints(made.select("doc_id", F.col(c).alias("t"), F.col(c).alias("u")), ["doc_id", "t"], "u").collect()}
    got = sorted((x["doc_id"], x["own"], x["new"]) for x in fingerprint.both_fingerprints(made).collect())
    assert got == sorted((x["doc_id"], whole[x["doc_id"], x["text"]], whole[x["doc_id"], x["edited_text"]]) for x in made.collect())


def test_votes_by_hand(spark):
    texts = spark.createDataFrame([(1, "One two  three one two"), (2, "x"), (3, "")], "doc_id bigint, text string")
    terms = {1: [("one", "two"), ("two", "three"), ("three", "one"), ("one", "two"), ("two", None)], 2: [("x", None)], 3: [("", None)]}
    pairs = sorted({p for ps in terms.values() for p in ps}, key=str)
    hashed = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h"))
    h = {(r["a"], r["b"]): r["h"] & (2**64 - 1) for r in hashed.collect()}
    got = {r["doc_id"]: r["fingerprint"] & (2**64 - 1) for r in fingerprint.fingerprints(texts, ["doc_id"]).collect()}
    for i, ts in terms.items():
        weight = [min(len(a) + len(b or ""), 15) + 1 for a, b in ts]
        want = sum(1 << bit for bit in range(64) if 2 * sum(w for t, w in zip(ts, weight) if h[t] >> bit & 1) > sum(weight))
        assert got[i] == want


def test_blocks_grow_with_the_number_of_fingerprints():
    assert [fingerprint.blocks_for(n, 3) for n in (0, 10**5, 10**7, 10**9, 10**10)] == [5, 5, 6, 7, 8]
    for n in (10**6, 10**9, 10**10):
        b = fingerprint.blocks_for(n, 3)
        assert 2 ** (64 * (b - 3) // b) >= 8 * n


@pytest.mark.parametrize("spare, hot", [(4, 2048), (22, 5), (30, 2048), (4, 3)])
def test_neighbours_by_brute_force(spark, monkeypatch, spare, hot):
    monkeypatch.setattr(fingerprint, "SPARE", spare)
    monkeypatch.setattr(fingerprint, "HOT", hot)
    r = random.Random(10)
    base = [r.getrandbits(64) for _ in range(60)]
    every = base + [b ^ sum(1 << k for k in r.sample(range(64), n)) for b in base for n in (1, 2, 3, 4, 5)] + base[:10]
    signed = [x - 2**64 if x >= 2**63 else x for x in every]
    pairs = [(x["a"], x["b"], x["distance"]) for x in fingerprint.neighbours(spark.createDataFrame([(x,) for x in signed], "fingerprint bigint"), 3).collect()]
    got = set(pairs)
    assert len(got) == len(pairs)
    want = {(a, b, n) for a, b in combinations(sorted(set(signed)), 2) if (n := bin((a ^ b) & (2**64 - 1)).count("1")) <= 3}
    assert got == want


def test_fingerprint_odd_rows(odd, empty):
    got = fingerprint.Fingerprints().apply(odd).collect()
    assert len(got) == len(ODD) and fingerprint.Fingerprints().apply(empty).count() == 0
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}) == 1
    assert [r["near_next"] for r in got if r["doc_id"] is None] == [None]


# -- queries and pipeline ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    df = Q.QUERIES[name](spark, SF)
    if name in Q.ORACLE_SQL:
        assert_same(df, connect(SF), Q.ORACLE_SQL[name])
    else:
        table = "pages" if name.startswith("op9") else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in Q.QUERIES}
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(Q.ORACLE_SQL) <= set(entry.oracle_sql())


def test_pipeline_by_plain_versions(spark, tmp_path):
    import corpus_pipeline as C

    docs, labels, truth = toxic_table(spark, 300)
    rows = [tuple(r) for r in docs.collect()] + [(1000, None, "en", "s", None), (1001, "12 34", "en", "s", None), (1002, docs.first()["text"], "en", None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    d, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in C.STAGES[:-1]:
        before = d
        d = stage(spark, d, str(tmp_path))
        assert d.columns == before.columns
        kept[name] = [tuple(r) for r in d.collect()]
    ids = {k: {r[0] for r in v} for k, v in kept.items()}
    assert np.mean([(i in ids["toxicity"]) == (not truth[i]) for i in truth]) > 0.97
    assert ids["language_id"] == {i for i in ids["toxicity"] if i not in (1000, 1001)}
    want = brute_components([r[:2] for r in kept["language_id"]], 80)
    assert ids["near_dedup"] == {i for i, (_, c) in want.items() if i == c}
    assert ids["source_mix"] <= ids["near_dedup"] and len(kept["source_mix"]) >= len(ids["near_dedup"])
    codec = C.ByteBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    last = C.STAGES[-1][1](spark, d, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in last) == sorted((r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in kept["source_mix"])
    assert C.run(spark, str(tmp_path)).count() == len(kept["source_mix"]) and codec


def test_pipeline_odd_rows(spark, odd, labels, tmp_path):
    """Nothing is toxic for want of labels; texts without a letter go; of equal texts the smallest id stays, rows without an id all; each is taken twice, up to the sources' limits, in the order of the schedule."""
    import corpus_pipeline as C

    labels.write.parquet(str(tmp_path / "labels.parquet"))
    d, kept = odd, {}
    for name, stage in C.STAGES:
        d = stage(spark, d, str(tmp_path))
        kept[name] = [r["doc_id"] for r in d.collect()]
    some = lambda name: sorted(-1 if i is None else i for i in kept[name])
    assert some("toxicity") == sorted(-1 if i is None else i for i, _ in ODD)
    assert some("language_id") == [-1, 4, 5, 5, 6, 7]
    assert some("near_dedup") == [-1, 4, 6, 7]
    assert set(some("source_mix")) == {-1, 4, 6, 7} and max(map(some("source_mix").count, (-1, 4, 6, 7))) <= 2
    assert some("byte_bpe") == some("source_mix")
    none = odd.limit(0)
    for name, stage in C.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0, name


def test_pipeline_is_encoded_in_the_order_of_the_mix(spark, tmp_path):
    """Through a table that is written and read again, as in run(), and without one."""
    import corpus_pipeline as C
    from loomwork.storage import Scratch

    r = random.Random(12)
    rows = [(i, " ".join("w" * r.randint(1, 9) + str(r.random())[2:] if i % 3 else "same" for _ in range(r.randint(50, 300))), "en", "abc"[i % 3], None) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    copies, _ = C.SourceMix().copies(docs)
    want = [x["doc_id"] for x in copies.sort("slot", "start").collect()]
    assert len(set(want)) < len(rows) < len(want)  # some go, some are there twice
    mixed = C.mix_sources(spark, docs, "")
    for d in (Scratch(spark, "mixed").keep(mixed), mixed):
        got = C.encode(spark, d, "").collect()
        assert [x["doc_id"] for x in got] == want
        assert [x["place"] for x in got] == list(range(len(want)))
    text = {x[0]: x[1] for x in rows}
    assert all(x["decoded_sha256"] == hashlib.sha256(text[x["doc_id"]].encode()).hexdigest() and x["n_chars"] == len(text[x["doc_id"]]) for x in got)
    assert mixed.columns == docs.columns
