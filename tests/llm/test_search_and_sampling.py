"""Ranked search, importance resampling and BPE against plain versions of them."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import bpe, lexical, resample, tokens
from tests.conftest import SF_SMALL
from tests.llm.test_operators import LONG, TEXTS, VOCABULARY, tokenized

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", n, -n) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, rank string, score long, ids long").repartition(3)


def plain_search(texts, items, k):
    """(item id, rank, doc id, score) of every row of ``items``."""
    found = [(i, Counter(plain_terms(t))) for i, t in texts if plain_terms(t)]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in found:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                        (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in Counter(plain_terms(text)).items() if c[t])
            if score:
                scores.append((-score, i is None, i or 0))
        out.update((item, rank, None if none else i, -score)
                   for rank, (score, none, i) in enumerate(sorted(scores)[:k], 1))
    return out


ITEMS = [(1, "the quick brown fox, the FOX"), (1, "alpha"), (None, "alpha gamma beta"), (2, None), (3, ""), (4, "?!"),
         (5, "nowhere at all found: zzz"), (6, "école École one shared line"), (7, "word3x3 " * 40 + "word5x5"), (7, "alpha")]


@pytest.mark.parametrize("block_terms, k", [(50_000, 20), (12, 2)])
def test_search(spark, docs, block_terms, k):
    items = spark.createDataFrame([(*x, 1) for x in ITEMS], "item_id long, text string, doc_id int")
    found = lexical.search(docs, items, k, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == plain_search(TEXTS, ITEMS, k)


def test_search_prunes_and_loses_nothing(spark, monkeypatch):
    """Texts of Zipf-like words with copies; many buckets, and more ranges than one bucket takes."""
    random = np.random.RandomState(1)
    texts = [(i, " ".join(f"w{x}" for x in np.minimum(random.zipf(1.3, 5 + i % 90), 900))) for i in range(3000)]
    texts += [(3000 + i, texts[7][1]) for i in range(900)]
    items = [(i, " ".join(f"w{x}" for x in np.minimum(random.zipf(1.2, 12), 900))) for i in range(25)] + [(99, texts[7][1])]
    monkeypatch.setattr(lexical, "TASK_BUCKET", 64)
    monkeypatch.setattr(lexical, "GROWTH", 2)
    found = lexical.search(spark.createDataFrame(texts, "doc_id long, text string").repartition(6),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, found.collect())) == plain_search(texts, items, 20)


def test_buckets_bound_every_score():
    """What the bounds drop has no score that reaches the threshold; and they drop most."""
    random = np.random.RandomState(4)
    import pyarrow as pa
    impacts = [{int(t): int(random.randint(1, 10 ** 6)) for t in random.choice(200, random.randint(1, 30), False)}
               for _ in range(500)]
    bucket = lexical.Bucket(pa.table({
        "id": list(range(500)), "length": [math.sqrt(sum(x * x for x in v.values())) for v in impacts],
        "terms": pa.array([list(v) for v in impacts], pa.list_(pa.int32())),
        "impacts": pa.array([list(v.values()) for v in impacts], pa.list_(pa.int32()))}))
    rows = [type("R", (), {"item": 0, "term": str(t), "n": 1}) for t in range(0, 200, 9)]
    weights = np.where(np.arange(200) % 5 == 0, 9000, 300)
    queries = lexical.Queries(rows, weights, {str(t): t for t in range(200)})
    score = [sum(int(weights[t]) * v.get(t, 0) for t in range(0, 200, 9)) for v in impacts]
    for least in (0, 1, 10 ** 9, 5 * 10 ** 9, 10 ** 10, max(score), max(score) + 1):
        found, sums = bucket.reaching(queries, 0, least)
        assert dict(zip(found.tolist(), sums.tolist())) == {i: s for i, s in enumerate(score) if s >= max(1, least)}


def plain_resample(texts, targets, percent, least_words):
    def features(text):
        w = plain_terms(text)
        return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    def bucket(feature):
        return crc32(feature.encode()) % 10_000

    s, t = (Counter(bucket(f) for x in some for f in features(x)) for some in ([x for _, x in texts], targets))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for n, (i, text) in enumerate(texts):
        own = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
                     for b in map(bucket, own))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((i, len(own), weight, score, len(plain_terms(text)) >= least_words))
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = may[:percent * len(may) // 100]
    return Counter((*r[:4], rank) for rank, r in enumerate(drawn, 1)) + Counter(
        (*r[:4], None) for r in [*may[len(drawn):], *(r for r in rows if not r[4])])


@pytest.mark.parametrize("percent, least_words", [(5, 20), (50, 1), (100, 0), (1, 100)])
def test_resample(spark, docs, percent, least_words):
    targets = ["the quick brown fox", None, "", "alpha beta", "word3x3 word4x4 word5x5", "alpha beta"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    found = resample.resample(docs, target, percent, least_words)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, found.collect())) == plain_resample(TEXTS, targets, percent, least_words)


def test_resample_of_many_ties(spark):
    """A third of the rows share text and id, so the cutoff falls among equal rows."""
    texts = [(7 if i % 3 == 0 else i, "one text of three words" if i % 3 == 0 else f"own words {i}") for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("one text of three words",)], "text string")
    for percent in (20, 40):
        found = resample.resample(docs, target, percent, 1).collect()
        assert Counter(map(tuple, found)) == plain_resample(texts, ["one text of three words"], percent, 1)


def test_first_rows(spark):
    random = np.random.RandomState(2)
    rows = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(random.randint(-3, 3, 200), random.randint(-10 ** 12, 10 ** 12, 200)))]
    frame = spark.createDataFrame(rows, "a long, b long, c long").cache()
    for k in (1, 2, 50, 199, 200):
        kept = frame.where(resample.first_rows(frame, ["a", "b", "c"], k)).collect()
        assert sorted(map(tuple, kept)) == sorted(rows)[:k]
    assert resample.first_rows(frame, ["a"], 0) is None


AWKWARD = ["", " ", "a b  c", "it's we'll 'tis", "x\x1cy \x85 z", "é́ ٠١ ²³½", "ab<|endoftext|>cd <|endoftext|>", "<|endoftext|>",
           "<|endoftext|><|endof", "中文 テスト \U0001F600‍ x", "\r\n\r\n x", "a" * 40_000, "ab" * 9000 + "é" * 3000,
           "\x00\x01", " lead", "trail ", "xyz1" * 50, LONG]


def test_bpe_is_the_librarys(spark):
    library = tokens.library(VOCABULARY)
    texts = [t or "" for _, t in TEXTS] + AWKWARD + [
        r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    coder = bpe.bpe(VOCABULARY)
    for text in texts:
        ids = np.frombuffer(coder.encode(text), dtype="<i4").tolist()
        assert ids == tokenized(text)
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    random = np.random.RandomState(8)
    for _ in range(50):  # ids in any order, so bytes that aren't UTF-8, and ids that don't exist
        ids = random.randint(0, 50_400, 60).tolist()
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_columns(spark, docs):
    made = bpe.decode_ids(bpe.encode_texts(docs, VOCABULARY), VOCABULARY, text_col="rank")
    assert sorted(made.columns) == sorted(docs.columns)
    found = [(r.doc_id, r.text, tuple(r.ids), r.rank) for r in made.collect()]
    assert Counter(found) == Counter((i, t, tuple(tokenized(t)), t or "") for i, t in TEXTS)
    ids = spark.createDataFrame([(1, [None, 262, 10 ** 6]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode_ids(ids, VOCABULARY).collect()} == {
        1: tokens.library(VOCABULARY).decode([262]), 2: "", 3: ""}


def test_empty_tables(spark, docs):
    none, items = docs.where("false"), spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    for d, i in ((none, items), (docs, items.where("false")), (none, items.where("false"))):
        assert lexical.search(d, i).collect() == []
    assert resample.resample(none, items).collect() == []
    assert len(resample.resample(docs, items.where("false")).collect()) == len(TEXTS)
    assert bpe.decode_ids(bpe.encode_texts(none, VOCABULARY), VOCABULARY).collect() == []
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert lexical.search(blank, items).collect() == []
    assert {(r.n_features, r.weight, r["rank"]) for r in resample.resample(blank, items).collect()} == {(0, 0, None)}
