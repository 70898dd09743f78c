"""Importance resampling against a plain recount of words, pairs and ranks."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallybook.llm import resampling
from tallybook.llm.text import SLICE_BYTES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_features(text):
    words = plain_words(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_counts(texts, buckets):
    return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in plain_features(t))


def plain_resample(rows, target, percent=25, min_words=20, buckets=10000, seed=7):
    corpus, wanted = plain_counts([t for _, t in rows], buckets), plain_counts(target, buckets)
    size, aim = sum(corpus.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (size + buckets) / ((corpus[b] + 1) * (aim + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc_id, text in rows:
        own = [gain[zlib.crc32(f.encode()) % buckets] for f in plain_features(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(plain_words(text)) >= min_words])
    fits = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    for rank, row in enumerate(fits[: percent * len(fits) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in out)


def found(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(tuple(r) for r in df.collect())


def test_awkward_rows(spark, awkward, nothing):
    target = spark.createDataFrame([("Hello world again",), (None,), ("größer als zwei",)], "text string")
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for percent, min_words in ((25, 20), (100, 1), (60, 0)):
        got = found(resampling.resample(awkward, target, percent=percent, min_words=min_words))
        assert got == plain_resample(rows, [r.text for r in target.collect()], percent, min_words)
    assert resampling.resample(nothing, target).count() == 0
    no_target = target.limit(0)
    assert found(resampling.resample(awkward, no_target)) == plain_resample(rows, [])


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(resampling.resample(docs, target)) == plain_resample(rows, [r.text for r in target.collect()])


def test_lines_are_counted_once_and_pairs_cross_them(spark):
    line = "the same line again and again 42"
    texts = [(line + "\n") * 500, f"{line}\n \n,.;\n\nnext", line + "\r" + line, "x\ny\nz", "a\n" * 3, None, ""]
    df = spark.createDataFrame([(t,) for t in texts * 3], "text string").repartition(5)
    counts = resampling.feature_counts(df, 997)
    assert {b: int(n) for b, n in enumerate(counts) if n} == dict(plain_counts(texts * 3, 997))
    lines, crossing = resampling.segments("One two\n,\nThree\nfour, FIVE six".encode())
    assert lines == [b"one two", b"three", b"four five six"] and crossing == [b"two three", b"three four"]


def test_checksums_of_long_words_and_texts(monkeypatch):
    monkeypatch.setattr(resampling, "RUN_WORDS", 7)
    chance = random.Random(5)
    words = ["".join(chance.choice("abzé9") for _ in range(chance.choice([1, 2, 5, 63, 64, 65, 66, 300]))) for _ in range(200)]
    texts = [" ".join(words[i : i + 23]) for i in range(0, 200, 23)] + ["", "one", "A"]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = [Counter() for _ in texts]
    for owner, own, pair_owner, pairs in resampling.hashed_features(np.frombuffer(b"".join(data), np.uint8), offsets, 10007):
        for text, bucket in zip([*owner, *pair_owner], [*own, *pairs]):
            got[text][bucket] += 1
    assert got == [plain_counts([t], 10007) for t in texts]


def test_a_text_larger_than_a_slice(spark):
    text = " ".join(f"w{i % 5003}x" for i in range(SLICE_BYTES // 4))
    df = spark.createDataFrame([(1, text), (2, text[: 1 << 16]), (3, "w1x w2x")], "doc_id bigint, text string")
    target = spark.createDataFrame([("w1x w2x w3x",)], "text string")
    assert found(resampling.resample(df, target, percent=100, min_words=1)) == plain_resample(
        [(r.doc_id, r.text) for r in df.collect()], ["w1x w2x w3x"], 100, 1
    )


@pytest.mark.parametrize("n", [0, 1, 3, 4, 8])
def test_ties_and_share(spark, n):
    """Rows that repeat an id and its text tie; the share is floored."""
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    df = spark.createDataFrame([(i // 2, text) for i in range(n)], "doc_id bigint, text string")
    got = resampling.resample(df, df.select("text"))
    ranks = sorted(r.rank for r in got.collect() if r.rank)
    assert got.count() == n and ranks == list(range(1, n * 25 // 100 + 1))
