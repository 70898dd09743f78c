"""Substring repeats, similarity join and top-k search against brute force."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallybook.llm import jaccard, queries, substring, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALL = "/root/testdata/sf0.001"


def words(text):
    return WORD.findall(text or "")


def kept_words(texts, length):
    """(words, removed, kept text) per document; texts by id."""
    first = {}
    split = {i: words(t) for i, t in texts.items()}
    for i in sorted(split):
        for k in range(len(split[i]) - length + 1):
            first.setdefault(tuple(split[i][k : k + length]), i)
    out = {}
    for i, own in split.items():
        gone = set()
        for k in range(len(own) - length + 1):
            if first[tuple(own[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out[i] = (len(own), len(gone), kept)
    return out


def components(texts, width=5, percent=80):
    """(set size, smallest reachable id) per document; texts by id."""
    sets = {}
    for i, t in texts.items():
        own = words((t or "").translate(LOWER))
        sets[i] = {tuple(own[k : k + width]) for k in range(max(1, len(own) - width + 1))} if own else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i in sorted(sets):
        common = defaultdict(int)
        for gram in sets[i]:
            for j in holders[gram]:
                common[j] += 1
            holders[gram].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_repeats_of_the_given_table(spark, small_texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op2_substring_repeats(spark, SMALL).collect()}
    wanted = kept_words(small_texts, 50)
    assert got == {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in wanted.items()}
    assert any(gone for _, gone, _ in got.values())


@pytest.mark.parametrize("length,seed", [(6, 3), (6, 6), (4, 1), (3, 2)])
def test_overlapping_and_nested_repeats(spark, length, seed):
    base = [f"w{i * i % 41}" for i in range(60)]
    texts = {1: " ".join(base), 2: " ".join(base[10:40]), 3: "x " + " ".join(base[20:30]) + "\ty\n" + " ".join(base[22:50])}
    texts |= {4: "a " * 30, 5: "a " * 12, 6: " ".join(base[20:26]), 7: " ".join(base[:25] + base[:25]), 8: None, 9: "", 10: " \t\n"}
    texts |= {11: "Ä ö " + " ".join(base[40:55]) + " z", 12: " ".join(base[25:] + base[:25])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumns({"anchor": F.lit(1), "runs": F.lit(2)})
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs.repartition(3), length, seed).collect()}
    assert got == kept_words(texts, length)


def twins(n=1024):
    """Two long words of two letters that collide under every polynomial hash modulo 2^64."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_different_long_words_are_told_apart(spark):
    for one, two in (twins(), twins(64), twins(256)):
        rest = " ".join(f"w{i}" for i in range(80))
        texts = {1: f"{one} {rest}", 2: f"{two} {rest}", 3: f"{rest} {one}", 4: one, 5: two, 6: " ".join([one] * 60), 7: " ".join([two] * 60)}
        docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(docs).collect()}
        assert got == kept_words(texts, 50)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_components(docs).collect()} == components(texts)


def test_word_hashes():
    import random

    import numpy as np

    from tallybook.llm import text

    chance = random.Random(2)
    some = ["".join(chance.choice("ab\x00é") for _ in range(n)) for n in (*range(1, 40), 255, 256, 257, 300, 5000) for _ in range(4)]
    some += ["a" * n for n in range(1, 300)] + some[:20]
    data = " ".join(some).encode()
    found = text.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert len(found.hashes) == len(some)
    by_hash = defaultdict(set)
    for word, value in zip(some, found.hashes.tolist()):
        by_hash[value].add(word)
    assert all(len(w) == 1 for w in by_hash.values()) and len(by_hash) == len(set(some))


def test_many_repeats_are_one_run(spark):
    passage = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(i, f"x{i} {passage} y{i}") for i in range(6)], "doc_id bigint, text string")
    rows = substring.repeated_runs(docs).groupBy("doc_id").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    merged = rows.mapInArrow(substring._merge, "doc_id bigint, runs array<struct<first: int, count: int>>").collect()
    assert sorted((r.doc_id, [tuple(x) for x in r.runs]) for r in merged) == [(i, [(1, 351)]) for i in range(1, 6)]


def test_unlinked_texts_of_one_pool(spark, monkeypatch):
    """Texts built from the same passages share every shingle but link rarely: few pairs are verified."""
    import random

    chance = random.Random(6)
    pool = [" ".join(f"p{k}w{i}" for i in range(12)) for k in range(30)]
    texts = {i: " ".join(chance.sample(pool, 6)) for i in range(120)}
    texts |= {200 + i: texts[i] + " end" for i in range(10)}
    verified, plain = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: (verified.append(pairs.count()), plain(pairs, *a))[1])
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_components(docs).collect()} == components(texts)
    assert sum(verified) < len(texts) ** 2 / 8


def test_repeats_of_awkward_rows(spark, awkward, nothing):
    got = substring.remove_repeats(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got}
    assert (by_id[9].n_removed, by_id[8].n_removed, by_id[1].n_words, by_id[3].n_words) == (60_000, 0, 0, 0)
    assert substring.remove_repeats(nothing).count() == 0


def test_components_of_the_given_table(spark, small_texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_shingle_join(spark, SMALL).collect()}
    assert got == components(small_texts)
    assert len({c for _, c in got.values()}) < len(got)


def near_copies():
    """Groups of near copies at and around the threshold, with copies and chains."""
    texts = {}
    for base in range(4):
        own = [f"b{base}w{i}" for i in range(60)]
        for k in range(25):
            edited = list(own)
            for place in range(0, k % 5):
                edited[place * 12 + (k * 7) % 11] = f"e{base}-{k if k % 2 else 0}-{place}"
            texts[len(texts) * 3 + 5] = " ".join(edited)
        texts[len(texts) * 3 + 5] = " ".join(own[:48])
        texts[len(texts) * 3 + 5] = " ".join(own).upper()
        # A chain: each shares most with its neighbour only.
        for k in range(8):
            texts[len(texts) * 3 + 5] = " ".join([f"c{base}w{i}" for i in range(k * 4, k * 4 + 44)])
    return texts | {1: "one two", 2: "ONE\ttwo", 3: "one", 4: None, 6: "", 7: " \n ", 9: "one two three four five", 10: "one two three four five six"}


def test_components_near_the_threshold(spark):
    texts = near_copies()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumns({"class": F.lit(1), "h": F.lit("x")})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked_components(docs.repartition(4)).collect()}
    assert got == components(texts)
    kept = {r.doc_id for r in jaccard.one_of_each_component(docs).collect()}
    assert kept == {i for i, (_, c) in components(texts).items() if i == c}


def test_components_of_awkward_rows(spark, awkward, nothing):
    got = jaccard.linked_components(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r.component_id for r in got}
    assert (by_id[5], by_id[9], by_id[1], by_id[12], by_id[2]) == (4, 8, 1, 12, 2)
    assert jaccard.linked_components(nothing).count() == 0
    assert jaccard.one_of_each_component(awkward).columns == awkward.columns
    # One id with two sets holds both together; a row without an id follows its set.
    torn = [(1, "a b c d e f"), (2, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (None, "p q r s t u"), (None, "lone one")]
    rows = jaccard.linked_components(spark.createDataFrame(torn, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 1), (3, 1)]


def best(vectors, queries_, k):
    """query, rank, vector, score; vectors by id."""
    out = []
    ints = {i: [math.floor(64 * float(x)) for x in v] for i, v in vectors.items()}
    for q in queries_:
        scores = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_search_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: list(r.embedding) for r in rows}
    got = sorted(tuple(r) for r in queries.op4_integer_top_k(spark, SMALL).select("query_id", "rank", "vec_id", "score").collect())
    assert got == best(vectors, [i for i in vectors if i % 20 == 0], 20)


def test_search_in_small_blocks(spark, monkeypatch):
    """Many blocks and stripes, ties, unusable vectors and large components."""
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "FIRST_BLOCKS", 2)
    monkeypatch.setattr(topk, "CHUNK_BYTES", 40)
    monkeypatch.setattr(topk, "STEP", 2)
    vectors = {i: [((i * 37 + d * 11) % 23 - 11) / 7 for d in range(5)] for i in range(1, 90)}
    vectors |= {90: vectors[3], 91: vectors[3], 92: [0.0] * 5, 93: [1e7, -1e7, 3.0, 0.0, 1.0]}
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] * 5), (104, []), (None, [1.0] * 5)]
    df = spark.createDataFrame([*vectors.items(), *bad], "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    got = sorted(tuple(r) for r in topk.top_k(df.repartition(4), F.col("vec_id") % 9 == 0, 4).collect())
    assert got == best(vectors, [i for i in vectors if i % 9 == 0], 4)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 9 == 0, 4).count() == 0
    few = df.where("vec_id in (9, 10, 11)")
    assert [r.vec_id for r in topk.top_k(few, F.col("vec_id") == 9, 4).orderBy("rank").collect()] == [v for _, _, v, _ in best({i: vectors[i] for i in (9, 10, 11)}, [9], 4)]


def test_search_of_repeated_and_odd_vectors(spark, monkeypatch):
    """Rows that repeat an id, vectors of another length, and floors that leave blocks out."""
    import random

    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "STEP", 2)
    chance = random.Random(7)
    rows = [(i, [chance.uniform(-1, 1) * (20 if i < 12 else 1) for _ in range(6)]) for i in range(150)]
    rows += [(10, rows[3][1]), (10, [0.5] * 6), (20, rows[20][1]), (200, [1.0] * 5), (201, [1.0] * 7), (202, [9.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if len(v) == 6]
    want = []
    for q in sorted({i for i, _ in whole if i % 10 == 0}):
        asked = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(asked, v)), i) for i, v in whole if i != q)[:5]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    got = sorted(tuple(r) for r in topk.top_k(df.repartition(3), F.col("vec_id") % 10 == 0, 5).collect())
    assert got == want
