"""The pipeline against brute force, stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import sentencepiece
from test_pairs_and_search import LOWER, components, words

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402

from tallybook.llm import mixing, queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    state = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        seen[name] = out.collect()
        state = spark.createDataFrame(seen[name], out.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = [r.doc_id for r in seen["language_id"]]
    assert set(known) == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}

    smallest = {}
    for i in sorted(known):
        smallest.setdefault(texts[i].translate(LOWER), i)
    unique = [r.doc_id for r in seen["exact_dedup"]]
    assert sorted(unique) == sorted(smallest.values())

    single = {r.doc_id: r for r in seen["shingle_join"]}
    assert set(single) == {i for i, (_, c) in components({i: texts[i] for i in unique}).items() if i == c}
    assert all(r.text == texts[i] for i, r in single.items())

    mixed = seen["source_mix"]
    taken, sizes = Counter(), Counter()
    for r in mixed:
        taken[r.source] += len(words(r.text))
    for r in single.values():
        sizes[r.source] += len(words(r.text))
    assert {r.doc_id for r in mixed} <= set(single)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    names = sorted(sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped, target = set(), {}
    while True:
        free = [s for s in names if s not in capped]
        spare = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else spare * weight[s] / sum(weight[f] for f in free) for s in names}
        more = {s for s in free if target[s] > 3 * sizes[s]}
        if not more:
            break
        capped |= more
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = Counter((r.doc_id, tuple(r.piece_ids), r.decoded) for r in seen["piece_codec"])
    want = Counter()
    for r in mixed:
        ids = library.encode(r.text)
        want[r.doc_id, tuple(ids), library.decode(ids)] += 1
    assert got == want

    again = Counter((r.doc_id, tuple(r.piece_ids), r.decoded) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert again == got


def test_awkward_rows(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, SMALL)
        assert out.count() == 0
    state = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, state, SMALL)
        assert out.columns == awkward.columns
        state = spark.createDataFrame(out.collect(), out.schema)
    assert state.select("doc_id").distinct().count() > 1


def test_mix_of_many_words(spark, monkeypatch):
    """Words that count for 100 million each: 1.5 billion in all, of which the sources take 2.5, 5 and 7.5 documents."""
    count = mixing.word_count
    monkeypatch.setattr(mixing, "word_count", lambda text: count(text) * 100_000_000)
    docs = spark.createDataFrame([(i, f"w{i}", "abc"[i % 3]) for i in range(15)], "doc_id bigint, text string, source string")
    rows = corpus_pipeline.mix_sources(spark, docs, SMALL).collect()
    assert Counter(r.source for r in rows) == {"a": 3, "b": 5, "c": 8}
    copies = Counter(r.doc_id for r in rows)
    assert sorted(copies[i] for i in range(0, 15, 3)) == [0, 0, 1, 1, 1]
    assert all(copies[i] == 1 for i in range(1, 15, 3))
    assert sorted(copies[i] for i in range(2, 15, 3)) == [1, 1, 2, 2, 2]
    assert all(r.text == f"w{r.doc_id}" for r in rows)


def test_every_operator_is_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
