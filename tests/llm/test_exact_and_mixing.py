import hashlib
from collections import defaultdict

import check_queries
import pytest
from pyspark.sql import functions as F

from tallybook.llm import exact, mixing, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("path", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, name, path):
    df = queries.QUERIES[name](spark, path)
    cursor = check_queries.duckdb_views(path).execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert check_queries.compare([tuple(r) for r in df.collect()], df.columns, cursor.fetchall(), names) is None


def brute_groups(rows, best):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(UPPER)].append(r.doc_id)
    return sorted(
        (r.doc_id, best(groups[t]), len(groups[t]), r.doc_id == best(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        for r in rows
        for t in [(r.text or "").translate(UPPER)]
    )


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("fingerprint", [F.md5, F.length, lambda c: F.lit(1)])
def test_groups_of_awkward_rows(awkward, keep, best, fingerprint):
    """Also with fingerprints that collide."""
    found = exact.exact_groups(awkward, keep=keep, fingerprint=fingerprint)
    assert sorted(map(tuple, found.collect())) == brute_groups(awkward.collect(), best)


def test_native_plan_and_empty_table(awkward, nothing):
    plan = exact.exact_groups(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
    assert exact.exact_groups(nothing).count() == 0 and exact.drop_copies(nothing).count() == 0


def test_drop_copies(awkward, spark):
    kept = exact.drop_copies(awkward, keep="largest")
    assert kept.columns == awkward.columns
    found = sorted(r.doc_id for r in kept.collect())
    expected = sorted({max(d for d, t in ids) for ids in by_text(awkward.collect()).values()})
    assert found == expected
    no_ids = spark.createDataFrame([(None, "a"), (None, "A"), (None, "b"), (5, "b")], "doc_id bigint, text string")
    assert sorted((str(r.doc_id), r.text.lower()) for r in exact.drop_copies(no_ids).collect()) == [("5", "b"), ("None", "a")]


def by_text(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(UPPER)].append((r.doc_id, r.text))
    return groups


def test_mix_of_awkward_rows(awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    total = sum(r["size"] for r in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - total) <= 6
    again = mixing.mix(awkward.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_mixed_documents_hold_what_is_taken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    found = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        found[r.doc_id] += len(r.text.split())
    assert {d: n for d, n in taken.items() if n} == {d: n for d, n in found.items() if n}


def test_only_blank_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, " ", None)], "doc_id bigint, text string, source string")
    assert sorted(tuple(r) for r in mixing.mix(docs).collect()) == [(i, 0, 0, 0.0, 0, 0) for i in (1, 2, 3)]


@pytest.mark.parametrize("total", [700_000_000, 716_000_000, 1_600_000_000, 2**31 - 1, 2**31 + 1, 2**60])
def test_targets_of_many_words(spark, total):
    """Products of sums and weights pass 32 bits from 716 million words on, and 64 bits at the last size."""
    sizes = {None: total // 4, "a": total // 4, "b": 5, "c": total - 2 * (total // 4) - 5}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    weight = {"a": 1, "b": 2, "c": 3, None: 1}
    # b stops at three times its size; the others share the rest.
    spare = total - 15
    found = {r.source: (r.source_size, r.target) for r in mixing.source_targets(df, 4).collect()}
    assert found == {s: (n, 15.0 if s == "b" else float(weight[s] * spare) / 5) for s, n in sizes.items()}
