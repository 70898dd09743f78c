"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams it contains (presence, not counts). Each is scaled by
the log ratio of its smoothed frequency in texts of either label, and a logistic regression is
fitted on the scaled features.

Fitting uses a bounded sample: about `max_docs` labelled documents of each label, chosen by a hash
of the id. Scoring covers every text, whole.

Defined cases: a null or empty text has no feature and gets the score of the intercept. Labels
that are null take no part; rows that repeat an id with the same label count once. With no
labelled rows, or one label only, every score is the share of label 1 (0 without rows). Repeated
rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.letters import SLICE_BYTES, Grams
from tallybook.llm.spread import broadcast_if_small
from tallybook.llm.text import slices
from tallybook.session import RowCounter, materialize

WIDTH = 6
BUCKETS = 1 << 21
#: Fitted on about this many documents of each label.
MAX_DOCS = 3000
#: Features in fewer sampled documents, or with a ratio nearer to 0, are left out.
MIN_DOCS = 6
MIN_RATIO = 1.5
EPOCHS = 15
RATE = 0.02
DECAY = 1e-2
#: Fixed value: a score from here on predicts label 1.
THRESHOLD = 0.3


@dataclass
class Model:
    """Non-zero products of ratio and weight, by bucket, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def _present(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs."""
    grams = Grams(rows.column("text"), WIDTH)
    pairs = np.unique(grams.owner.astype(np.int64) * BUCKETS + (grams.hashes & np.uint64(BUCKETS - 1)).astype(np.int64))
    return pairs // BUCKETS, pairs % BUCKETS


def _features(batches):
    """label and the sorted distinct buckets of each text, as 32-bit integers."""
    for batch in batches:
        for rows, _, _ in slices(batch, size=SLICE_BYTES):
            owner, bucket = _present(rows)
            cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
            packed = [bucket[a:b].astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("toxic"), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "buckets"]
            )


def _bucket_counts(batches):
    """bucket, positives, negatives: documents that contain it, counted per batch."""
    for batch in batches:
        label = np.array(batch.column("toxic").to_pylist(), dtype=bool)
        lists = [np.frombuffer(b, "<i4") for b in batch.column("buckets").to_pylist()]
        found = {}
        for kind in (True, False):
            own = [x for x, y in zip(lists, label) if y == kind]
            found[kind] = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, "<i4"), np.zeros(0, int))
        for kind, (values, counts) in found.items():
            zero = np.zeros(len(values), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values), pa.array(counts if kind else zero, pa.int64()), pa.array(zero if kind else counts, pa.int64())],
                names=["bucket", "pos", "neg"],
            )


def _label_counts(labelled: DataFrame) -> tuple[int, int]:
    """Rows with label 1 and with label 0."""
    per_label = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    return per_label.get(1, 0), per_label.get(0, 0)


def _sampled(labelled: DataFrame, pos: int, neg: int, max_docs: int) -> DataFrame:
    """The rows whose hashed id falls into their label's share."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("toxic") == 1, F.lit(max_docs / max(1, pos))).otherwise(F.lit(max_docs / max(1, neg)))
    return labelled.where(place < share)


def fit(labelled: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Model from rows (doc_id, text, toxic) with labels 0 and 1."""
    labelled = labelled.where("toxic is not null")
    pos, neg = _label_counts(labelled)
    return _fit(_sampled(labelled, pos, neg, max_docs), pos, neg)


def fit_documents(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """The same from documents (doc_id, text) and labels (doc_id, toxic).

    Counts and sample come from a join of the ids alone; texts are read for sampled ids only, so
    none is shuffled while the sample can be broadcast.
    """
    labels = labels.select("doc_id", "toxic").where("toxic is not null").distinct()
    labelled = materialize(docs.select("doc_id").join(labels, "doc_id"), "labelled")
    pos, neg = _label_counts(labelled)
    seen = RowCounter()
    chosen = materialize(seen.watch(_sampled(labelled, pos, neg, max_docs).distinct()), "chosen")
    sample = docs.select("doc_id", "text").join(broadcast_if_small(chosen, seen.rows), "doc_id")
    return _fit(sample, pos, neg)


def _fit(sample: DataFrame, pos: int, neg: int) -> Model:
    """Model from sampled rows, given the number of rows of each label."""
    if not pos or not neg:
        share = pos / (pos + neg) if pos + neg else 0.0
        return Model(np.zeros(0, np.int32), np.zeros(0), float(np.log(share / (1 - share))) if 0 < share < 1 else 50.0 * (2 * share - 1))
    sample = sample.select("doc_id", "toxic", "text")
    features = materialize(sample.mapInArrow(_features, "doc_id bigint, toxic int, buckets binary"), "features")
    counts = features.mapInArrow(_bucket_counts, "bucket int, pos bigint, neg bigint").groupBy("bucket").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    ones = features.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    total_pos, total_neg = int(ones[0] or 0), int(ones[1] - (ones[0] or 0))
    ratio = F.log((F.col("pos") + 1) / F.lit(total_pos + 2.0)) - F.log((F.col("neg") + 1) / F.lit(total_neg + 2.0))
    # Bounded by the number of buckets.
    kept = counts.where(F.col("pos") + F.col("neg") >= MIN_DOCS).select("bucket", ratio.alias("ratio")).where(F.abs("ratio") >= MIN_RATIO)
    table = kept.orderBy("bucket").toArrow()
    buckets, ratios = table.column("bucket").to_numpy(), table.column("ratio").to_numpy()
    if not len(buckets):
        return Model(np.zeros(0, np.int32), np.zeros(0), float(np.log(pos / neg)))
    column = np.full(BUCKETS, -1, dtype=np.int32)
    column[buckets] = np.arange(len(buckets), dtype=np.int32)
    prior = float(np.log(pos / neg) - np.log(max(1, total_pos) / max(1, total_neg)))
    shared = features.sparkSession.sparkContext.broadcast((buckets, ratios))

    def reduced(batches):
        """Only the features that are kept, by column."""
        at = np.full(BUCKETS, -1, dtype=np.int32)
        at[shared.value[0]] = np.arange(len(shared.value[0]), dtype=np.int32)
        for batch in batches:
            packed = []
            for raw in batch.column("buckets").to_pylist():
                own = at[np.frombuffer(raw, "<i4")]
                packed.append(own[own >= 0].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "columns"]
            )

    # Bounded by max_docs documents of each label.
    rows = features.mapInArrow(reduced, "doc_id bigint, toxic int, columns binary").orderBy("doc_id", "toxic", "columns").toArrow()
    columns = [np.frombuffer(b, "<i4") for b in rows.column("columns").to_pylist()]
    weights, intercept = _regression(columns, rows.column("toxic").to_numpy(), ratios)
    used = weights != 0
    return Model(buckets[used], (weights * ratios)[used], intercept + prior)


def _regression(columns: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by gradient steps with per-feature rates, in a fixed random order."""
    weights, squares = np.zeros(len(ratios)), np.full(len(ratios), 1e-8)
    intercept, square = 0.0, 1e-8
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(columns)):
            own = columns[i]
            x = ratios[own]
            slope = 1 / (1 + np.exp(-np.clip(intercept + x @ weights[own], -50, 50))) - labels[i]
            step = slope * x + DECAY * weights[own]
            squares[own] += step * step
            weights[own] -= RATE * step / np.sqrt(squares[own])
            square += slope * slope
            intercept -= RATE * slope / np.sqrt(square)
    return weights, float(intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows of `docs` (doc_id, text and others that are passed on) with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.weights, model.intercept))
    schema = docs.drop("text").schema
    passed = [f.name for f in schema]

    def scored(batches):
        buckets, weights, intercept = shared.value
        table = np.zeros(BUCKETS, dtype=np.float32)
        table[buckets] = weights
        used = np.zeros(BUCKETS, dtype=bool)
        used[buckets] = True
        for batch in batches:
            for rows, _, _ in slices(batch, size=SLICE_BYTES):
                grams = Grams(rows.column("text"), WIDTH)
                bucket = (grams.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
                seen = used[bucket]
                pairs = np.unique(grams.owner[seen].astype(np.int64) * BUCKETS + bucket[seen])
                sums = np.bincount(pairs // BUCKETS, weights=table[pairs % BUCKETS], minlength=len(rows))
                values = 1 / (1 + np.exp(-np.clip(sums + intercept, -50, 50)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n) for n in passed] + [pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))],
                    names=[*passed, "score", "predicted"],
                )

    return docs.mapInArrow(scored, schema.add("score", "double").add("predicted", "integer"))
