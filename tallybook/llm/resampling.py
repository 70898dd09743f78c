"""Importance resampling towards a target corpus, by hashed word n-grams.

Every run of 1 to 2 consecutive words is a feature, hashed into a bucket. A bucket's gain says how
much commoner it is in the target than in the corpus; a document's weight is the mean gain of its
features. Adding Gumbel noise from a hash of the id to the weights and keeping the highest sums
draws documents without replacement, in proportion to the exponentials of their weights.

The corpus counts come from distinct segments. Newlines are separators, so texts are cut into
lines, and each line is reduced to its words. Equal lines are united before their features are
counted, once for each distinct line, and the counts are multiplied by the line's occurrences.
The features that cross from one line with words to the next are segments of their own, of two
words, of which only the pair is counted. Lines are united while they are shuffled, first on the
map side, so a line in every document leaves each task once.

CRC-32 is linear in the bits before a suffix, so the checksum of a pair of words is made from those
of its words by table lookup; checksums of words are computed column by column.

Defined cases: a null text has no words, as has one of separators only; its weight is 0. A target
without words gives its buckets the smoothing count alone. Rows that repeat an id are separate
documents with the same noise, and are ranked by id, number of features and weight; rows without
an id take the noise of an empty one and rank after those of the same score that have one. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import running_totals
from tallybook.llm.text import slices
from tallybook.session import materialize

BUCKETS = 10_000
#: A draw takes this percentage of the documents that have at least MIN_WORDS words.
PERCENT = 25
MIN_WORDS = 20
SEED = 7
#: Words handled at once, so that a huge text needs little more than its bytes.
RUN_WORDS = 1 << 18
#: Words longer than this are checksummed one by one.
SHORT = 64

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = np.where(_WORD, _LOWER, 32).astype(np.uint8)
_PLAIN[10] = 10
#: Word bytes in lower case, newlines kept, other separators as spaces.
_TRANSLATION = _PLAIN.tobytes()


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ np.where(value & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return value


_CRC = _crc_table()


def _shift_tables(longest: int) -> np.ndarray:
    """[n, k, b]: what byte k of a checksum, being b, becomes after n more zero bytes."""
    tables = np.zeros((longest + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(longest + 1):
            tables[n, k] = value
            value = _CRC[value & np.uint32(255)] ^ (value >> np.uint32(8))
    return tables


_SHIFTS = _shift_tables(SHORT + 1)


def word_checksums(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, first: int = 0) -> np.ndarray:
    """CRC-32 of each byte range, as if it followed text with the checksum `first`."""
    length = end - start
    order = np.argsort(-length, kind="stable")
    out = np.full(len(start), np.uint32(first) ^ np.uint32(0xFFFFFFFF), dtype=np.uint32)
    long = int(np.count_nonzero(length > SHORT))
    for i in order[:long]:
        out[i] = zlib.crc32(buffer[start[i] : end[i]].tobytes(), first) ^ 0xFFFFFFFF
    order = order[long:]
    begin, left = start[order], length[order]
    value = out[order]
    for step in range(int(left.max(initial=0))):
        active = int(np.searchsorted(-left, -step, side="left"))
        value[:active] = _CRC[(value[:active] ^ buffer[begin[:active] + step]) & np.uint32(255)] ^ (value[:active] >> np.uint32(8))
    out[order] = value
    return out ^ np.uint32(0xFFFFFFFF)


def _pair_checksums(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, checksums: np.ndarray, left: np.ndarray) -> np.ndarray:
    """CRC-32 of word i, a space and word i + 1, for each i of `left`."""
    right = left + 1
    # " w" checksummed alone, then the first word's checksum carried over its length.
    spaced = _after_space(buffer, start[right], end[right])
    added = end[right] - start[right] + 1
    carried = np.zeros(len(left), dtype=np.uint32)
    near = added <= SHORT + 1
    value, steps = checksums[left][near], added[near]
    for k in range(4):
        carried[near] ^= _SHIFTS[steps, k, (value >> np.uint32(8 * k)) & np.uint32(255)]
    out = carried ^ spaced
    for i in np.flatnonzero(~near):
        word = buffer[start[right[i]] : end[right[i]]].tobytes()
        out[i] = zlib.crc32(b" " + word, int(checksums[left[i]]))
    return out


def _after_space(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return word_checksums(buffer, start, end, zlib.crc32(b" "))


def hashed_features(buffer: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Text number and bucket of each word, then of each pair, for runs of words of these texts."""
    inside = _WORD[buffer]
    edge = np.zeros(len(buffer) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    lower = _LOWER[buffer]
    for begin in range(0, len(starts), RUN_WORDS):
        # One word more than the run, for the pair that crosses into the next one.
        start, end = starts[begin : begin + RUN_WORDS + 1], ends[begin : begin + RUN_WORDS + 1]
        checksums = word_checksums(lower, start, end)
        owner = np.searchsorted(offsets, start, side="right") - 1
        left = np.flatnonzero(owner[1:] == owner[:-1])
        pairs = _pair_checksums(lower, start, end, checksums, left)
        size = np.uint32(buckets)
        yield owner[:RUN_WORDS], (checksums % size)[:RUN_WORDS].astype(np.int64), owner[left], (pairs % size).astype(np.int64)


def segments(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Lines with words, reduced to them, and the pairs of words that cross from one to the next."""
    lines, crossing, last = [], [], None
    for line in text.translate(_TRANSLATION).split(b"\n"):
        words = line.split()
        if words:
            if last is not None:
                crossing.append(last + b" " + words[0])
            lines.append(b" ".join(words))
            last = words[-1]
    return lines, crossing


def _cut(batches):
    """crossing, segment, n: distinct segments of each run of texts."""
    for batch in batches:
        for _, buffer, offsets in slices(batch):
            data = buffer.tobytes()
            lines: Counter[bytes] = Counter()
            crossing: Counter[bytes] = Counter()
            for begin, end in zip(offsets.tolist(), offsets[1:].tolist()):
                own, across = segments(data[begin:end])
                lines.update(own)
                crossing.update(across)
            kinds = [False] * len(lines) + [True] * len(crossing)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds, pa.bool_()),
                    pa.array([*lines, *crossing], pa.binary()),
                    pa.array([*lines.values(), *crossing.values()], pa.int64()),
                ],
                names=["crossing", "segment", "n"],
            )


def _count_segments(buckets: int):
    def counted(batches):
        """bucket, n: features of distinct segments times their occurrences."""
        totals = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            shown = pa.RecordBatch.from_arrays(
                [batch.column("segment").cast(pa.large_binary()).view(pa.large_string()), batch.column("crossing"), batch.column("n")],
                names=["text", "crossing", "n"],
            )
            for rows, buffer, offsets in slices(shown):
                times = rows.column("n").to_numpy()
                whole = ~rows.column("crossing").to_numpy(zero_copy_only=False)
                for owner, words, pair_owner, pairs in hashed_features(buffer, offsets, buckets):
                    np.add.at(totals, words, np.where(whole, times, 0)[owner])
                    np.add.at(totals, pairs, times[pair_owner])
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["bucket", "n"])

    return counted


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of each bucket's features in all texts (a column `text`)."""
    cut = texts.select("text").where("text is not null").mapInArrow(_cut, "crossing boolean, segment binary, n bigint")
    distinct = cut.groupBy("crossing", "segment").agg(F.sum("n").alias("n"))
    counts = distinct.mapInArrow(_count_segments(buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    # One row for each bucket.
    table = counts.toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of target rate over corpus rate, each count raised by one, floored."""
    size, wanted, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (size + buckets) / ((s + 1) * (wanted + buckets)))) for s, t in zip(corpus.tolist(), target.tolist())],
        dtype=np.int64,
    )


def _measure(buffer: np.ndarray, offsets: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, features and sum of gains of each text."""
    n_texts = len(offsets) - 1
    words, pairs, total = np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    for owner, buckets, pair_owner, pair_buckets in hashed_features(buffer, offsets, len(gains)):
        words += np.bincount(owner, minlength=n_texts)
        pairs += np.bincount(pair_owner, minlength=n_texts)
        np.add.at(total, owner, gains[buckets])
        np.add.at(total, pair_owner, gains[pair_buckets])
    return words, words + pairs, total


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean of gains over a document's features."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weighed(batches):
        for batch in batches:
            for rows, buffer, offsets in slices(batch):
                words, features, total = _measure(buffer, offsets, shared.value)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(words), pa.array(features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(weighed, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank; documents that are not drawn have no rank.

    `target` has a column `text`. Ranks come from range partitions and prefix sums of their sizes,
    so no task holds more than its range of the drawn documents.
    """
    docs = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    gains = bucket_gains(feature_counts(docs, buckets), feature_counts(target, buckets))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    place = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000 * F.log(-F.log(place))).cast("bigint")
    scored = weigh(docs, gains).withColumn("score", F.col("weight") + noise)
    scored = materialize(scored.withColumn("fits", F.col("n_words") >= min_words), "scored")
    fits = scored.where("fits")
    drawn = fits.count() * percent // 100
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = running_totals(fits, [], order, F.lit(1), partitions)
    rank = F.when(F.col("before") < drawn, F.col("before") + 1).cast("bigint")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, rank.alias("rank"))
    return ranked.unionByName(scored.where("not fits").select(*columns, F.lit(None).cast("bigint").alias("rank")))
