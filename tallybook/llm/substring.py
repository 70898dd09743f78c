"""Substring duplicates of at least `length` words by seed and extend.

Seeds are winnowed anchors: of the runs of `seed` words in each window of `length` words, the one
with the smallest hash. Equal windows choose the same anchor, so every repeat of `length` words
shares one. The windows that chose an anchor stand in a row; together they span the anchor's
block, which reaches as far to both sides as its windows do.

Documents are joined on anchors, and an anchor seen in one document only is done. A block equal
to one in an earlier document is a repeat as a whole. Where an anchor has several different
blocks, the first document of each is extended window by window: the windows to both sides of
the anchor are compared with those of all others at once, by their hashes. Repeats that touch
are united to maximal ones. No pair of occurrences is ever listed, so the work is linear in the
number of occurrences, however often a passage occurs.

Defined cases: a null or empty text has no words. Texts shorter than `length` words have no
windows and keep all words. A repeat inside one document alone is kept; so are rows without an
id. Rows that repeat an id count as one document and get the union of their repeats. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import broadcast_if_small
from tallybook.llm.text import WORD_BASES, RangeHash, Words, slices
from tallybook.session import RowCounter, materialize

#: Words in a repeat, at least, and words in a seed.
LENGTH = 50
SEED = 16
#: Windows that are compared at once.
WINDOWS = 1 << 14


def _smallest(gram: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of `width` values from each start on, the first one of equals."""
    windows = np.lib.stride_tricks.sliding_window_view(gram, width)
    parts = (start[i : i + WINDOWS] for i in range(0, len(start), WINDOWS))
    return np.concatenate([windows[part].argmin(axis=1) + part for part in parts])


def _anchor_reader(length: int, seed: int):
    def anchors(batches):
        """anchor, block, doc_id, first, count: runs of windows with the same anchor."""
        for batch in batches:
            for rows, buffer, offsets in slices(batch):
                words = Words(buffer, offsets)
                start = words.windows(length)
                if not len(start):
                    continue
                grams = RangeHash(words.hashes, WORD_BASES[0])
                at = np.arange(len(words.hashes) - seed + 1)
                gram = grams(at, at + seed)
                chosen = _smallest(gram, start, length - seed + 1)
                # A run ends where the anchor changes or the next window is in another document.
                change = np.flatnonzero((np.diff(chosen) != 0) | (np.diff(start) != 1)) + 1
                begin = np.concatenate([[0], change])
                end = np.concatenate([change, [len(start)]])
                first = start[begin]
                blocks = RangeHash(words.hashes, WORD_BASES[1])(first, start[end - 1] + length)
                owner = np.searchsorted(words.first, first, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[chosen[begin]].view(np.int64)),
                        pa.array(blocks.view(np.int64)),
                        rows.column("doc_id").take(pa.array(owner)),
                        pa.array((first - words.first[owner]).astype(np.int32)),
                        pa.array((end - begin).astype(np.int32)),
                    ],
                    names=["anchor", "block", "doc_id", "first", "count"],
                )

    return anchors


def _window_reader(length: int):
    def windows(batches):
        """one, two, doc_id, first: both hashes of each window in `runs` of a document."""
        for batch in batches:
            for rows, buffer, offsets in slices(batch):
                words = Words(buffer, offsets)
                runs = rows.column("runs")
                if not len(runs.flatten()):
                    continue
                per_row = np.diff(runs.offsets.to_numpy())
                flat = runs.flatten()
                owner = np.repeat(np.arange(len(rows)), per_row)
                first = flat.field("first").to_numpy().astype(np.int64)
                count = flat.field("count").to_numpy().astype(np.int64)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                owner = np.repeat(owner, count)
                place = np.repeat(first, count) + step
                start = words.first[owner] + place
                # Rows that repeat an id may have other texts: a run outside of this one is not its own.
                inside = start + length <= words.first[owner + 1]
                owner, place, start = owner[inside], place[inside], start[inside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(RangeHash(words.hashes, base)(start, start + length).view(np.int64)) for base in WORD_BASES]
                    + [rows.column("doc_id").take(pa.array(owner)), pa.array(place.astype(np.int32))],
                    names=["one", "two", "doc_id", "first"],
                )

    return windows


def _merge(batches):
    """doc_id, runs: runs of windows that overlap or touch united."""
    for batch in batches:
        runs = batch.column("runs")
        flat = runs.flatten()
        owner = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
        first = flat.field("first").to_numpy().astype(np.int64)
        end = first + flat.field("count").to_numpy()
        order = np.lexsort((first, owner))
        owner, first, end = owner[order], first[order], end[order]
        # Ends seen so far, with documents far apart from each other.
        apart = owner * (int(end.max(initial=0)) + 1)
        reach = np.maximum.accumulate(end + apart) - apart
        fresh = np.ones(len(owner), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (first[1:] > reach[:-1])
        begins = np.flatnonzero(fresh)
        ends = np.concatenate([begins[1:], [len(owner)]])[: len(begins)] - 1
        merged = pa.StructArray.from_arrays(
            [pa.array(first[begins].astype(np.int32)), pa.array((reach[ends] - first[begins]).astype(np.int32))], names=["first", "count"]
        )
        cuts = np.searchsorted(owner[begins], np.arange(len(runs) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts), merged)], names=["doc_id", "runs"])


def _remover(length: int, digests: bool):
    def removed(batches):
        for batch in batches:
            for rows, buffer, offsets in slices(batch):
                words = Words(buffer, offsets)
                data = buffer.tobytes()
                n_words, n_removed, kept = [], [], []
                for row, runs in enumerate(rows.column("runs").to_pylist()):
                    begin, end = words.first[row], words.first[row + 1]
                    edge = np.zeros(end - begin + 1, dtype=np.int64)
                    for run in runs or ():
                        if run["first"] < end - begin:
                            edge[run["first"]] += 1
                            edge[min(end - begin, run["first"] + run["count"] - 1 + length)] -= 1
                    stays = np.cumsum(edge[:-1]) == 0
                    own = zip(words.start[begin:end][stays].tolist(), words.end[begin:end][stays].tolist())
                    text = b" ".join([data[a:b] for a, b in own])
                    n_words.append(end - begin)
                    n_removed.append(int(end - begin - stays.sum()))
                    kept.append(hashlib.sha256(text).hexdigest() if digests else text.decode())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256" if digests else "kept"],
                )

    return removed


def repeated_runs(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, first, count: windows first..first+count-1 that start in an earlier document too."""
    shape = "anchor bigint, block bigint, doc_id bigint, first int, count int"
    named = docs.where("doc_id is not null and text is not null")
    anchors = materialize(named.mapInArrow(_anchor_reader(length, seed), shape), "anchors")
    seen = anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"), (F.min("block") < F.max("block")).alias("several")
    )
    # What is joined back on a key is written first: the join then has a shuffle of its own on
    # both sides, in which run-time skew splitting cuts a hot anchor.
    seen = materialize(seen.where("lowest < highest").select("anchor", "several"), "seen")
    shared = materialize(anchors.join(seen, "anchor"), "shared")
    earliest = materialize(shared.groupBy("anchor", "block").agg(F.min("doc_id").alias("earliest")), "earliest")
    placed = materialize(shared.join(earliest, ["anchor", "block"]), "blocks")
    whole = placed.where("doc_id > earliest").select("doc_id", "first", "count")
    rest = placed.where("doc_id = earliest and several").groupBy("doc_id").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    counted = RowCounter()
    rest = materialize(counted.watch(rest), "runs")
    ids = broadcast_if_small(rest.select("doc_id"), counted.rows)
    texts = named.join(ids, "doc_id", "left_semi").join(rest, "doc_id").select("doc_id", "text", "runs")
    windows = materialize(texts.mapInArrow(_window_reader(length), "one bigint, two bigint, doc_id bigint, first int"), "windows")
    first_seen = windows.groupBy("one", "two").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
    first_seen = materialize(first_seen.where("lowest < highest").select("one", "two", "lowest"), "first-seen")
    again = windows.join(first_seen, ["one", "two"])
    single = again.where("doc_id > lowest").select("doc_id", "first", F.lit(1).alias("count"))
    return whole.unionByName(single)


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by a space (or their sha256)."""
    docs = docs.select("doc_id", "text")
    runs = repeated_runs(docs, length, seed).groupBy("doc_id").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    # A passage is one run in a document, however many anchors it has. Runs are counted, not
    # documents: they are what a broadcast would hold.
    per_doc = materialize(runs.mapInArrow(_merge, "doc_id bigint, runs array<struct<first: int, count: int>>"), "repeats")
    n_runs = per_doc.agg(F.sum(F.size("runs"))).first()[0] or 0
    joined = docs.join(broadcast_if_small(per_doc, n_runs), "doc_id", "left").select("doc_id", "text", "runs")
    last = "kept_sha256" if digests else "kept"
    return joined.mapInArrow(_remover(length, digests), f"doc_id bigint, n_words bigint, n_removed bigint, {last} string")
