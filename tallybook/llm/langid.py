"""Language identification with bit-sliced Bloom filters over character n-grams.

One array of bit masks serves all languages: bit l of a slot belongs to the filter of language
l, so ANDing the slots of an n-gram returns all languages that contain it at once. A text's
votes for a language are the popcount of that bit over its n-grams, less what a filter of that
density lets through by chance.

Fitting uses a bounded sample: about `max_docs` labelled documents per language, chosen by a hash
of the id. Prediction covers every text, whole.

The filters hold a selection of each language's n-grams: those seen MIN_COUNT times in the sample
(once, if the sample has under SMALL n-grams), with a rate of at least SHARE of the n-gram's
highest rate in any language, and of these the MAX_GRAMS most frequent. Every language with a
labelled text is in the list.

A text is known, for those who keep only such texts, if the evidence for its best language is
beyond chance and not far below that language's own texts.

Defined cases: a null text or one without letters gives `und` with score 0. A text with letters
but without a vote goes to the first language, score 0; equal votes go to the first language by
code point. Without labelled rows every text is `und`. Repeated rows are predicted alike; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.letters import SLICE_BYTES, Grams
from tallybook.llm.text import releasing, slices

UNKNOWN = "und"
#: N-gram width; about this many documents per language are fitted on; n-grams per filter.
WIDTH = 4
MAX_DOCS = 2000
MAX_GRAMS = 100_000
#: An n-gram enters a language's filter if its rate there is this share of its highest rate.
SHARE = 0.3
MIN_COUNT = 3
#: A language with fewer n-grams in its sample is too little known to ask for repeats, and its
#: rates count as if it had this many more: they can't take an n-gram from a large language.
SMALL = 20_000
#: A text is known if so few texts without any of its language's n-grams would have as many hits,
#: and if it has this part of the hits that an unseen text of the language has.
ALPHA = 1e-3
KNOWN = 0.3
#: Slots and hash functions of the filters: at most 3 * 100 000 bits of 2^20 are set, so at most
#: one n-gram in 64 passes by chance.
SLOTS = 1 << 20
PROBES = 3


@dataclass
class Filters:
    """Bit-sliced filters; `planes` has one 64-bit mask per slot for each 64 languages."""

    languages: list[str]
    planes: np.ndarray
    #: Part of the n-grams of an unseen text of the language that its filter holds.
    coverage: np.ndarray | None = None

    @staticmethod
    def build(languages: list[str], grams: dict[str, np.ndarray], coverage: np.ndarray | None = None) -> Filters:
        planes = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), dtype=np.uint64)
        for number, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(number % 64)
            for slots in _probes(grams[language].astype(np.int64).view(np.uint64)):
                planes[number // 64][slots] |= bit
        return Filters(languages, planes, coverage)

    def chance(self) -> np.ndarray:
        """For each language, how often its filter accepts an n-gram it doesn't hold."""
        bits = [self.planes[n // 64] >> np.uint64(n % 64) & np.uint64(1) for n in range(len(self.languages))]
        return np.array([b.mean() ** PROBES for b in bits])

    def votes(self, grams: Grams) -> np.ndarray:
        """Corrected votes, one row per text and one column per language."""
        out = np.zeros((len(grams.letters), len(self.languages)))
        found = []
        for plane in self.planes:
            mask = None
            for slots in _probes(grams.hashes):
                mask = plane[slots] if mask is None else mask & plane[slots]
            found.append(mask)
        chance = self.chance()
        for number in range(len(self.languages)):
            bit = found[number // 64] >> np.uint64(number % 64) & np.uint64(1)
            hits = np.bincount(grams.owner, weights=bit, minlength=len(grams.letters))
            rate = chance[number]
            out[:, number] = np.maximum(0.0, (hits - grams.letters * rate) / max(1e-9, 1 - rate))
        return out


def _probes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    for n in range(PROBES):
        yield ((hashes >> np.uint64(21 * n)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _count_grams(batches):
    """lang, gram, n: n-grams of the labelled texts, counted per run of rows."""
    for batch in batches:
        for rows, _, _ in slices(batch, size=SLICE_BYTES):
            grams = Grams(rows.column("text"), WIDTH)
            langs = np.array(rows.column("lang").to_pylist(), dtype=object)[grams.owner]
            for lang in sorted(set(langs)):
                values, counts = np.unique(grams.hashes[langs == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )


def fit(labelled: DataFrame, max_docs: int = MAX_DOCS, max_grams: int = MAX_GRAMS) -> Filters:
    """Filters from labelled rows (doc_id, text, lang), on about `max_docs` of each language."""
    labelled = labelled.where("lang is not null and text is not null")
    # One row for each language.
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    shares = [(r.lang, min(1.0, max_docs / r.n)) for r in sizes]
    share = labelled.sparkSession.createDataFrame(shares, "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.join(F.broadcast(share), "lang").where(place < F.col("share")).select("lang", "text")
    counts = sample.mapInArrow(releasing(_count_grams), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
    seen = (F.col("n") >= MIN_COUNT) | (F.col("total") < SMALL)
    counts = counts.where(seen).withColumn("rate", F.col("n") / F.col("total"))
    # Rare n-grams and rates of small samples are no ground to leave an n-gram out elsewhere.
    sure = F.when(F.col("n") >= MIN_COUNT, F.col("n") / (F.col("total") + SMALL))
    chosen = (
        counts.withColumn("best", F.coalesce(F.max(sure).over(Window.partitionBy("gram")), F.lit(0.0)))
        .where(F.col("rate") >= F.col("best") * SHARE)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
        .where(F.col("rank") <= max_grams)
        .select("lang", "gram", "n", "total")
    )
    # Bounded: at most max_grams rows for each language.
    table = chosen.toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    grams, n, total = (table.column(c).to_numpy() for c in ("gram", "n", "total"))
    languages = sorted({r.lang for r in sizes}, key=lambda s: s.encode())
    # Each occurrence counts if the n-gram would be in the filter without it.
    lasting = np.where(n > np.where(total < SMALL, 1, MIN_COUNT), n / np.maximum(total, 1), 0.0)
    coverage = np.array([lasting[langs == name].sum() for name in languages])
    return Filters.build(languages, {name: grams[langs == name] for name in languages}, coverage)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """All rows of `docs` (doc_id, text and others that are passed on) with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.planes))
    schema = docs.drop("text").schema
    passed = [f.name for f in schema]

    def scored(batches):
        names, planes = shared.value
        model = Filters(names, planes)
        for batch in batches:
            for rows, _, _ in slices(batch, size=SLICE_BYTES):
                grams = Grams(rows.column("text"), WIDTH)
                pred = np.full(len(rows), UNKNOWN, dtype=object)
                score = np.zeros(len(rows))
                if names:
                    votes = model.votes(grams)
                    best = votes.argmax(axis=1)
                    total = votes.sum(axis=1)
                    some = grams.letters > 0
                    pred[some] = np.array(names, dtype=object)[best[some]]
                    score = np.where(some & (total > 0), votes[np.arange(len(rows)), best] / np.where(total > 0, total, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n) for n in passed] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    names=[*passed, "lang_pred", "score"],
                )

    out = schema.add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(releasing(scored), out)


def is_known(votes: np.ndarray, letters: np.ndarray, filters: Filters) -> np.ndarray:
    """Whether the votes show that a text is in one of the languages; their number plays no part.

    For its best language a text needs more hits than chance gives (by a bound on the tail of
    the binomial distribution, shared among the languages) and KNOWN of the hits that an unseen
    text of that language has.
    """
    if not filters.languages:
        return np.zeros(len(letters), dtype=bool)
    best = votes.argmax(axis=1)
    share = votes[np.arange(len(letters)), best] / np.maximum(letters, 1)
    chance = np.clip(filters.chance()[best], 1e-12, 1 - 1e-9)
    rate = np.clip(chance + share * (1 - chance), 1e-12, 1 - 1e-12)
    unlike = rate * np.log(rate / chance) + (1 - rate) * np.log((1 - rate) / (1 - chance))
    surely = (rate > chance) & (letters * unlike >= np.log(len(filters.languages) / ALPHA))
    return (letters > 0) & surely & (share >= KNOWN * filters.coverage[best])


def known_texts(docs: DataFrame, filters: Filters) -> DataFrame:
    """The rows of `docs` (with a column `text`), all columns, whose text is in one of the languages."""
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.planes, filters.coverage))

    def kept(batches):
        model = Filters(*shared.value)
        for batch in batches:
            for rows, _, _ in slices(batch, size=SLICE_BYTES):
                grams = Grams(rows.column("text"), WIDTH)
                known = is_known(model.votes(grams), grams.letters, model)
                if known.any():
                    yield rows.filter(pa.array(known))

    return docs.mapInArrow(releasing(kept), docs.schema)
