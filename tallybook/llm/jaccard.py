"""Similarity join of documents on word shingles: grouped prefix join.

A document is the set of its `width`-word shingles. Two documents link when 100 times the size of
their intersection is at least `percent` times that of their union. Only linked components are
asked for, and all of them are found:

1. Documents with equal sets are one class; the rest works on classes.
2. Of the shingles in a fixed part of the hash space, those seen in one class only are counted
   per class. A class with more of them than a link allows is done. That is most of a corpus,
   and costs one aggregate over that part of the shingles.
3. The other classes order their shingles from the rarest to the commonest, and drop those that
   no other class has. The prefix are those from which a link must have at least one in common.
   Classes with the same size and prefix are one group.
4. Groups meet on prefix shingles. A pair passes a shingle only if the shingles that both have
   left from there on can still make a link. In each list, the group with the largest share of
   repeated shingles is the hub, and the others are paired with it; members of a group are paired
   with its first. Those pairs are expanded to members and verified on the whole sets.
5. Groups of a list whose members are all in one component by now need no test. Of the other
   pairs of groups, one has members outside the hub's component; those that pass the filters are
   collected once, however many lists they share, then expanded to members of different
   components and verified.

A list with many near copies thus costs about one test per member, not one per pair. A list of
many groups that are not linked still costs a test of the filters for each pair of groups.

Shingles are told apart by 64-bit hashes and sets by 128-bit ones.

Defined cases: a text of fewer words than `width` has one shingle, all its words. A null text or
one without words has an empty set, which links with nothing, and is its own component. Rows
that repeat an id are one node, so what either links to is one component; each has the size of
its own set. A row without an id takes its set's component. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import broadcast_if_small, connected_components
from tallybook.llm.text import WORD_BASES, RangeHash, Words, releasing, slices
from tallybook.session import RowCounter, materialize

WIDTH = 5
PERCENT = 80
#: Part of the hash space that is looked at first, in 64ths. Unique shingles in it are a lower
#: bound of all unique ones, so any part is exact; below a fifth it would hardly exclude a class.
FIRST_PART = 20

_SET = "doc_id bigint, n_shingles bigint, class bigint, check bigint"


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents in a row, and where each one's begin."""
    grams = RangeHash(words.hashes, WORD_BASES[0])
    at = words.windows(width)
    owner = np.searchsorted(words.first, at, side="right") - 1
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < width))
    hashes = np.concatenate([grams(at, at + width), grams(words.first[short], words.first[short + 1])])
    owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(count) + 1))


def _set_reader(width: int, first_part: int | None):
    """Sets of documents, with the shingles in the first part of the hash space, or all (None)."""
    limit = np.uint64((first_part or 0) << 58)

    def sets(batches):
        for batch in batches:
            for rows, buffer, offsets in slices(batch):
                hashes, cuts = shingle_sets(Words(buffer, offsets, lower=True), width)
                digest = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(cuts, cuts[1:])]
                keys = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                shown, ends = hashes, cuts
                if first_part is not None:
                    low = hashes < limit
                    ends = np.concatenate([[0], np.cumsum(low)])[cuts]
                    shown = hashes[low]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.diff(cuts)),
                        pa.array(keys[:, 0].copy()),
                        pa.array(keys[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(shown.view(np.int64))),
                    ],
                    names=["doc_id", "n_shingles", "class", "check", "shingles"],
                )

    return releasing(sets)


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest intersection that links sets of these sizes."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent)).cast("bigint")


def _allowed_missing(n: Column, percent: int) -> Column:
    """Most shingles of a set of size n that a set linked with it can be without."""
    return n - F.ceil(F.lit(percent) * n / F.lit(100)).cast("bigint")


def _passes(n: Column, left: Column, other_n: Column, other_left: Column, percent: int) -> Column:
    """Whether sets with this many shingles left from a common one can link."""
    return F.least(left, other_left) >= _least_overlap(n, other_n, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among pairs (a, b) of classes, tested on their whole sets."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("set").alias("set_b"))
    same = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(100 * same >= percent * (F.col("n_a") + F.col("n_b") - same))
        .select("a", "b")
    )


def _possible_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """class, n, set: the classes that step 2 leaves."""
    spread = rows.where("n_shingles > 0").select("class", F.explode("shingles").alias("h"))
    owners = spread.groupBy("h").agg(F.min("class").alias("class"), F.max("class").alias("other"))
    alone = owners.where(F.col("class") == F.col("other")).groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    counted = RowCounter()
    possible = (
        classes.join(alone, "class", "left")
        .where(F.coalesce("alone", F.lit(0)) <= _allowed_missing(F.col("n"), percent))
        .select("class", F.col("first_id").alias("doc_id"))
    )
    possible = materialize(counted.watch(possible), "possible")
    ids = broadcast_if_small(possible.select("doc_id").distinct(), counted.rows)
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    found = texts.mapInArrow(_set_reader(width, None), f"{_SET}, shingles array<bigint>")
    found = found.join(possible.select("class").hint("shuffle_hash"), "class", "left_semi")
    return materialize(
        found.select("class", F.col("n_shingles").alias("n"), F.col("shingles").alias("set")).dropDuplicates(["class"]), "sets"
    )


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """class, n, shared, prefix: rarest repeated shingles first. Classes that can't link are gone."""
    spread = sets.select("class", "n", F.explode("set").alias("h"))
    repeated = spread.groupBy("h").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    ordered = (
        spread.join(repeated, "h")
        .groupBy("class", "n")
        .agg(F.sort_array(F.collect_list(F.struct("seen", "h"))).alias("ordered"))
        .withColumn("shared", F.size("ordered").cast("bigint"))
    )
    missing = F.col("n") - F.col("shared")
    length = _allowed_missing(F.col("n"), percent) + 1 - missing
    return ordered.where(length > 0).select(
        "class", "n", "shared", F.transform(F.slice("ordered", F.lit(1), length.cast("int")), lambda x: x["h"]).alias("prefix")
    )


def similar_classes(docs: DataFrame, classes: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) among classes, enough of them to join each component."""
    sets = _possible_sets(docs, classes, rows, width, percent)
    prefixes = materialize(_prefixes(sets, percent), "prefixes")
    groups = prefixes.groupBy("n", "shared", "prefix").agg(F.min("class").alias("group"), F.count(F.lit(1)).alias("members"))
    groups = materialize(groups, "groups")
    # Many members of one group are a hot key here, which run-time skew splitting cuts.
    member = materialize(
        prefixes.join(groups.select("n", "prefix", "group"), ["n", "prefix"]).select("class", "group"), "members"
    )
    places = groups.select("group", "n", "shared", "members", F.posexplode("prefix").alias("at", "h")).select(
        "h", "group", "n", (F.col("shared") - F.col("at")).alias("left"), "shared", "members"
    )
    places = materialize(places, "places")
    hub = F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), "n", "left", "group"))
    hubs = places.groupBy("h").agg(hub.alias("hub"), F.sum("members").alias("members")).where("members > 1")
    hubs = materialize(
        hubs.select("h", F.col("hub.group").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.left").alias("hub_left")), "hubs"
    )
    passing = _passes(F.col("n"), F.col("left"), F.col("hub_n"), F.col("hub_left"), percent)
    with_hub = places.join(hubs, "h").where((F.col("group") != F.col("hub")) & passing).select("group", "hub")
    inside = groups.where("members > 1").select("group", F.col("group").alias("hub"))
    pairs = with_hub.unionByName(inside).distinct()
    pairs = pairs.join(member, "group").select(F.col("class").alias("a"), F.col("hub").alias("b")).where("a <> b")
    links = materialize(_verified(pairs, sets, percent), "hub-links")

    label = materialize(connected_components(links), "labels")

    def labelled(df: DataFrame, key: str, out: str) -> DataFrame:
        named = label.select(F.col("node").alias(key), F.col("component").alias("_label"))
        return df.join(named, key, "left").withColumn(out, F.coalesce("_label", key)).drop("_label")

    member = labelled(member, "class", "label")
    # Groups are paired, not their members: those of one component have one label.
    spans = member.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    lists = places.select("h", "group", "n", "left").join(spans, "group")
    lists = materialize(lists.join(labelled(hubs.select("h", "hub"), "hub", "hub_label"), "h"), "lists")
    other = lists.select("h", *[F.col(c).alias(f"other_{c}") for c in ("group", "low", "high", "n", "left")])
    passing = _passes(F.col("n"), F.col("left"), F.col("other_n"), F.col("other_left"), percent)
    outside = lists.where("low <> hub_label or high <> hub_label").drop("hub", "hub_label")
    apart = F.expr("low <> other_low or high <> other_high or low <> high")
    rest = (
        outside.join(other, (outside["h"] == other["h"]) & apart & passing)
        .select(F.least("group", "other_group").alias("g"), F.greatest("group", "other_group").alias("other_g"))
        .distinct()
    )
    # Only then are the groups that are left expanded, to members of different components.
    left = member.select(F.col("group").alias("g"), F.col("class").alias("a"), "label")
    right = member.select(F.col("group").alias("other_g"), F.col("class").alias("b"), F.col("label").alias("other_label"))
    rest = rest.join(left, "g").join(right, "other_g").where("label <> other_label")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return links.unionByName(_verified(rest, sets, percent))


def linked_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links): one row per row of `docs`."""
    docs = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    rows = materialize(docs.mapInArrow(_set_reader(width, FIRST_PART), f"{_SET}, shingles array<bigint>"), "rows")
    full = rows.where("n_shingles > 0")
    classes = full.groupBy("class", "check").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    classes = materialize(classes, "classes")
    # Rows that repeat an id with another set hold their classes together.
    torn = full.where("doc_id is not null").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b")
    held = full.join(torn.select("doc_id", "a"), "doc_id").select("a", F.col("class").alias("b")).where("a <> b").distinct()
    links = similar_classes(docs, classes, rows, width, percent).unionByName(held)
    label = connected_components(materialize(links, "links"))
    label = materialize(label.select(F.col("node").alias("class"), "component"), "labels")
    roots = classes.join(label, "class", "left").select("class", "first_id", "copies", F.coalesce("component", "class").alias("root"))
    counted = RowCounter()
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("n")).where("n > 1")
    named = materialize(counted.watch(roots.join(smallest, "root").select("class", "component_id")), "named")
    joined = rows.join(broadcast_if_small(named, counted.rows), (rows["class"] == named["class"]) & (F.col("n_shingles") > 0), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_component(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component the smallest id.

    Rows without an id, and rows that repeat an id that stays, stay.
    """
    counted = RowCounter()
    gone = linked_components(docs, id_column, text_column).where("doc_id <> component_id").select("doc_id").distinct()
    gone = materialize(counted.watch(gone), "gone")
    # Whole rows travel as one column, so that their names can't clash with others.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = packed.join(broadcast_if_small(gone, counted.rows), F.col(f"row.`{id_column}`") == F.col("doc_id"), "left_anti")
    return kept.select("row.*")
