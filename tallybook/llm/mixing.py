"""Mixing sources to target weights by distributed prefix sums over a random order.

DataFrame functions only. Each source's documents get a hash-random key and are range-sorted by
it; prefix sums of their sizes, carried from range to range, show where the source's budget
ends. A budget above the source's size takes whole epochs first. The hot source is many ranges.

Defined cases: a null text has size 0; null is a source of its own, last in the order; a source
of size 0 gets target 0. Rows that repeat an id are each a document of their own, in a fixed
order. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import broadcast_if_small, running_totals
from tallybook.session import RowCounter, materialize

#: Weights of the sources in their order, repeating; most epochs of one source.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, partitions: int, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from (source, source_size).

    Sources share the total by weight. Those above `max_epochs` times their size stop there, and
    the rest is shared again by weight until none is above. Each round is one aggregate; only
    its two sums reach the driver. Products of weights and sums are exact decimals: a sum read back
    on the driver is a 32-bit literal if it fits, and its product may not.
    """
    ranked = running_totals(sizes, [], [F.col("source").asc_nulls_last()], F.lit(1), partitions)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("before", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialize(
        ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("most")),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    spare, heavy = total, ranked.agg(F.sum("weight")).first()[0] or 1
    while True:
        # A source is capped if its share of what the others leave is above its limit.
        due = F.col("weight") * F.lit(spare).cast("decimal(38,0)")
        capped = due > F.col("most") * F.lit(heavy).cast("decimal(38,0)")
        fixed, free = ranked.agg(
            F.sum(F.when(capped, F.col("most")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))
        ).first()
        if not free or (total - fixed, free) == (spare, heavy):
            break
        spare, heavy = total - fixed, free
    share = due.cast("double") / F.lit(heavy)
    return ranked.select(
        "source", "source_size", F.when(capped, F.col("most").cast("double")).otherwise(share).alias("target")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, size, source_size, target, taken, position: one row per document.

    `taken` counts the words that the mix takes of the document, repeats included: its size once
    per full epoch, and in the last epoch what the budget still allows at the document's place.
    `position` is the number of words of its source that precede it in the random order.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col(f"`{id_column}`").cast("string"))), 1, 16).alias("key"),
    )
    order = [F.col("key"), F.col("doc_id"), F.col("size")]
    placed = materialize(running_totals(rows, ["source"], order, F.col("size"), partitions), "placed")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, partitions, weights, max_epochs), "targets")
    targets = targets.withColumnRenamed("source", "_source")
    joined = placed.join(targets, placed["source"].eqNullSafe(targets["_source"]))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - epochs * F.col("source_size")
    last = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("bigint").alias("taken"),
        F.col("before").cast("bigint").alias("position"),
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept.

    A document at the end of its source's budget is taken for its first words only in that last
    copy; a document without words is taken once.
    """
    seen = RowCounter()
    taken = mix(docs, id_column, text_column, source_column).groupBy("doc_id", "size").agg(F.max("taken").alias("taken"))
    taken = broadcast_if_small(materialize(seen.watch(taken), "taken"), seen.rows)
    # Whole rows travel as one column, so that their names can't clash with others.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own_id, text = F.col(f"row.`{id_column}`"), F.col(f"row.`{text_column}`")
    joined = packed.join(taken, own_id.eqNullSafe(F.col("doc_id")) & (word_count(text) == F.col("size")))
    some = F.col("size") > 0
    full = F.when(some, F.floor(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    part = F.when(some, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    # One entry per copy: null for a whole one, else the number of words.
    copies = F.concat(F.array_repeat(F.lit(None).cast("int"), full), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = joined.select("row", F.explode(copies).alias("cut"))
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("cut")), " ")
    cut = F.when(F.col("cut").isNull(), text).otherwise(words)
    return rows.withColumn("row", F.col("row").withField(f"`{text_column}`", cut)).select("row.*")
