"""Mixing sources to target weights along a time-varying curriculum.

**Targets.** Sources weigh 3, 1, 2, repeating in code point order, and share a token budget by weight;
a target stops at ``most`` times its source's size and the excess goes to the others by weight, until
none is above. That is the level at which the capped demands add up to the budget, found from running
sums over the sources ordered by how soon they fill.

**Curriculum.** A source's weight over training time t in [0, 1] follows its schedule
``1 + tilt * (1 - 2 t)``. Its integral, the cumulative demand ``t + tilt * (t - t*t)``, tells what share of the source's
target has been used up by t; inverted, it gives the time at which a document at a given place among its
source's tokens is due. Early sources (positive tilt) are dense at the start, late ones at the end.

**Documents.** Within a source documents stand in hash order and are taken in passes, each document
whole; only the one at the border of the target is cut, so that sources meet their targets to the
word. No document is taken more than ``most`` times. Running sums are made in two levels, slices of the
hash range and rows inside a slice, so a source with any share of the rows is spread over many tasks.

Defined cases: a null or empty text has size 0 and is never taken. The null source comes last. Rows that
repeat an id stand next to each other and each is taken for itself. Empty tables give empty results. The order depends on
ids and texts only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD_PATTERN, text_of, written

# Fixed values of the contract: weights by rank of the source, and the share of all words that is mixed.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
# Schedules by rank of the source: early, steady, late.
TILTS = (0.5, 0.0, -0.5)
ROWS_PER_SLICE = 25_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def _by_rank(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, share: float = SHARE, most: int = 2, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size); a table of one row per source.

    Sources are ordered by the level at which they fill. With f full, the level of the others is
    (budget - caps of the full ones) / (weights of the others); the first that does not fill at it ends
    the full ones.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source").isNull(), "source")
    filling = Window.orderBy("fills_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("rank", F.row_number().over(named)).withColumn(
        "weight", _by_rank(weights, F.col("rank")).cast("double")
    )
    levels = (
        ranked.withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(filling), F.lit(0.0)))
        .withColumn(
            "weights_left",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)),
        )
        .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("open", F.when(F.col("level") <= F.col("fills_at"), F.struct("fills_at", "rank")))
        .withColumn("final", F.min_by("level", "open").over(everything))
    )
    return levels.select(
        "source", "source_size", "rank",
        F.least("cap", F.col("weight") * F.coalesce("final", "fills_at")).alias("target"),
    )


def _place() -> Column:
    """Hash of id and text: the order of a source's documents."""
    return F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text")))


def _placed(docs: DataFrame, most: int, options: dict) -> DataFrame:
    """Each document's size, its source's target and the words of the source before it."""
    sized = docs.withColumn("__size", word_count(text_of("text")))
    narrow = written(
        sized.select("doc_id", "source", F.col("__size").alias("size"), _place().alias("place")), "sizes"
    )
    slices = max(64, -(-narrow.count() // ROWS_PER_SLICE))
    # Equal slices of the range of hashes.
    part = F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * slices
    narrow = narrow.withColumn("slice", F.shiftright(part, 32).cast("int"))
    sums = written(narrow.groupBy("source", "slice").agg(F.sum("size").alias("in_slice")), "slices")
    sources = targets(sums.groupBy("source").agg(F.sum("in_slice").alias("source_size")), most=most, **options)
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("slice_start", F.coalesce(F.sum("in_slice").over(before), F.lit(0)))
    s, t = starts.alias("s"), sources.alias("t")
    known = written(
        s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
            F.col("s.source").alias("of"), F.col("s.slice").alias("in"), "slice_start", "source_size", "rank", "target"
        ),
        "slice-starts",
    )
    inside = (
        Window.partitionBy("source", "slice").orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = narrow.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = ordered.join(known, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in")))
    return joined.withColumn("start", F.col("slice_start") + F.col("ahead")).drop("of", "in", "ahead", "slice_start")


def _taken(turn: Column | int) -> Column:
    """Words taken of a document in one pass over its source."""
    words = F.round("target").cast("long") - F.lit(turn) * F.col("source_size") - F.col("start")
    return F.least(F.greatest(words, F.lit(0).cast("long")), F.col("size"))


def due(share: Column, tilt: Column) -> Column:
    """The time t at which ``t + tilt * (t - t*t)`` reaches the share."""
    root = F.sqrt((1 + tilt) * (1 + tilt) - 4 * tilt * share)
    return F.when(tilt == 0, share).otherwise(2 * share / (1 + tilt + root))


def schedule(docs: DataFrame, *, most: int = 2, tilts: tuple = TILTS, **options) -> DataFrame:
    """Where the curriculum puts every document: one row per document, without its text.

    ``doc_id``, ``source``, ``place`` (hash of id and text), ``size``, ``source_size``, ``target`` and ``copies``,
    an array of (copy, taken, position) by pass; it is empty for a document the mix does not take.
    """

    def one(turn: Column) -> Column:
        taken = _taken(turn)
        words = turn * F.col("source_size") + F.col("start") + taken / 2
        share = F.least(words / F.greatest(F.round("target"), F.lit(1.0)), F.lit(1.0))
        position = due(share, _by_rank(tilts, F.col("rank")).cast("double"))
        return F.struct(turn.alias("copy"), taken.alias("taken"), position.alias("position"))

    copies = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), one)
    return _placed(docs, most, options).select(
        "doc_id", "source", "place", "size", "source_size", "target",
        F.filter(copies, lambda c: c["taken"] > 0).alias("copies"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document, range-sorted by its first position: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``
    (words of all its copies), ``positions``. Documents that are not taken come first, without positions."""
    planned = schedule(docs, **options)
    total = F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["taken"])
    rows = planned.select(
        "doc_id", "size", "source_size", "target", total.alias("taken"), F.col("copies.position").alias("positions")
    )
    first = F.get("positions", F.lit(0))
    return rows.repartitionByRange(first, "doc_id").sortWithinPartitions(first, "doc_id")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The training sequence: one row per taken copy of a document, range-sorted by position.

    Columns of the documents, then ``copy`` (pass number), ``taken`` (words; fewer than the document has
    only at the border of a target) and ``position`` in [0, 1]. A name that the documents have already
    is replaced.
    """
    planned = schedule(docs, **options)
    row = ["doc_id", "source", "place"]
    repeated = planned.groupBy(*row).count().where("count > 1")
    left = docs.drop("copy", "taken", "position").withColumn("__place", _place())
    if not repeated.isEmpty():
        # Rows equal in id, source and text are interchangeable: one stands for all, and each of their copies finds it.
        left = left.dropDuplicates(["doc_id", "source", "__place"])
    copies = planned.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__from"), F.col("place").alias("__of"), F.inline("copies")
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__from"))
        & (F.col("__place") == F.col("__of"))
    )
    out = left.join(copies, same).drop("__id", "__from", "__place", "__of")
    return out.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
