"""Mixing sources to target weights by random keys and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import WORD

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
# A key's leading hex digits make the range it is sorted in: 4096 ranges per source.
RANGE_DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS
) -> DataFrame:
    """Turn ``source, source_size`` into targets, one row for each source.

    The sources, by code point and null last, weigh ``weights`` in turn, and
    share ``share`` times all sizes. No target exceeds ``most`` times its
    source; what is over goes to the others by weight. In the order of size by
    weight the full sources come first, so a running sum tells at which one the
    rest share freely. The table has one row for each source, not document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("turn") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("turn", F.row_number().over(order) - 1).withColumn("weight", weight)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "turn")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = ranked.select(
        "*",
        F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("weight_before"),
        F.sum("source_size").over(everything).alias("size_all"),
        F.sum("weight").over(everything).alias("weight_all"),
    )
    level = (share * F.col("size_all") - most * F.col("size_before")) / (F.col("weight_all") - F.col("weight_before"))
    free = summed.withColumn("level", level).withColumn(
        "level", F.when(most * F.col("source_size") > F.col("level") * F.col("weight"), F.col("level"))
    )
    shared = F.max("level").over(everything)
    target = F.least(most * F.col("source_size"), F.coalesce(shared * F.col("weight"), most * F.col("source_size")))
    return free.select("source", "source_size", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs``, by default all, with ``mix_size, mix_source_size, mix_target, mix_taken``.

    ``mix_taken`` is the number of words the mix takes of a document: its size
    for each whole epoch of its source, and in the last, partial epoch what is
    left of the budget when the documents are lined up by a random key. One
    document of each source is cut there, so the words taken of a source are
    its target, rounded down.

    The key is a hash of id and seed: reruns agree. Its leading digits part a
    source into ranges, however large the source; their totals, 4096 rows a
    source, are summed up first, and then each range for itself. Null sources
    are a source; a null text has no words; rows without an id get a key from
    their text; rows that repeat an id lie next to each other, ordered by size
    and a hash of the text, so that how rows lie in partitions decides nothing.
    No documents give no rows. Columns that ``docs`` already has under the names
    of the result are replaced.
    """
    source = F.col(source_column)
    # Of rows without an id the text decides, so that they spread as others do.
    tie = F.xxhash64(text_column)
    named = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text "), tie.cast("string")))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), named).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    added = ("mix_size", "mix_source_size", "mix_target", "mix_taken")
    kept = [name for name in keep or docs.columns if name.lower() not in added]
    keyed = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in kept)).alias("row"),
        source.alias("source"),
        F.col(id_column).alias("id"),
        size.alias("size"),
        tie.alias("tie"),
        key.alias("key"),
        F.substring(key, 1, RANGE_DIGITS).alias("range"),
    ).withColumn("line", F.concat("range", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    ranges = keyed.groupBy("source", "range", "line").agg(F.sum("size").alias("range_size"))
    totals = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    targets = source_targets(totals, weights, share, most).withColumnRenamed("source", "target_source")
    plan = starts.join(targets, F.col("source").eqNullSafe(F.col("target_source"))).select(
        "line", "range_start", "source_size", "target"
    )
    line = Window.partitionBy("line").orderBy("key", "id", "size", "tie")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("line_start", F.coalesce(F.sum("size").over(earlier), F.lit(0))).join(plan, "line")
    start = F.col("range_start") + F.col("line_start")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.floor(F.col("target")) - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), budget - start))
    return placed.select(
        "row",
        F.col("size").alias("mix_size"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        (epochs * F.col("size") + last).cast("long").alias("mix_taken"),
    ).select("row.*", *added)


def repeated(mixed: DataFrame, *, text_column: str = "text") -> DataFrame:
    """The rows the mix takes: a document once for each whole or partial pass.

    ``mix_pass`` counts them; a column that already has this name is replaced.
    In a partial pass the text is its words taken, joined by blanks; documents
    of which nothing is taken, nulls and empty texts among them, are left out.
    """
    mixed = mixed.select(*(F.col(f"`{name}`") for name in mixed.columns if name.lower() != "mix_pass"))
    size, taken = F.col("mix_size"), F.col("mix_taken")
    count = F.ceil(taken / size).cast("int")
    passes = mixed.where(taken > 0).select("*", F.explode(F.sequence(F.lit(1), count)).alias("mix_pass"))
    rest = taken - (F.col("mix_pass") - 1) * size
    words = F.slice(F.regexp_extract_all(F.col(text_column), F.lit(WORD), 0), 1, F.greatest(rest, F.lit(1)).cast("int"))
    return passes.withColumn(text_column, F.when(rest >= size, F.col(text_column)).otherwise(F.array_join(words, " ")))
