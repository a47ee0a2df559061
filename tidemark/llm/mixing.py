"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source has a weight and may be repeated at most ``max_epochs`` times. Targets are
``min(cap, level * weight)``; the level is the one at which they add up to the budget. Clamping
sources at their cap and sharing the excess among the rest until none is above ends at the same
level, which sorting sources by ``cap / weight`` finds in one pass of running sums.

A document is repeated the whole number of times its source needs; the rest is made up by one
more copy of documents in the lowest slices of a seeded hash. The cut is placed from counted
sizes per slice, so what is taken stays near the target even where sizes are very uneven.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table, word_count

MAX_EPOCHS = 3
#: Slices of the hash range (three hexadecimal digits): the finest step of a fractional repetition, per source.
SLICES = 4096


def cyclic_weights(rank: Column, cycle: int = 3) -> Column:
    """1, 2, ..., cycle, 1, ... for sources numbered from 1."""
    return F.pmod(rank - 1, F.lit(cycle)) + 1


def _slice(id_col: str, seed: int) -> Column:
    """First three hexadecimal digits of an MD5: 4096 slices, the same in every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """doc_id, source, size in words and hash slice of each row."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), _slice(id_col, seed).alias("slice")
    )


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of ``sources`` (source, source_size): capped shares of the sum of all sizes.

    The windows here see one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("weight", cyclic_weights(F.row_number().over(by_name)).cast("long"))
    capped = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    below, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        capped.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(below), F.lit(0)))
        .withColumn("open", F.sum("weight").over(rest))
    )
    # A source is full if an even share of what is left would exceed its cap.
    # Decimals, because the products pass the range of a long.
    full = F.expr(
        "cast(left as decimal(20,0)) * cast(weight as decimal(17,0)) >= cast(cap as decimal(20,0)) * cast(open as decimal(17,0))"
    )
    marked = placed.withColumn("full", full)
    # Weights still open only shrink along the order, so the first open source has the most.
    first = F.max(F.when(~F.col("full"), F.struct("open", "left"))).over(everything)
    share = first["left"].cast("double") * F.col("weight") / first["open"]
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share)
    return marked.select("source", "source_size", "weight", target.alias("target"))


def mix_plan(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: size, target, whole repetitions and the slice below which one more copy is taken.

    Sizes are summed per source and slice before anything is ordered, so a source with any
    number of documents gives at most ``SLICES`` rows to its window.
    """
    sliced = shared_table(sizes.groupBy("source", "slice").agg(F.sum("size").alias("size")), "mix-slices")
    targets = water_fill(sliced.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    targets = shared_table(targets, "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = targets.withColumn("whole", F.least(F.floor(rate), F.lit(max_epochs)).cast("int")).withColumn(
        "extra", F.col("target") - F.col("whole") * F.col("source_size")
    )
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sliced.withColumn("upto", F.sum("size").over(upto)).select(F.col("source").alias("s"), "slice", "size", "upto")
    near = running.join(wanted, F.col("s").eqNullSafe(F.col("source")))
    # A slice is taken while that brings the sum nearer to what is wanted; sums only grow, so slices taken come first.
    taken = F.col("upto") - F.col("extra") <= F.col("extra") - (F.col("upto") - F.col("size"))
    cut = near.groupBy("source", "source_size", "target", "whole").agg(
        F.coalesce(F.max(F.when(taken & (F.col("size") > 0), F.col("slice"))), F.lit(-1)).alias("last_slice")
    )
    return shared_table(cut, "mix-plan")


def copies(whole: Column, last_slice: Column, slice_of: Column, max_epochs: int = MAX_EPOCHS) -> Column:
    more = (slice_of <= last_slice) & (whole < max_epochs)
    return (F.coalesce(whole, F.lit(0)) + F.when(more, 1).otherwise(0)).cast("long")


def mix_report(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 7, **columns) -> DataFrame:
    """doc_id, size, source_size, target and taken (size times copies) of every row.

    A null text has size 0; a null source is a source of its own, last in order; rows with a
    null or repeated id are decided alike for the same id; an empty table gives no rows.
    """
    sizes = shared_table(sizes_of(docs, seed=seed, **columns), "mix-sizes")
    plan = mix_plan(sizes, max_epochs)
    joined = sizes.withColumnRenamed("source", "own").join(plan, F.col("own").eqNullSafe(F.col("source")))
    times = copies(F.col("whole"), F.col("last_slice"), F.col("slice"), max_epochs)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("copies"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns stay as they are."""
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    plan = mix_plan(sizes_of(docs, seed=seed, **names), max_epochs)
    plan = plan.select(F.col("source").alias("__mix_source"), F.col("whole").alias("__mix_whole"), F.col("last_slice").alias("__mix_last"))
    joined = docs.join(plan, F.col(source_col).eqNullSafe(F.col("__mix_source")))
    times = copies(F.col("__mix_whole"), F.col("__mix_last"), _slice(id_col, seed), max_epochs).cast("int")
    kept = joined.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
