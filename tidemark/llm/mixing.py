"""Mixing sources to target weights by capped water-filling, DataFrame functions only.

A source's level is its cap over its weight. In order of level, sources stop at their caps as long as the water line
that the rest would share lies above their level; the excess is thereby reshared in proportion until no target
is above its cap. This is the fixed point of clamping and redistributing, in one ordered pass over the sources.
Rows then take whole repetitions, and a seeded order of each source takes one more, from its start, as far as the
fraction of the target reaches. The order is by a hash; it is cut in two steps (4,096 ranges of the hash, then rows
within a range), so no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.storage import materialize

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """sizes: (source, source_size), one row per source. Adds weight, share_num and share_den; target = share_num / share_den.

    Sources take ``weights`` in turn by code point, null last. If all caps together lie below the total, every source is at its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (position + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * max_epochs).withColumn("level", F.col("cap") / F.col("weight"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    w = w.withColumn("total", F.sum("source_size").over(every) * total_percent)  # in hundredths of a word
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    w = w.withColumn("num", F.col("total") - before * 100).withColumn("den", rest * 100)
    capped = F.col("num").cast("decimal(38,0)") * F.col("weight") >= F.col("cap").cast("decimal(38,0)") * F.col("den")
    w = w.withColumn("line", F.when(~capped, F.struct("level", "num", "den")))
    line = F.min("line").over(every)
    w = w.withColumn("line", line)
    free = F.col("line").isNotNull() & (F.col("level") >= F.col("line.level"))
    return w.select("source", "source_size", "weight", F.when(free, F.col("line.num") * F.col("weight")).otherwise(F.col("cap")).alias("share_num"), F.when(free, F.col("line.den")).otherwise(F.lit(1).cast("long")).alias("share_den"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, total_percent: int = 150, max_epochs: int = 2, seed: str = "mix-1") -> DataFrame:
    """One row per input row: (key, size, source, source_size, target, epochs, taken).

    size: words of the text, null 0. epochs: whole repetitions plus the seeded one; taken = epochs x size, near the target by
    half of one document's size in each source, never over ``max_epochs`` x size. A null source is a source. Rows that repeat
    (key, size) share the order's ties in any way, with equal results as a set. An empty table gives an empty result.
    """
    sized = materialize(docs.select(F.col(key).alias("k"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")).alias("h")), "sizes")
    sized = sized.withColumn("range", F.substring("h", 1, 3))
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    per_source = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, total_percent, max_epochs)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("before"))
    # target = whole * source_size + left, in exact fractions of share_den
    per_source = per_source.withColumn("whole", F.when(F.col("source_size") > 0, F.expr("cast(share_num as decimal(38,0)) div (cast(share_den as decimal(18,0)) * cast(source_size as decimal(19,0)))")).otherwise(F.lit(0)))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    per_source = per_source.withColumn("left", big("share_num") - big("whole") * (F.col("share_den").cast("decimal(18,0)") * F.col("source_size").cast("decimal(19,0)")))
    ranges = ranges.withColumnRenamed("source", "s2").join(per_source, F.col("s2").eqNullSafe(F.col("source")))
    ranges = ranges.select("s2", F.col("range").alias("r2"), "before", "source_size", "share_num", "share_den", "whole", "left")
    within = Window.partitionBy("source", "range").orderBy("h", "k", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(ranges, F.col("source").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("r2")))
    again = (F.lit(2) * (F.col("before") + F.col("ahead")) + F.col("size")).cast("decimal(19,0)") * F.col("share_den").cast("decimal(18,0)") <= F.col("left") * 2
    epochs = F.col("whole") + F.when(again & (F.col("whole") < max_epochs), 1).otherwise(0)
    return rows.select(F.col("k").alias(key), "size", "source", "source_size", (F.col("share_num") / F.col("share_den")).alias("target"), epochs.cast("long").alias("epochs"), (epochs * F.col("size")).cast("long").alias("taken"))
