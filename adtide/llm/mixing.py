"""Mixing sources to target weights, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.common import word_count
from adtide.sources.files import stage

MAX_RATE = 3
WEIGHTS = 3
PLANNED = ["_size", "_source_size", "_target", "_copies"]


def uniform(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def source_targets(sizes: DataFrame, max_rate: int = MAX_RATE) -> DataFrame:
    """``source, source_size, target`` from rows (source, size); one row per source.

    Sources in code-point order, null last, weigh 1, 2, 3, 1, 2, ... and share the total. A target
    stops at ``max_rate`` times its source; what is over is shared by weight among the others.
    With sources sorted by size per weight, the level that remains after the first k are full
    rises as long as the next one is below it, so the final level is the largest of them.
    Sums are made per source before anything is ordered.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = totals.withColumn("_w", (nth - 1) % WEIGHTS + 1)
    before = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    every = Window.partitionBy(F.lit(1))
    room = F.sum("source_size").over(every) - max_rate * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    levels = weighed.withColumn("_level", room / weight)
    level = F.max("_level").over(every)
    cap = F.col("source_size") * F.lit(float(max_rate))
    return levels.select("source", "source_size", F.least(cap, level * F.col("_w")).alias("target"))


def mixing_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: int = 0, max_rate: int = MAX_RATE,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``_size, _source_size, _target, _copies``, which take the
    place of columns with these names.

    ``_copies`` is the whole part of target / source size, plus one where the id's hash falls
    below the fraction. A source without words has target 0 and no copies. Null text has size 0.
    """
    # the row travels as one column, so none of its names can meet those of the plan
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in PLANNED]).alias("doc"), word_count(text_col).alias("size"),
        F.col(source_col).alias("of"), uniform(F.col(id_col), seed).alias("draw"),
    )
    targets = stage(source_targets(sized.select(F.col("of").alias("source"), "size"), max_rate), "targets")
    rate = F.least(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)), F.lit(float(max_rate)))
    whole = F.floor(rate)
    copies = (whole + (F.col("draw") < rate - whole).cast("bigint")).cast("bigint")
    planned = [F.col(c).alias(n) for c, n in zip(("size", "source_size", "target"), PLANNED)]
    return sized.join(targets, F.col("of").eqNullSafe(F.col("source"))).select("doc.*", *planned, copies.alias("_copies"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0
) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; all columns stay, whatever their names."""
    whole = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    )
    planned = mixing_plan(whole, "id", "text", "source", seed).where("_copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return planned.select("doc", copies.alias("copy")).select("doc.*")
