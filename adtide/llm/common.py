"""Shared pieces of the corpus operators: words, learning splits, worker state, dense names."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.sources.files import stage

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes with A-Z lowered; ``bytes.split`` cuts at exactly the characters of SPACE.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_remainder(id_col: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for vocabularies and caches.

    Functions pickled by value get fresh globals for each task, so caches need another home.
    """
    module = sys.modules.setdefault("_corpus_worker_state", types.ModuleType("_corpus_worker_state"))
    return module.__dict__.setdefault("values", {})


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by key over all shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def dense_names(df: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """The distinct keys in sorted order, numbered from 0 without gaps; a staged table.

    Ranges of keys are sorted on their own; the size of the ranges before is added. Only one row
    for each range meets in a single task.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.select(*keys).distinct().repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    ordered = stage(ordered, "names")
    part, local = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.select(*keys, part.alias("_part"), local.alias("_local"))
    sizes = ordered.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return stage(
        ordered.join(stage(offsets, "offsets"), "_part")
        .select(*keys, (F.col("_before") + F.col("_local")).alias(name)),
        "named",
    )
