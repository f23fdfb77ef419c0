"""Phrases whose words belong together, mined by dynamic itemset counting.

The texts are dealt into shards that are scanned in a cycle. Words are counted from the first scan
on. A longer phrase becomes active once both its subphrases (without the last and without the first
word) have reached the threshold, whatever lengths the scan counts besides, and it is counted for one
full cycle from there, so every shard adds to it exactly once. Counting ends when no phrase is active.

When a phrase or word reaches the threshold, the number of that scan is written into a table of
fixed size at the place its hash names; tasks read from it when a phrase became active. A phrase that
shares the place of an earlier one can make others active before it has reached the threshold. They
are counted for a full cycle all the same, so every count that is reported is exact.

Cases without an ordinary result: a null text has no words, a null language is ``und``; empty
pieces and languages without words give no row; repeated rows count as often as they stand; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtide.sources.files import scratch_path, stage

SHARDS = 3
THRESHOLD = 30
LONGEST = 4
TOP = 2000
#: Places of the table of scans; a power of two. It bounds what is sent to tasks and to the driver.
PLACES = 1 << 24
#: Bytes of text that are counted together.
SLICE = 6_000_000
NEVER = 255
ENDS = r"[.,;:!?\x0A-\x0D]+"
#: ``name`` is the language, a line feed (in no phrase) and the phrase; ``about`` is its place, the
#: scan it became active in and its length. Few columns, since the rows are many.
COUNTS = "name string, about bigint, n bigint"
ACTIVE, LENGTH = 32, 40


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its first words and its last word."""
    h = (a ^ (b + np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def _place(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(PLACES - 1)).astype(np.int64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row of each word, its code (-1 ends a piece) and the words that the codes name."""
    # lower case comes second: on a slice of an array the kernel miscounts its offsets
    clean = pc.ascii_lower(pc.replace_substring_regex(texts.cast(pa.large_string()), ENDS, " \n "))
    lists = pc.split_pattern(pc.replace_substring(clean, "\t", " "), " ")
    words = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
    there = np.asarray(pc.not_equal(pc.binary_length(words), 0))
    coded = words.filter(pa.array(there)).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    end = pc.index(coded.dictionary, pa.scalar("\n", coded.dictionary.type)).as_py()
    if end >= 0:
        codes[codes == end] = -1
    return rows[there], codes, coded.dictionary


def _counted(langs: pa.Array, texts: pa.Array, scan: int, shards: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases that are active in this scan, each once, and the words of each language."""
    rows, codes, names = _tokens(texts)
    lang = langs.dictionary_encode()
    lang_of = lang.indices.to_numpy().astype(np.int64)[rows]
    word = codes >= 0
    if not word.any():
        return
    size = len(names)
    ids = np.zeros(len(codes), dtype=np.int64)
    ids[word], distinct = pd.factorize(lang_of[word] * size + codes[word])
    lang_id, name_id = distinct // size, distinct % size
    lang_hash = pd.util.hash_array(np.array(lang.dictionary.to_pylist(), dtype=object), categorize=False)
    name_hash = pd.util.hash_array(np.array(names.to_pylist(), dtype=object), categorize=False)
    hash_of = _mix(lang_hash[lang_id], name_hash[name_id])

    def batch(k: int, of: np.ndarray, words: list[np.ndarray], active: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        langs_of = lang.dictionary.take(pa.array(of)).cast(pa.large_string())
        phrase = [names.take(pa.array(w)).cast(pa.large_string()) for w in words] or [pa.array([""] * len(of), pa.large_string())]
        sep = lambda c: pa.scalar(c, pa.large_string())
        name = pc.binary_join_element_wise(langs_of, pc.binary_join_element_wise(*phrase, sep(" ")), sep("\n"))
        about = place + (active << ACTIVE) + (k << LENGTH)
        return pa.RecordBatch.from_arrays([name.cast(pa.string()), pa.array(about, pa.int64()), pa.array(n, pa.int64())], names=["name", "about", "n"])

    if scan < shards:
        none = np.zeros(len(distinct), dtype=np.int64)
        n = np.bincount(ids[word], minlength=len(distinct))
        yield batch(1, lang_id, [name_id], none, _place(hash_of), n)
        total = np.bincount(lang_of[word], minlength=len(lang.dictionary))
        have = np.flatnonzero(total)
        yield batch(0, have, [], none[: len(have)], none[: len(have)], total[have])

    hashes = hash_of[ids]
    last_hash = hashes
    # for each place in the texts: the scan in which the phrase that starts there reached the threshold
    reached = np.where(word, table[_place(hash_of)][ids], NEVER)
    for k in range(2, LONGEST + 1):
        # the phrase at i: that of k - 1 words at i and the one at i + 1, both past the threshold
        both = np.maximum(reached[:-1], reached[1:])
        at = np.flatnonzero((both < NEVER) & (rows[: len(both)] == rows[k - 1 :]))
        if not len(at):
            return
        active = both[at].astype(np.int64) + 1
        now = np.flatnonzero((active <= scan) & (scan < active + shards))
        if k == LONGEST:  # nothing is built on these, so only those that are counted matter
            at, active, now = at[now], active[now], np.arange(len(now))
        hashed = _mix(hashes[at], last_hash[at + k - 1])
        place = _place(hashed)
        if len(now):
            where = at[now]
            key, found = pd.factorize(_joined([ids[where + j] for j in range(k)], len(distinct)))
            one = np.zeros(len(found), dtype=np.int64)
            one[key] = np.arange(len(now))  # any occurrence of each
            words = [name_id[ids[where[one] + j]] for j in range(k)]
            yield batch(k, lang_id[ids[where[one]]], words, active[now][one], place[now][one], np.bincount(key, minlength=len(found)))
        if k == LONGEST:
            return
        # no phrase reaches the threshold before it is counted, whatever else shares its place
        reached = np.full(len(both), NEVER)
        reached[at] = np.minimum(np.maximum(table[place], active), NEVER)
        hashes = np.zeros(len(both), dtype=np.uint64)
        hashes[at] = hashed


def _joined(parts: list[np.ndarray], size: int) -> np.ndarray:
    """One whole number for each row of ``parts``, which are below ``size``; numbered anew only where 63 bits end."""
    key, below = parts[0], size
    for part in parts[1:]:
        if below * size > 1 << 63:
            key, found = pd.factorize(key)
            below = len(found)
        key, below = key * size + part, below * size
    return key


def _scan_task(scan: int, shards: int, reached) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = reached.value
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(np.asarray(pc.binary_length(texts)))
            start = 0
            while start < len(texts):
                before = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, before + SLICE, side="right")))
                yield from _counted(langs.slice(start, stop - start), texts.slice(start, stop - start), scan, shards, table)
                start = stop

    return run


def _mark(places: DataFrame, reached: np.ndarray, scan: int) -> bool:
    """Write the scan into the table, unless an earlier one stands there; whether there were places.

    Tasks merge what shares a word of 64 places, so the driver reads one row for each at most.
    """
    place = F.col("about").bitwiseAND(F.lit(PLACES - 1))
    bits = places.select(place.cast("int").alias("place")).groupBy(F.shiftright("place", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("bits")
    )
    got = bits.toArrow()
    if got.num_rows:
        words = got.column("bits").to_numpy().view(np.uint64)
        on = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        at = got.column("w").to_numpy().astype(np.int64)[:, None] * 64 + np.arange(64)[None, :]
        at = at[on]
        reached[at] = np.minimum(reached[at], scan)
    return got.num_rows > 0


def frequent_phrases(df: DataFrame, text: str, lang: str, threshold: int = THRESHOLD, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, k, n) of all words and phrases found ``threshold`` times or more, and the number
    of words of each language as the phrase of length 0; a table in the scratch folder."""
    if not 1 <= shards <= NEVER // LONGEST:
        raise ValueError("scans are numbered in one byte")
    spark = df.sparkSession
    dealt = df.select(
        F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"),
        F.pmod(F.xxhash64(text), F.lit(shards)).alias("shard"),
    )
    path = scratch_path(spark, "shards")
    dealt.write.partitionBy("shard").parquet(path, compression="zstd")
    docs = spark.read.schema("lang string, text string, shard bigint").parquet(path)
    reached = np.full(PLACES, NEVER, dtype=np.uint8)
    open_, done, scan, latest = None, [], 0, 0
    while scan <= latest + shards:  # what reached the threshold in a scan makes others active in the next
        shared = spark.sparkContext.broadcast(reached)
        shard = docs.where(F.col("shard") == scan % shards).select("lang", "text")
        found = shard.mapInArrow(_scan_task(scan, shards, shared), COUNTS).withColumn("seen", F.lit(None).cast("int"))
        both = found if open_ is None else found.unionByName(open_)
        counted = both.groupBy("name", "about").agg(F.sum("n").alias("n"), F.max("seen").alias("seen"))
        counted = stage(counted.withColumn("seen", F.coalesce("seen", F.when(F.col("n") >= threshold, F.lit(scan)))), "scan")
        shared.unpersist()
        ends = F.shiftright("about", ACTIVE).bitwiseAND(F.lit(255)) + (shards - 1)
        length = F.shiftright("about", LENGTH).cast("int")
        done.append(counted.where((ends == scan) & ((F.col("n") >= threshold) | (length == 0))).select("name", length.alias("k"), "n"))
        open_ = counted.where(ends > scan)
        reached = reached.copy()
        if _mark(counted.where((F.col("seen") == scan) & length.between(1, LONGEST - 1)), reached, scan):
            latest = scan
        scan += 1
    for left in done[1:]:
        done[0] = done[0].unionByName(left)
    phrase = F.substring_index("name", "\n", -1)
    lang_of = F.left(F.col("name"), F.length("name") - F.length(phrase) - 1)
    return stage(done[0].select(lang_of.alias("lang"), phrase.alias("phrase"), "k", "n"), "frequent")


def score_phrases(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of each phrase of two words or more, at its lowest cut."""
    words = F.split("phrase", " ")
    of = lambda name: frequent.where("k > 0").select("lang", F.col("phrase").alias(name), F.col("n").alias(f"n_{name}"))
    cut = F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)).alias("cut")
    cuts = frequent.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), words.alias("w"), cut)
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = cuts.select(
        "lang", "phrase", "k", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    cuts = cuts.join(of("head"), ["lang", "head"]).join(of("tail"), ["lang", "tail"])
    # a product with 2,000,000 may pass 64 bits; the quotient is at most 1,000,000
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(n_head as decimal(20,0)) + n_tail)")
    return (
        cuts.withColumn("score", score)
        .groupBy("lang", "phrase", "k", "a")
        .agg(F.min(F.struct("score", "cut", F.col("n_head").alias("l"), F.col("n_tail").alias("r"))).alias("best"))
        .select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")
    )


def without_parts(scored: DataFrame, percent: int = 80) -> DataFrame:
    """Phrases that no longer phrase holds in ``percent`` of their occurrences or more."""
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("k").cast("int") - 1),
                lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda at: F.array_join(F.slice(F.col("w"), at, m), " ")),
            )
        )
    )
    longer = scored.where("k > 2").select("lang", "k", "a", F.split("phrase", " ").alias("w")).select("lang", "a", inner.alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("_most"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    held = F.coalesce(wide("_most") * 100 >= wide("a") * percent, F.lit(False))
    return scored.join(most, ["lang", "phrase"], "left").where(~held).drop("_most")


def top_phrases(
    df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = THRESHOLD, top: int = TOP, shards: int = SHARDS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    frequent = frequent_phrases(df, text, lang, threshold, shards)
    kept = stage(without_parts(stage(score_phrases(frequent), "scored")), "kept")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # every part of a language keeps its first ones; only those meet in one task
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    inside = Window.partitionBy("lang", "_part").orderBy(*order)
    kept = kept.withColumn("_in", F.row_number().over(inside)).where(F.col("_in") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    totals = frequent.where("k = 0").select("lang", "n")
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
