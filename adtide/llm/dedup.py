"""Exact deduplication by deterministic block naming.

A text is cut into blocks of fixed size. Distinct blocks are sorted and numbered; adjacent pairs of
numbers are sorted and numbered in turn, until each document has one number. Two documents share
it only if they are equal character by character: a number stands for one content, never for a
hash of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.common import SPACE, dense_names
from adtide.sources.files import stage

BLOCK_CHARS = 4096


def normal_text(text: str | Column) -> Column:
    """White-space runs become one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def block_label(block: Column) -> Column:
    return F.xxhash64(block)


def _blocks(text: Column, block_chars: int) -> Column:
    """The text in blocks; the empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.length(text) <= block_chars, F.array(text)).otherwise(cut)


def _block_names(
    rows: DataFrame, source: DataFrame, text: Column, block_chars: int, label: Callable[[Column], Column]
) -> DataFrame:
    """(row, pos, name) of the first level.

    A block travels once, to be compared with the others that have its label; where a label has
    a single content, as with 64 bits it practically always has, the label may stand for the
    content from then on. Contents that share a label are told apart by their order.
    """
    blocks = source.select(F.explode(_blocks(text, block_chars)).alias("block"))
    contents = blocks.select(label(F.col("block")).alias("label"), "block").distinct()
    clashes = stage(contents.groupBy("label").count().where("count > 1").select("label"), "clashes")
    at = rows.select("row", F.posexplode("labels").alias("pos", "label"))
    if clashes.isEmpty():
        keyed = at.withColumn("nth", F.lit(0))
    else:
        order = Window.partitionBy("label").orderBy("block")
        nth = contents.join(clashes, "label").select("label", "block", F.row_number().over(order).alias("nth"))
        whole = (
            source.select(F.sha2(text, 256).alias("text_sha256"), F.posexplode(_blocks(text, block_chars)).alias("pos", "block"))
            .withColumn("label", label(F.col("block")))
            .join(clashes, "label", "left_semi")
            .join(stage(nth, "clash_order"), ["label", "block"])
            .select("text_sha256", "pos", "nth").distinct()
        )
        at = rows.select("row", "text_sha256", F.posexplode("labels").alias("pos", "label"))
        keyed = at.join(whole, ["text_sha256", "pos"], "left").na.fill(0, ["nth"]).drop("text_sha256")
    keyed = stage(keyed, "block_keys")
    names = dense_names(keyed, ["label", "nth"])
    return keyed.join(names, ["label", "nth"]).select("row", "pos", "name")


def document_identities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
    label: Callable[[Column], Column] = block_label,
) -> DataFrame:
    """One row per input row: id, ``text_sha256`` of the normalised text, ``n_blocks``, ``name``.

    Rows are equal exactly when ``n_blocks`` and ``name`` are. Repeated ids stay separate rows
    (``row`` tells them apart), null text is the empty text, other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))
    text = normal_text("_text")
    labels = F.transform(_blocks(text, block_chars), label)
    rows = stage(
        source.select(
            F.monotonically_increasing_id().alias("row"), "id", F.sha2(text, 256).alias("text_sha256"),
            labels.alias("labels"), F.size(labels).alias("n_blocks"),
        ),
        "identities",
    )
    level = stage(_block_names(rows, source, text, block_chars, label), "level")
    done = level.join(rows.where("n_blocks = 1").select("row"), "row", "left_semi").select("row", "name")
    open_rows = level.join(rows.where("n_blocks > 1").select("row"), "row", "left_semi")
    width = rows.agg(F.max("n_blocks")).first()[0] or 1
    while width > 1:
        even = F.col("pos") % 2 == 0
        pairs = stage(
            open_rows.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
            ),
            "pairs",
        )
        open_rows = pairs.join(dense_names(pairs, ["left", "right"]), ["left", "right"]).select("row", "pos", "name")
        open_rows = stage(open_rows, "level")
        width = (width + 1) // 2
    done = done.unionByName(open_rows.select("row", "name"))
    return rows.drop("labels").join(done, "row")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
    label: Callable[[Column], Column] = block_label,
) -> DataFrame:
    """Groups of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    The row with the smallest id stays (a null id is larger than any; of rows that repeat an id
    one stays). Counts are combined before the shuffle, so a group may hold any share of the rows.
    An empty table gives an empty result.
    """
    named = stage(document_identities(docs, id_col, text_col, block_chars, label), "named_rows")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    groups = named.groupBy("n_blocks", "name").agg(F.min(first).alias("first"), F.count("*").alias("group_size"))
    return named.join(groups, ["n_blocks", "name"]).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Where an id is repeated on rows with different texts, the rows are told apart by their text.
    """
    mine = docs.select(
        F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.sha2(normal_text(F.col(text_col).cast("string")), 256).alias("sha")
    )
    stay = exact_duplicates(docs, id_col, text_col).where("kept").select(
        F.col(id_col).alias("keep"), F.col("text_sha256").alias("keep_sha")
    )
    kept = mine.join(stay, F.col("id").eqNullSafe(F.col("keep")) & (F.col("sha") == F.col("keep_sha")), "left_semi")
    # rows repeating both id and text are one document
    return kept.dropDuplicates(["id", "sha"]).select("doc.*")
