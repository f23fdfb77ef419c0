"""Compression of vectors to product codes, the nearest entry found through memoised grid cells.

Components become integers, vectors are cut into equal parts, and each part position has a
codebook of integer entries that a few rounds of assignment and averaging improve. A part is
assigned through a grid: the cell it lies in names the entries that can be nearest to any point of
the cell, and only those are measured. An entry is left out where another one's largest distance to
the cell's box is below its own smallest distance to it. What a cell names is computed once in a
task and kept; cells are found by hash, and their coordinates are compared before they are used.

Cases without an ordinary result:

* a null vector, or one with a null or non-finite component, is dropped;
* a vector of another length than that of the smallest kept id (or, for all rows, a length that the
  parts do not divide) has a null code and a null error and does not shape the codebooks;
* with fewer kept vectors than entries there are as many entries as vectors;
* a null id comes last among ids; rows with equal ids are ordered by their vectors;
* scaled components beyond 2^62 in size are taken as 2^62 with their sign; distances beyond the
  largest long are that long. Everything below is exact;
* an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtide.sources.files import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Cells that a task keeps for each part; the store is emptied when it is full.
CELLS = 1 << 13
#: Integers that one distance step may hold.
BLOCK = 1 << 20
EDGE = 2.0**62
LONGEST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether the vector is not null and has finite components only."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def _integers(vectors: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) of floor(SCALE * x); the caller has taken out rows of other lengths."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(flat * SCALE), -EDGE, EDGE)
    return scaled.astype(np.int64).reshape(-1, dim)


class _PartCodebook:
    """Entries of one part position and the cells that a task has met so far."""

    def __init__(self, entries: list[list[int]], total_dim: int):
        self.exact = np.array(entries, dtype=object)
        self.size, self.dim = self.exact.shape
        # squared distances over a whole vector stay in 62 bits below this size
        self.small = int(((1 << 62) / (4 * total_dim)) ** 0.5) - 1
        self.fits = bool(np.abs(self.exact).max() <= self.small)
        if self.fits:
            self.entries = self.exact.astype(np.int64)
            spread = int((self.entries.max(axis=0) - self.entries.min(axis=0)).max())
            self.width = max(1, spread // 8)
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.cells = np.zeros((CELLS, self.dim), dtype=np.int64)
        self.named = np.zeros((CELLS, self.size), dtype=np.int32)
        self.counts = np.zeros(CELLS, dtype=np.int64)

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """(cells, entries): whether the entry may be nearest to some point of the cell."""
        low = cells[:, None, :] * self.width
        high = low + (self.width - 1)
        e = self.entries[None, :, :]
        least = np.maximum(np.maximum(low - e, e - high), 0)
        most = np.maximum(np.abs(e - low), np.abs(e - high))
        least, most = (least * least).sum(axis=2), (most * most).sum(axis=2)
        return least <= most.min(axis=1)[:, None]

    def _slots_of(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Store slots of distinct cells; -1 where another cell holds the hash."""
        if len(self.slots) + len(hashes) > CELLS:
            self._clear()
        found = np.array([self.slots.get(h, -1) for h in hashes.tolist()], dtype=np.int64)
        new = np.flatnonzero(found < 0)[: CELLS - len(self.slots)]
        step = max(1, BLOCK // (self.size * self.dim))
        for at in range(0, len(new), step):
            rows = new[at : at + step]
            open_ = self._undominated(cells[rows])
            first = len(self.slots)
            slots = np.arange(first, first + len(rows))
            self.cells[slots] = cells[rows]
            self.counts[slots] = open_.sum(axis=1)
            self.named[slots] = np.argsort(~open_, axis=1, kind="stable")  # named ones first, ascending
            self.slots.update(zip(hashes[rows].tolist(), slots.tolist(), strict=True))
            found[rows] = slots
        known = found >= 0
        known[known] = (self.cells[found[known]] == cells[known]).all(axis=1)
        return np.where(known, found, -1)

    def _measure(self, rows: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of the named entries (ascending in each row) and its squared distance."""
        gap = self.entries[named] - rows[:, None, :]
        far = (gap * gap).sum(axis=2)
        best = far.argmin(axis=1)  # the first of equals
        at = np.arange(len(rows))
        return named[at, best], far[at, best]

    def assign(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance (Python integers for huge values)."""
        index = np.zeros(len(values), dtype=np.int64)
        error = np.zeros(len(values), dtype=np.int64)
        plain = (np.abs(values) <= self.small).all(axis=1) & self.fits
        rows = np.flatnonzero(plain)
        if len(rows):
            cells = values[rows] // self.width
            hashes = np.zeros(len(rows), dtype=np.uint64)
            for k in range(self.dim):
                hashes = (hashes ^ cells[:, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                hashes ^= hashes >> np.uint64(29)
            distinct, first, of = np.unique(hashes, return_index=True, return_inverse=True)
            of = of.reshape(-1)
            slots = self._slots_of(distinct, cells[first])[of]
            slots[(cells != cells[first][of]).any(axis=1)] = -1
            sizes = np.where(slots < 0, self.size, self.counts[slots])
            width = 1
            done = np.zeros(len(rows), dtype=bool)
            while not done.all():  # rows with up to 1, 2, 4, ... named entries together
                width = min(width, self.size)
                now = np.flatnonzero(~done & (sizes <= width))
                step = max(1, BLOCK // (width * self.dim))
                for at in range(0, len(now), step):
                    some = now[at : at + step]
                    every = np.arange(self.size, dtype=np.int32)[None, :width]
                    named = np.where(slots[some, None] < 0, every, self.named[slots[some], :width])
                    # the rest of a short list repeats its first entry, which changes no minimum
                    short = np.arange(width)[None, :] >= sizes[some, None]
                    named = np.where(short, named[:, :1], named)
                    index[rows[some]], error[rows[some]] = self._measure(values[rows[some]], named)
                done[now] = True
                width *= 2
        huge = np.flatnonzero(~plain)
        if len(huge):
            error = error.astype(object)
            for row in huge.tolist():
                gap = self.exact - np.array([int(x) for x in values[row]], dtype=object)[None, :]
                far = (gap * gap).sum(axis=1).tolist()
                error[row] = min(far)
                index[row] = far.index(error[row])
        return index, error


def _batches(
    batches: Iterator[pa.RecordBatch], column: str, codebooks: list, dim: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list]]:
    """Batch, rows of the right length, their integers and (index, error) by part."""
    books = [_PartCodebook(entries, dim) for entries in codebooks]
    width = dim // len(books) if books else 0
    for batch in batches:
        vectors = batch.column(batch.schema.get_field_index(column))
        right = np.flatnonzero(np.asarray(vectors.value_lengths()) == dim) if books else np.array([], dtype=np.int64)
        values = _integers(vectors.take(pa.array(right)), dim) if len(right) else np.zeros((0, max(dim, 1)), np.int64)
        cut = [values[:, k * width : (k + 1) * width] for k in range(len(books))]
        yield batch, right, values, [b.assign(c) for b, c in zip(books, cut, strict=True)]


def _sums_task(column: str, codebooks: list, dim: int) -> Callable:
    """Per task one row for each entry and position: number and sum of the parts assigned to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = len(codebooks), len(codebooks[0])
        width = dim // parts
        counts = np.zeros((parts, size), dtype=np.int64)
        sums = np.zeros((parts, size, width), dtype=object)
        for _, right, values, found in _batches(batches, column, codebooks, dim):
            exact = bool(len(values)) and int(np.abs(values).max()) > (1 << 40)
            for k, (index, _) in enumerate(found):
                part = values[:, k * width : (k + 1) * width]
                add = np.zeros((size, width), dtype=object if exact else np.int64)
                np.add.at(add, index, part.astype(object) if exact else part)
                sums[k] += add.astype(object)
                counts[k] += np.bincount(index, minlength=size)
        rows = [(k, e, p) for k, e in zip(*np.nonzero(counts), strict=True) for p in range(width)]
        for at in range(0, len(rows), 10_000):
            some = rows[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(k) for k, _, _ in some], pa.int32()),
                    pa.array([int(e) for _, e, _ in some], pa.int32()),
                    pa.array([p for _, _, p in some], pa.int32()),
                    pa.array([int(counts[k, e]) for k, e, _ in some], pa.int64()),
                    pa.array([Decimal(int(sums[k, e, p])) for k, e, p in some], pa.decimal128(38, 0)),
                ],
                names=["part", "entry", "position", "n", "total"],
            )

    return run


def _codes_task(column: str, codebooks: list, dim: int) -> Callable:
    """The other columns with ``code`` and ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, right, _, found in _batches(batches, column, codebooks, dim):
            codes: list[str | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            if len(right):
                index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
                total = sum((e.astype(object) for _, e in found), np.zeros(len(right), dtype=object))
                digits = index.tobytes().hex()
                step = 2 * len(found)
                for k, row in enumerate(right.tolist()):
                    codes[row] = digits[k * step : (k + 1) * step]
                    errors[row] = min(int(total[k]), LONGEST)
            keep = [c for c in range(batch.num_columns) if batch.schema.field(c).name != column]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                names=[*[batch.schema.field(c).name for c in keep], "code", "error"],
            )

    return run


def fit_codebooks(
    kept: DataFrame, id_col: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[list[list[list[int]]], int]:
    """Codebooks as part -> entry -> integers, and the vectors' length; empty without vectors.

    They start as the parts of the ``entries`` smallest ids. Every round is one scan of all vectors;
    tasks return a count and sums for each entry, which Spark adds up before the driver reads them,
    at most ``entries`` times the length of a vector.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    ids, vec = F.col(id_col), F.col(vector)
    first = lambda rows, n: rows.orderBy(ids.asc_nulls_last(), vec).select(vec.cast("array<double>").alias("v")).limit(n).collect()
    cut = kept.where((F.size(vec) > 0) & (F.size(vec) % parts == 0))
    seeds = [r["v"] for r in first(cut, entries)]
    if not seeds:
        return [], 0
    dim = len(seeds[0])
    if any(len(v) != dim for v in seeds):
        seeds = [r["v"] for r in first(cut.where(F.size(vec) == dim), entries)]
    ints = _integers(pa.array(seeds, pa.list_(pa.float64())), dim).tolist()
    width = dim // parts
    books = [[v[k * width : (k + 1) * width] for v in ints] for k in range(parts)]
    schema = "part int, entry int, position int, n bigint, total decimal(38,0)"
    for _ in range(rounds):
        sums = (
            kept.select(vector).mapInArrow(_sums_task(vector, books, dim), schema)
            .groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        )
        for r in sums.collect():
            books[r["part"]][r["entry"]][r["position"]] = int(r["total"]) // r["n"]
    return books, dim


def encode_vectors(kept: DataFrame, vector: str, codebooks: list, dim: int) -> DataFrame:
    """All columns but ``vector``, with ``code`` (two hex digits a part) and ``error``."""
    rest = [f for f in kept.schema.fields if f.name != vector]
    schema = T.StructType([*rest, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return kept.mapInArrow(_codes_task(vector, codebooks, dim), schema)


def decode_codes(codes: list[str], codebooks: list) -> np.ndarray:
    """Vectors that codes stand for: the middle of the integers' steps, in the original scale."""
    width = len(codebooks[0][0])
    out = np.empty((len(codes), len(codebooks) * width))
    for row, code in enumerate(codes):
        at = bytes.fromhex(code)
        out[row] = [(x + 0.5) / SCALE for k, e in enumerate(at) for x in codebooks[k][e]]
    return out


def codebook_digest(codebooks: list) -> str:
    """SHA-256 of all integers by part, entry and position, joined by commas."""
    flat = ",".join(str(x) for part in codebooks for entry in part for x in entry)
    return hashlib.sha256(flat.encode()).hexdigest()


def compress_vectors(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable vector.

    ``label_error`` is the error summed over the rows of equal label, nulls together; labels are
    summed before they meet the rows again, in an equi-join whose hot keys Spark can split.
    """
    kept = df.where(usable(F.col(vector))).select(
        F.col(id_col).alias("_key"), F.col(label).alias("_label"), F.col(vector).alias("_vector")
    )
    books, dim = fit_codebooks(kept, "_key", "_vector", parts, entries, rounds)
    coded = stage(encode_vectors(kept, "_vector", books, dim), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy(F.col("_label").alias("_of")).agg(
        F.when(total > F.lit(LONGEST), F.lit(LONGEST)).otherwise(total.cast("bigint")).alias("label_error")
    )
    return coded.join(by_label, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_key").alias(id_col), "code", "error", "label_error",
        F.lit(codebook_digest(books)).alias("codebooks_sha256"),
    )
