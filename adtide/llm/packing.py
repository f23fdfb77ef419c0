"""Best-fit packing of tokenised documents into sequences.

Only the number of pieces of each length decides a packing, and there are at most ``CAPACITY``
lengths. So the instance is reduced to that histogram, packed on the driver, and the places are
dealt out to the pieces by their rank among pieces of equal length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.common import worker_state
from adtide.sources.files import stage

CAPACITY = 2048
END = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk bigint, local_rank bigint"
)


def encoder(vocabulary: str):
    """Text -> ids as the tokenizers file gives them.

    The same ranks in tiktoken give the same ids at a quarter of the time; a text that spells a
    special token goes through tokenizers, which alone treats it as one.
    """
    state = worker_state()
    if ("encoder", vocabulary) not in state:
        import base64
        import os

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))

        def encode(text: str) -> list[int]:
            if SPECIAL in text:
                return full.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        state["encoder", vocabulary] = encode
    return state["encoder", vocabulary]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    head = length % capacity or min(length, capacity)
    return [(0, head)] + [(at, capacity) for at in range(head, length, capacity)]


def _pieces(capacity: int, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        chunk, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(END)
                packed = np.array(ids, dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(packed[start : start + length].tobytes())
                    out.append((doc_id, k, start, length, crc, chunk, seen[length]))
                    seen[length] += 1
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "local_rank"],
            )

    return run


def tokenised_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """A staged row per piece, numbered within its task and length. Null text is the empty text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(rows.mapInArrow(_pieces(capacity, vocabulary), PIECES), "pieces")


class Plan:
    """Places for pieces of each length: runs of equal places for consecutive ranks."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.left = [0] * (capacity + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.sizes = sorted(counts)  # of what is left
        self.next_rank = [0] * (capacity + 1)
        self.bins = 0
        self.fixed_bins = 0
        self.runs: list[tuple[int, int, int, int]] = []  # length, first rank, first bin, offset

    def _place(self, length: int, n: int, first_bin: int, offset: int) -> None:
        self.runs.append((length, self.next_rank[length], first_bin, offset))
        self.next_rank[length] += n
        self.left[length] -= n
        if not self.left[length]:
            self.sizes.pop(bisect.bisect_left(self.sizes, length))

    def _fix(self, lengths: list[int], n: int) -> None:
        """n bins that hold these lengths each, for good."""
        at, offset = self.bins, 0
        self.bins += n
        for x in lengths:
            self._place(x, n, at, offset)
            offset += x

    def _smallest(self, k: int, without: int) -> list[int]:
        """The k smallest lengths left besides one piece of length ``without``."""
        out: list[int] = []
        for x in self.sizes:
            n = self.left[x] - (x == without)
            out += [x] * min(n, k - len(out))
            if len(out) == k:
                break
        return out

    def _best_pair(self, room: int, without: int) -> int:
        """The largest sum of two pieces left that fits into room."""
        lo, hi, best = 0, len(self.sizes) - 1, 0
        while lo <= hi:
            a, b = self.sizes[lo], self.sizes[hi]
            total = a + b
            if total > room:
                hi -= 1
                continue
            spare = self.left[a] - (a == without)
            if spare > 0 and self.left[b] - (b == without) > 0 and (a != b or spare > 1):
                best = max(best, total)
            lo += 1
        return best

    def reduce(self) -> None:
        """Fix the sets that dominate every other set with their longest piece.

        For the longest piece j: alone if nothing fits beside it; with a piece that fills the
        bin exactly (it can take the place of whatever else stood beside j); with the longest
        piece that fits, if no two fit, or if no three fit and no two are longer than that piece.
        """
        for j in sorted(self.sizes, reverse=True):
            while self.left[j]:
                room = self.capacity - j
                least = self._smallest(3, j)
                if not least or least[0] > room:
                    self._fix([j], self.left[j] if room < j else 1)
                    continue
                k = self.sizes[bisect.bisect_right(self.sizes, room) - 1]
                if k == j and self.left[j] == 1:
                    k = self.sizes[bisect.bisect_left(self.sizes, j) - 1]
                n = self.left[j] // 2 if k == j else min(self.left[j], self.left[k])
                lone_pair = len(least) < 2 or least[0] + least[1] > room
                no_three = len(least) < 3 or sum(least) > room
                # each holds for all n at once: fewer pieces left only make other sets worse
                if j + k == self.capacity or lone_pair or (no_three and k >= self._best_pair(room, j)):
                    self._fix([j, k], n)
                else:
                    break
        self.fixed_bins = self.bins

    def best_fit(self) -> None:
        """The rest, longest first, each into the fullest bin with room; equal bins at once."""
        free: list[tuple[int, int, int]] = []  # room, first bin, bins; sorted
        for s in sorted(self.sizes, reverse=True):
            while self.left[s]:
                at = bisect.bisect_left(free, (s, -1, -1))
                if at < len(free):
                    room, first, m = free.pop(at)
                else:
                    room, first = self.capacity, self.bins
                    m = -(-self.left[s] // (room // s))
                    self.bins += m
                each = min(room // s, self.left[s])
                whole = min(m, self.left[s] // each)
                if whole:
                    for i in range(each):
                        self._place(s, whole, first, self.capacity - room + i * s)
                    if room - each * s:
                        bisect.insort(free, (room - each * s, first, whole))
                if whole < m:
                    rest = self.left[s]  # fewer than fill one more bin of this kind
                    for i in range(rest):
                        self._place(s, 1, first + whole, self.capacity - room + i * s)
                    bisect.insort(free, (room - rest * s, first + whole, 1))
                    if m - whole > 1:
                        bisect.insort(free, (room, first + whole + 1, m - whole - 1))

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys (length, first rank) in order, and first bin minus first rank, and offset."""
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 4)
        return (runs[:, 0] << 48) + runs[:, 1], runs[:, 2] - runs[:, 1], runs[:, 3]


def _assign(keys: np.ndarray, bins: np.ndarray, offsets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(bins[at] + rank), pa.array(offsets[at])],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every staged piece.

    The driver gets one number for each length. A piece's rank is its rank in its task plus the
    pieces of that length in earlier tasks, so no length is ever gathered.
    """
    counts = pieces.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    counts = stage(counts, "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, capacity)
    plan.reduce()
    plan.best_fit()
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["chunk", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.col("before")).alias("rank")
    )
    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    return ranked.mapInArrow(_assign(*plan.table()), schema)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Token spans of all documents, packed into few sequences of at most ``capacity`` tokens.

    Each document is its ids and one end id. Only longer ones are cut, the first piece being the
    short one. Rows that repeat an id are packed one by one; an empty table gives no row.
    """
    return pack_pieces(tokenised_pieces(docs, id_col, text_col, capacity, vocabulary), capacity)
