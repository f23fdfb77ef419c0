"""Language-model scoring with a hidden Markov model over word classes.

A word belongs to the class of its last letters; a hidden state emits classes, and a class emits its
words by their counts in the training texts. Texts are stored once as word numbers in chunks, each
with the words that occur in it. Baum-Welch runs over all whole texts of the training chunks in parallel
and adds up expected counts; scoring runs the scaled forward recursion over each whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import LOWER, spread
from adtide.sources.files import stage

STATES = 8
CLASSES = 1 << 14
END_CLASS = 0
ENDING = 4
ITERATIONS = 4
CHUNK_WORDS = 1_000_000
DISCOUNT = 0.5
PRIOR = 0.01
BATCH_WORDS = 100_000

CHUNKS = (
    "chunk bigint, ids array<bigint>, learn array<boolean>, lengths binary, words binary, hashes binary, "
    "classes binary, counts binary"
)


def word_class(word: bytes, classes: int = CLASSES) -> int:
    """Class of a word by its last letters; 0 is the end of a text."""
    return 1 + xxhash.xxh3_64_intdigest(word[-ENDING:]) % (classes - 1)


def _encode(classes: int):
    """(id, learn, text) to chunks: numbers of words, and for each different word its hash, class
    and count in the chunk's training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        ids: list = []
        learn: list[bool] = []
        lengths: list[int] = []
        numbers: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal nth
            words = np.array(numbers, dtype="<i4")
            owner = np.repeat(np.array(learn, dtype=bool), lengths)
            counts = np.bincount(words[owner], minlength=len(known)).astype("<i4")
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
            kinds = np.fromiter((word_class(w, classes) for w in known), np.int32, len(known))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + nth]), pa.array([ids], pa.list_(pa.int64())), pa.array([learn], pa.list_(pa.bool_())),
                    pa.array([np.array(lengths, dtype="<i4").tobytes()]), pa.array([words.tobytes()]),
                    pa.array([hashes.astype("<u8").tobytes()]), pa.array([kinds.astype("<i4").tobytes()]), pa.array([counts.tobytes()]),
                ],
                names=["chunk", "ids", "learn", "lengths", "words", "hashes", "classes", "counts"],
            )
            nth += 1
            for x in (known, ids, learn, lengths, numbers):
                x.clear()
            return out

        for batch in batches:
            for doc_id, trains, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                number = known.setdefault
                mine = [number(w, len(known)) for w in (text.as_py() or "").encode().translate(LOWER).split()]
                numbers += mine
                ids.append(doc_id)
                learn.append(trains)
                lengths.append(len(mine))
                if len(numbers) >= CHUNK_WORDS:
                    yield flush()
        if ids:
            yield flush()

    return run


def encode_texts(docs: DataFrame, id_col: str, text_col: str, learn: Column, classes: int = CLASSES) -> DataFrame:
    """The texts as staged chunks of about a million words."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("text")
    )
    return stage(rows.mapInArrow(_encode(classes), CHUNKS), "chunks")


def _arrays(row: dict) -> dict:
    """A chunk's columns as arrays."""
    kinds = {"lengths": "<i4", "words": "<i4", "hashes": "<u8", "classes": "<i4", "counts": "<i4"}
    return {k: np.frombuffer(row[k], dtype=t) for k, t in kinds.items() if k in row}


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            a = _arrays(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(a["hashes"]), row["chunk"])), pa.array(np.arange(len(a["hashes"]), dtype=np.int32)),
                    pa.array(a["hashes"].view("<i8")), pa.array(a["classes"]), pa.array(a["counts"].astype(np.int64)),
                ],
                names=["chunk", "at", "word", "class", "n"],
            )


def word_requests(chunks: DataFrame) -> DataFrame:
    """(chunk, at, word, class, n) for each different word of each chunk."""
    return chunks.select("chunk", "hashes", "classes", "counts").mapInArrow(
        _vocabulary, "chunk bigint, at int, word bigint, class int, n bigint"
    )


class Hmm:
    """Start, transition and class-emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, states: int = STATES, classes: int = CLASSES, seed: int = 1) -> Hmm:
        """Sticky states with uneven random emissions, the same for each run."""
        rng = np.random.default_rng(seed)
        emit = rng.gamma(1.0, size=(states, classes)) + 0.2
        move = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * 0.9
        return cls(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Hmm:
        """Probabilities from expected counts; every class keeps a little mass in every state."""
        start, move = start + 1.0, move + 1.0
        whole = emit.sum(axis=0)
        base = (whole + 1.0) / (whole.sum() + len(whole))
        emit = emit + PRIOR * len(whole) * base
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def text_counts(
    model: Hmm, classes: np.ndarray, first: np.ndarray, lengths: np.ndarray, block: int = BATCH_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions, and the log-likelihood, of whole class sequences.

    ``first`` is where each sequence begins in ``classes``; longest first. At each time the sequences
    that have ended are left out. Times are cut into blocks of about ``block`` classes: the state
    before each is kept and its alphas are computed again on the way back, so a sequence of any
    length needs the arrays of one block.
    """
    k, steps = len(model.start), int(lengths[0])
    emit, move = np.ascontiguousarray(model.emit.T), model.move
    back = np.ascontiguousarray(move.T)
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")
    cuts, size = [0], 0
    for t, n in enumerate(alive.tolist()):
        if size and size + n > block:
            cuts.append(t)
            size = 0
        size += n
    cuts.append(steps)

    def forward(b: int, a: np.ndarray | None):
        n = alive[cuts[b] : cuts[b + 1]]
        offsets = np.concatenate([[0], np.cumsum(n)])
        row = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
        seen = classes[first[row] + np.repeat(np.arange(cuts[b], cuts[b + 1]), n)]
        emitted = emit[seen]
        alphas, scales = np.empty_like(emitted), np.empty((len(seen), 1))
        bounds = offsets.tolist()
        for lo, hi in zip(bounds, bounds[1:]):
            x = (model.start if a is None else a[: hi - lo] @ move) * emitted[lo:hi]
            scale = x.sum(axis=1, keepdims=True)
            scales[lo:hi] = scale
            a = alphas[lo:hi] = x / scale
        return seen, emitted, alphas, scales, row, bounds, a

    before: list[np.ndarray | None] = [None]
    log_likelihood = 0.0
    for b in range(len(cuts) - 1):
        part = forward(b, before[b])
        log_likelihood += float(np.log(part[3]).sum())
        before.append(part[-1])
    start, moves, emissions = np.zeros(k), np.zeros((k, k)), np.zeros((k, model.emit.shape[1]))
    beta = np.ones((0, k))
    for b in range(len(cuts) - 2, -1, -1):
        if b < len(cuts) - 2:
            part = forward(b, before[b])
        seen, emitted, alphas, scales, row, bounds, _ = part
        emitted /= scales
        betas, aheads = np.empty_like(emitted), np.empty_like(emitted)
        for lo, hi in zip(bounds[-2::-1], bounds[:0:-1]):
            if len(beta) < hi - lo:
                beta = np.concatenate([beta, np.ones((hi - lo - len(beta), k))])
            betas[lo:hi] = beta
            ahead = aheads[lo:hi] = emitted[lo:hi] * beta
            beta = ahead @ back
        gamma = alphas * betas
        for j in range(k):
            emissions[j] += np.bincount(seen, weights=gamma[:, j], minlength=emissions.shape[1])
        inner = np.repeat(bounds[:-2], np.diff(bounds[1:])) + row[bounds[1] :]
        moves += alphas[inner.astype(np.int64)].T @ aheads[bounds[1] :]
        if before[b] is None:
            start += gamma[: bounds[1]].sum(axis=0)
        else:
            moves += before[b][: bounds[1]].T @ aheads[: bounds[1]]
    return start, moves * move, emissions, log_likelihood


def expected_counts(model: Hmm, sequences: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """``text_counts`` of padded sequences, (time, sequence), longest first."""
    return text_counts(model, sequences.T.ravel(), np.arange(len(lengths)) * sequences.shape[0], lengths)


def _groups(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where whole texts begin and their lengths, longest first, at most BATCH_WORDS texts at a time."""
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    for at in range(0, len(order), BATCH_WORDS):
        yield starts[order[at : at + BATCH_WORDS]], lengths[order[at : at + BATCH_WORDS]]


def _with_ends(a: dict) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a chunk's words with an end class after each text, and where the texts end."""
    ends = np.cumsum(a["lengths"].astype(np.int64) + 1)
    out = np.full(int(ends[-1]), END_CLASS, dtype=np.int32)
    inner = np.ones(len(out), dtype=bool)
    inner[ends - 1] = False
    out[inner] = a["classes"][a["words"]]
    return out, ends


def _expect(model: Hmm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, log_likelihood = None, 0.0
        for batch in batches:
            for row in batch.to_pylist():
                a = _arrays(row)
                classes, ends = _with_ends(a)
                learn = np.array(row["learn"], dtype=bool)
                if not learn.any():
                    continue
                size = a["lengths"].astype(np.int64) + 1
                classes = classes[np.repeat(learn, size)]
                for first, lengths in _groups(np.cumsum(size[learn])):
                    *counts, ll = text_counts(model, classes, first, lengths)
                    total = counts if total is None else [x + y for x, y in zip(total, counts, strict=True)]
                    log_likelihood += ll
        if total is None:
            return
        start, move, emit = total
        # one row for each state: rows of many tasks are summed by state
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(start)), pa.int32()), pa.array(start), pa.array([x.astype("<f8").tobytes() for x in move]),
                pa.array([x.astype("<f4").tobytes() for x in emit]), pa.array([log_likelihood / len(start)] * len(start)),
            ],
            names=["state", "start", "move", "emit", "ll"],
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counts of equal states, as rows come."""
    sums: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            new = [r["start"], np.frombuffer(r["move"], "<f8"), np.frombuffer(r["emit"], "<f4").astype(np.float64), r["ll"]]
            old = sums.get(r["state"])
            sums[r["state"]] = new if old is None else [x + y for x, y in zip(old, new, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()], pa.float64()),
            pa.array([v[1].astype("<f8").tobytes() for v in sums.values()], pa.binary()),
            pa.array([v[2].astype("<f4").tobytes() for v in sums.values()], pa.binary()), pa.array([v[3] for v in sums.values()], pa.float64()),
        ],
        names=["state", "start", "move", "emit", "ll"],
    )


COUNTS = "state int, start double, move binary, emit binary, ll double"


def train(chunks: DataFrame, states: int = STATES, classes: int = CLASSES, iterations: int = ITERATIONS) -> tuple[Hmm, list[float]]:
    """Baum-Welch over all training texts; also the log-likelihood before each step.

    Each task sums the counts of its chunks; sums of tasks are added by state in two rounds. The
    driver gets ``states`` rows of ``classes`` numbers, whatever the input's size.
    """
    model, history = Hmm.initial(states, classes), []
    data = chunks.select("learn", "lengths", "words", "classes")
    for _ in range(iterations):
        parts = data.mapInArrow(_expect(model), COUNTS)
        some = spread(parts.withColumn("salt", F.spark_partition_id() % 16), "state", "salt").drop("salt").mapInArrow(_add, COUNTS)
        rows = sorted(spread(some, "state").mapInArrow(_add, COUNTS).collect(), key=lambda r: r["state"])
        if not rows:
            break
        model = Hmm.from_counts(
            np.array([r["start"] for r in rows]), np.stack([np.frombuffer(bytes(r["move"]), "<f8") for r in rows]),
            np.stack([np.frombuffer(bytes(r["emit"]), "<f4").astype(np.float64) for r in rows]),
        )
        history.append(sum(r["ll"] for r in rows))
    return model, history


def forward_scores(model: Hmm, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural-log likelihood of each class sequence by the scaled forward recursion, over its whole
    length; sequences run side by side, longest first."""
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    emit = np.ascontiguousarray(model.emit.T)
    alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
    total = np.zeros(len(order))
    a = np.empty((0, 0))
    for t in range(int(size[0])):
        n = alive[t]
        a = (np.broadcast_to(model.start, (n, len(model.start))) if t == 0 else a[:n] @ model.move) * emit[classes[first[:n] + t]]
        s = a.sum(axis=1)
        total[:n] += np.log(s)
        a = a / s[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


def _score(model: Hmm, n_train: int, n_types: int):
    """Sorted rows of each chunk, answers before texts, to one row for each text."""

    def finish(row: dict, count: np.ndarray, share: np.ndarray) -> pa.RecordBatch:
        a = _arrays(row)
        classes, ends = _with_ends(a)
        size = a["lengths"].astype(np.int64)
        owner = np.repeat(np.arange(len(size)), size)
        c = count[a["words"]]
        floor = n_train + 0.5 * (n_types + 1)
        n_end = count[-1]
        base = np.bincount(owner, weights=np.log10((c + 0.5) / floor), minlength=len(size)) + math.log10((n_end + 0.5) / floor)
        within = np.bincount(owner, weights=share[a["words"]], minlength=len(size))
        score = forward_scores(model, classes, ends) / math.log(10) + within
        known = np.bincount(owner, weights=c > 0, minlength=len(size)).astype(np.int64) + int(n_end > 0)
        n = len(size)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(row["ids"], pa.int64()), pa.array([not x for x in row["learn"]]), pa.array(size + 1), pa.array(known),
                pa.array(np.full(n, n_train)), pa.array(base), pa.array(score),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, answers = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in ("chunk", "at", "n", "share")}
                if row["at"] is not None:
                    if row["chunk"] != chunk:
                        chunk, answers = row["chunk"], []
                    answers.append((np.frombuffer(row["at"], "<i4"), np.frombuffer(row["n"], "<i8"), np.frombuffer(row["share"], "<f4")))
                    continue
                whole = batch.slice(k, 1).to_pylist()[0]
                size = len(whole["classes"]) // 4
                count, share = np.zeros(size + 1), np.zeros(size)
                if whole["chunk"] == chunk:
                    for at, n, q in answers:
                        count[at], share[at] = n, q
                count[-1] = whole["n_end"]
                yield finish(whole, count, share)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of one batch as one row for each chunk."""
    for batch in batches:
        chunk = batch.column(0).to_numpy()
        order = np.argsort(chunk, kind="stable")
        cuts = np.flatnonzero(np.diff(chunk[order])) + 1
        at, n, share = (batch.column(k).to_numpy()[order] for k in (1, 2, 3))
        starts = np.concatenate([[0], cuts]) if len(order) else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunk[order][starts], pa.int64()),
                *[pa.array([x.tobytes() for x in (np.split(v, cuts) if len(order) else [])], pa.binary()) for v in (at.astype("<i4"), n.astype("<i8"), share.astype("<f4"))],
            ],
            names=["chunk", "at", "n", "share"],
        )


def score_texts(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
    classes: int = CLASSES, iterations: int = ITERATIONS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    ``learn`` marks the rows to learn from (null: not). Word counts cover all of them. Null and empty
    texts are the end token alone. Without a training text the model stays as it starts.

    Each chunk asks once for each of its different words, so a word of any frequency is a row per
    chunk; counts are summed by an aggregate and come back by an equi-join, and meet the chunk sorted
    before its texts. Within a class a known word has (count - 0.5) of the class's tokens, and what
    was taken off is the share of one unknown word; a class without known words gives that all.
    """
    chunks = encode_texts(docs, id_col, text_col, learn, classes)
    model, _ = train(chunks, states, classes, iterations)
    requests = word_requests(chunks)
    counts = stage(requests.groupBy("word", "class").agg(F.sum("n").alias("c")), "word_counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    flags = F.explode(F.arrays_zip("learn")).alias("x")
    n_end = chunks.select(flags).where("x.learn").count()
    by_class = stage(
        counts.where("c > 0").groupBy("class").agg(F.sum("c").alias("m"), F.count("*").alias("v")), "class_counts"
    )
    taken = F.lit(DISCOUNT)
    share = (
        F.when(F.col("m").isNull(), F.lit(0.0))
        .when(F.col("c") > 0, F.log10((F.col("c") - taken) / F.col("m")))
        .otherwise(F.log10(taken * F.col("v") / F.col("m")))
    )
    known = counts.join(by_class, "class", "left").select("word", F.col("c").alias("n"), share.alias("share"))
    answers = requests.select("chunk", "at", "word").join(known, "word").select("chunk", "at", "n", "share")
    answers = answers.mapInArrow(_pack, "chunk bigint, at binary, n binary, share binary")
    wide = chunks.select(
        "chunk", *[F.lit(None).cast("binary").alias(c) for c in ("at", "n", "share")], F.lit(n_end).cast("bigint").alias("n_end"),
        "ids", "learn", "lengths", "words", "classes",
    )
    both = answers.unionByName(wide, allowMissingColumns=True)
    ordered = spread(both, "chunk").sortWithinPartitions("chunk", F.col("at").isNull())
    scored = ordered.mapInArrow(
        _score(model, totals["n"] + n_end, totals["v"] + int(n_end > 0)),
        "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
    return scored.withColumnRenamed("id", id_col)
