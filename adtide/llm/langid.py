"""Language identification with interpolated Kneser-Ney character models.

The models of all languages are sorted arrays of n-gram hashes with a column for each language.
A text gets the language with the lowest cross-entropy per character; a cross-entropy above what
the language's own texts show is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.mixing import uniform
from adtide.sources.files import stage

ORDER = 4
#: The classifier is fitted on about so many characters of each language, in whole texts picked by
#: a hash of the id, and calibrated on as many texts of each language at most.
TRAIN_CHARS = 2_000_000
CALIBRATION_TEXTS = 1_000
REJECT_QUANTILE = 0.999
EDGE = "\x02"
UNKNOWN = "und"
FLUSH_CHARS = 600_000
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Raw hashes of the 0..order characters that end at each position, and the scored positions.

    Words are joined with ``order - 1`` edge marks before each; a word's letters and the first
    mark after it are scored.
    """
    pad = EDGE * (order - 1)
    joined = pad + pad.join(w + EDGE for w in words)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    block = lengths + order
    starts = np.concatenate([[0], np.cumsum(block)[:-1]]) + order - 1
    inner = np.arange(int((lengths + 1).sum())) - np.repeat(np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]), lengths + 1)
    scored = np.repeat(starts, lengths + 1) + inner
    with np.errstate(over="ignore"):
        letter = _mix(chars + _SALT)
        raw = [np.zeros(len(chars), dtype=np.uint64)]
        for k in range(1, order + 1):
            shifted = np.zeros(len(chars), dtype=np.uint64)
            shifted[k - 1 :] = letter[: len(chars) - k + 1]
            raw.append(raw[-1] * np.uint64(0xD6E8FEB86659FD93) + shifted if k > 1 else shifted.copy())
    return raw, scored


def fit_language(words: list[str], times: np.ndarray, order: int) -> list[dict[str, np.ndarray]]:
    """Tables of one language for the orders 1..order: discounted shares and back-off weights.

    The highest order uses counts, lower ones the number of different characters before. Each
    n-gram of the given words occurs in one place of the tables.
    """
    raw, scored = gram_hashes(words, order)
    weight = np.repeat(times, [len(w) + 1 for w in words])
    tables: list[dict[str, np.ndarray]] = []
    for k in range(1, order + 1):
        if k == order:
            at, value = scored, weight
        else:  # one for each different longer n-gram
            longer = raw[k + 1][scored]
            _, one = np.unique(longer, return_index=True)
            at, value = scored[one], np.ones(len(one))
        gram, place, back = np.unique(raw[k][at], return_index=True, return_inverse=True)
        count = np.bincount(back, weights=value)
        history = raw[k - 1][at - 1][place] if k > 1 else np.zeros(len(gram), dtype=np.uint64)
        context, which = np.unique(history, return_inverse=True)
        total = np.bincount(which, weights=count)
        once, twice = float((count == 1).sum()), float((count == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        tables.append({
            "gram": gram, "share": np.maximum(count - discount, 0) / total[which],
            "context": context, "rest": 1 - np.bincount(which, weights=np.maximum(count - discount, 0)) / total,
        })
    return tables


class Model:
    """Sorted hash arrays for all languages together."""

    def __init__(self, languages: dict[str, list[dict[str, np.ndarray]]]) -> None:
        self.languages = sorted(languages)
        self.order = len(next(iter(languages.values())))
        self.levels = []
        for k in range(self.order):
            parts = [languages[x][k] for x in self.languages]
            grams = np.unique(np.concatenate([p["gram"] for p in parts]))
            contexts = np.unique(np.concatenate([p["context"] for p in parts]))
            share = np.zeros((len(grams) + 1, len(parts)), dtype=np.float32)
            rest = np.ones((len(contexts) + 1, len(parts)), dtype=np.float32)
            for j, p in enumerate(parts):
                share[np.searchsorted(grams, p["gram"]), j] = p["share"]
                rest[np.searchsorted(contexts, p["context"]), j] = p["rest"]
            self.levels.append((grams, share, contexts, rest))
        self.floor = 1.0 / (len(self.levels[0][0]) + 1)

    @staticmethod
    def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Positions of the wanted hashes; the last row of a table stands for absent ones."""
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return np.where(keys[at] == wanted, at, len(keys))

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log2 probabilities by language, and scored characters, for each word."""
        raw, scored = gram_hashes(words, self.order)
        p = np.full((len(scored), len(self.languages)), self.floor, dtype=np.float32)
        for k, (grams, share, contexts, rest) in enumerate(self.levels, 1):
            if k > 1:
                p *= rest[self._rows(contexts, raw[k - 1][scored - 1])]
            else:
                p *= rest[0]
            p += share[self._rows(grams, raw[k][scored])]
        length = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(length)[:-1]])
        return np.add.reduceat(np.log2(p), starts, axis=0), length


def _entropies(model: Model):
    """Batches of (id, text) to id and the cross-entropy for each language (null without a letter)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        known: dict[str, int] = {}
        fresh: list[str] = []
        sums = np.zeros((0, len(model.languages)))
        lengths = np.zeros(0, dtype=np.int64)
        ids: list = []
        numbers: list[int] = []
        counts: list[int] = []
        size = 0

        def flush():
            nonlocal sums, lengths, fresh, ids, numbers, counts, size
            if fresh:
                s, n = model.word_scores(fresh)
                sums, lengths, fresh = np.concatenate([sums, s]), np.concatenate([lengths, n]), []
            owner = np.repeat(np.arange(len(ids)), counts)
            at = np.array(numbers, dtype=np.int64)
            chars = np.bincount(owner, weights=lengths[at], minlength=len(ids))
            total = np.stack(
                [np.bincount(owner, weights=sums[at, j], minlength=len(ids)) for j in range(len(model.languages))], axis=1
            )
            out = (ids, -total / np.maximum(chars, 1)[:, None], chars > 0)
            ids, numbers, counts, size = [], [], [], 0
            if len(known) > 300_000:
                known.clear()
                sums, lengths = sums[:0], lengths[:0]
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = (text.as_py() or "").lower()
                words = text.split()
                if not any(map(str.isalpha, words)) and not any(map(str.isalpha, text)):
                    words = []
                for w in words:
                    at = known.get(w)
                    if at is None:
                        at = known[w] = len(known)
                        fresh.append(w)
                    numbers.append(at)
                ids.append(doc_id)
                counts.append(len(words))
                size += len(text)
                if size >= FLUSH_CHARS:
                    yield flush()
        if ids:
            yield flush()

    return run


def _calibrate(entropies: np.ndarray, truth: np.ndarray) -> tuple[float, np.ndarray]:
    """Temperature of the scores with the least log-loss, and a rejection bound for each language."""
    bounds = np.full(entropies.shape[1], np.inf)
    for j in range(entropies.shape[1]):
        own = entropies[truth == j, j]
        if len(own):
            bounds[j] = np.quantile(own, REJECT_QUANTILE)
    best, sharp = np.inf, 1.0
    for t in 2.0 ** np.arange(-2, 7):
        z = -t * (entropies - entropies.min(axis=1, keepdims=True))
        loss = (np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean() if len(z) else 0.0
        if loss < best:
            best, sharp = loss, float(t)
    return sharp, bounds


def _fit(order: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        tables = fit_language(group["word"].tolist(), group["n"].to_numpy(dtype=np.float64), order)
        blobs = [[t[k].astype("<u8" if k in ("gram", "context") else "<f8").tobytes() for t in tables] for k in ("gram", "share", "context", "rest")]
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "gram": [blobs[0]], "share": [blobs[1]], "context": [blobs[2]], "rest": [blobs[3]]})

    return run


def fit_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
    train_chars: int = TRAIN_CHARS,
) -> tuple[Model | None, float, np.ndarray | None]:
    """Model, temperature and rejection bounds from texts with a language.

    A language's share of texts is set so that about ``train_chars`` characters are expected; which
    texts those are depends on their ids. A text longer than ``train_chars`` gives that many characters
    from a place that depends on its id. The text with the lowest hash of its id is always taken and
    counted, so every labelled language is learned. One in ten of the others calibrates and is not
    counted, whatever the language's size; at most ``CALIBRATION_TEXTS`` of a language, by hash order.
    Only the tables of these bounded samples reach the driver. Without a labelled text the model is None.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    rows = rows.withColumn("at", F.xxhash64(F.lit(8), F.col("id").cast("string"), "text")).withColumn("size", F.length("text"))
    filled = rows.where(F.col("text").rlike(r"\S"))
    sizes = stage(filled.groupBy("lang").agg(F.sum("size").alias("chars"), F.min("at").alias("first")), "language_sizes")
    rate = F.least(F.lit(1.0), F.lit(float(train_chars)) / F.greatest("chars", F.lit(1)))
    start = 1 + F.floor(uniform(F.col("id"), 10) * F.greatest(F.col("size") - train_chars, F.lit(0))).cast("int")
    always = F.col("at") == F.col("first")
    picked = stage(
        filled.join(sizes, "lang").where(always | (uniform(F.col("id"), 8) < rate))
        .withColumn("held", ~always & (uniform(F.col("id"), 9) < 0.1))
        .select("lang", "at", "held", F.substring("text", start, F.lit(train_chars)).alias("text")),
        "language_sample",
    )
    words = (
        picked.where(~F.col("held")).select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
        .where("word != ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    )
    fitted = words.groupBy("lang").applyInPandas(
        _fit(order), "lang string, gram array<binary>, share array<binary>, context array<binary>, rest array<binary>"
    ).collect()
    if not fitted:
        return None, 1.0, None
    kinds = {"gram": "<u8", "share": "<f8", "context": "<u8", "rest": "<f8"}
    model = Model({
        r["lang"]: [{k: np.frombuffer(bytes(r[k][i]), dtype=t) for k, t in kinds.items()} for i in range(order)] for r in fitted
    })
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    held = picked.where("held").withColumn("nth", nth).where(F.col("nth") <= CALIBRATION_TEXTS).select("lang", "text")
    run = _entropies(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, h, some in run(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(h.tolist(), pa.list_(pa.float64())), pa.array(some)], names=["lang", "h", "some"]
            )

    seen = held.mapInArrow(score, "lang string, h array<double>, some boolean").where("some").collect()
    kept = [r for r in seen if r["lang"] in model.languages]
    entropies = np.array([r["h"] for r in kept]).reshape(-1, len(model.languages))
    truth = np.array([model.languages.index(r["lang"]) for r in kept], dtype=np.int64)
    return model, *_calibrate(entropies, truth)


def predict_language(
    docs: DataFrame, model: Model | None, sharpness: float, bounds: np.ndarray | None, id_col: str = "doc_id",
    text_col: str = "text", keep: dict[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` and the columns of ``keep`` for every row.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. The score is
    the calibrated share of the chosen language. Ties go to the first language by name.
    """
    keep = keep or {}
    rows = docs.select(F.struct(F.col(id_col).cast("bigint").alias("id"), *[c.alias(n) for n, c in keep.items()]).alias("row"), F.col(text_col).cast("string").alias("text"))
    carried = rows.schema["row"].dataType
    schema = f"row {carried.simpleString()}, lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(0).type
            if model is None:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([UNKNOWN] * n), pa.array([0.0] * n), pa.array([True] * n)],
                    names=["row", "lang_pred", "score", "rejected"],
                )
                continue
            for ids, h, some in _entropies(model)(iter([batch])):
                best = h.argmin(axis=1)
                low = h[np.arange(len(h)), best]
                share = 1 / np.exp(-sharpness * (h - low[:, None])).sum(axis=1)
                names = [model.languages[j] if s else UNKNOWN for j, s in zip(best, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(names), pa.array(np.where(some, share, 0.0)), pa.array(~some | (low > bounds[best]))],
                    names=["row", "lang_pred", "score", "rejected"],
                )

    out = rows.mapInArrow(run, schema)
    return out.select(F.col("row.id").alias(id_col), *[F.col(f"row.{n}").alias(n) for n in keep], "lang_pred", "score", "rejected")
