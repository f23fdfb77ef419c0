"""Quality rules: base counts of a text, and the fertility of public tokenisers over it."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import worker_state

VOCABULARY = "byte_bpe_multi_50k"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
KNOWN_WORDS = 300_000
FLUSH_WORDS = 200_000

#: Bands by language or script. A text is rejected outside of one: characters (without spaces) per
#: token, share of tokens that are single bytes of a longer character, and token entropy in bits
#: as a share of the largest that so many tokens can have. The first key that fits is taken: the
#: text's language, else its main script, else "other".
BANDS: dict[str, dict[str, tuple[float, float]]] = {
    "en": {"fertility": (1.80, 12.0), "fallback": (0.0, 0.05), "entropy": (0.53, 1.0)},
    "de": {"fertility": (1.70, 12.0), "fallback": (0.0, 0.10), "entropy": (0.53, 1.0)},
    "es": {"fertility": (1.75, 12.0), "fallback": (0.0, 0.10), "entropy": (0.53, 1.0)},
    "fr": {"fertility": (1.60, 12.0), "fallback": (0.0, 0.10), "entropy": (0.53, 1.0)},
    "latin": {"fertility": (1.40, 12.0), "fallback": (0.0, 0.15), "entropy": (0.50, 1.0)},
    "other": {"fertility": (0.25, 16.0), "fallback": (0.0, 0.90), "entropy": (0.40, 1.0)},
}
#: Below so many tokens the measures of a text say nothing, and no band applies.
MIN_TOKENS = 20

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_tokens bigint, token_chars double, fallback_share double, entropy double, band string, "
    "base_failed boolean, kept boolean"
)


class Fertility:
    """A public vocabulary, and which of its tokens are pieces of a character."""

    def __init__(self, vocabulary: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coding = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.encode = coding.encode_ordinary
        self.bits = max(ranks.values()).bit_length()
        self.is_byte = np.zeros(1 << self.bits, dtype=bool)
        self.is_byte[[rank for token, rank in ranks.items() if len(token) == 1 and token[0] > 127]] = True


def repeated_words(words: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, words in windows that the text has twice or more; ``words`` are word numbers."""
    with np.errstate(over="ignore"):
        mixed = words.astype(np.uint64) + np.uint64(1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        n = max(0, len(words) - window + 1)
        keys = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for i in range(window):
            keys = keys * np.uint64(0xD6E8FEB86659FD93) + mixed[i : i + n]
        keys ^= keys >> np.uint64(31)
    inside = np.flatnonzero(text[:n] == text[window - 1 : window - 1 + n])
    keys = keys[inside]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + window + 1, dtype=np.int32)
    np.add.at(cover, inside[twice], 1)
    np.add.at(cover, inside[twice] + window, -1)
    return np.bincount(text[np.cumsum(cover)[: len(words)] > 0], minlength=len(ends))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


#: ASCII and the Latin letters with marks.
_BASIC = re.compile("[^\x00-\x7fÀ-ɏ]+")


def main_script(text: str) -> str:
    """``latin`` if at least half of a text's characters from A on are Latin letters, else ``other``."""
    if text.isascii():
        return "latin"
    beyond = len(text) - len(_BASIC.sub("", text))
    return "latin" if 2 * beyond <= len(text) else "other"


def in_bands(bands: dict, measures: dict[str, float]) -> bool:
    return all(lo <= measures[k] <= hi for k, (lo, hi) in bands.items())


def _flush(rows: list[tuple], numbers: list[int], tokens: list[np.ndarray], model: Fertility, bands: dict) -> pa.RecordBatch:
    n = len(rows)
    repeats = repeated_words(np.array(numbers, dtype=np.int64), np.cumsum([r[2] for r in rows]))
    n_tokens = np.array([len(t) for t in tokens])
    token, owner = np.concatenate(tokens), np.repeat(np.arange(n), n_tokens)
    fallback = np.bincount(owner, weights=model.is_byte[token], minlength=n)
    keys = np.sort((owner << model.bits) | token)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(np.append(first, len(keys)))
    logs = np.bincount(keys[first] >> model.bits, weights=times * np.log2(times), minlength=n)
    out = []
    for k, (doc_id, band, n_words, chars, symbols, dup) in enumerate(rows):
        some = max(int(n_tokens[k]), 1)
        entropy = math.log2(some) - float(logs[k]) / some
        measures = {
            "fertility": chars / some, "fallback": float(fallback[k]) / some,
            "entropy": min(1.0, entropy / math.log2(min(max(some, 2), 1 << 12))),
        }
        failed = n_words < MIN_WORDS or 100 * int(repeats[k]) > MAX_REPEATED_PERCENT * n_words
        good = n_tokens[k] < MIN_TOKENS or in_bands(bands[band], measures)
        out.append((
            doc_id, n_words, chars, symbols, dup, int(repeats[k]), int(n_tokens[k]), measures["fertility"],
            measures["fallback"], entropy, band, failed, bool(not failed and good),
        ))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.float64()] * 3 + [pa.string(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
    )


def _measure(bands: dict, vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()
        model = state.get(("fertility", vocabulary)) or state.setdefault(("fertility", vocabulary), Fertility(vocabulary))
        known: dict[bytes, int] = {}
        rows: list[tuple] = []
        numbers: list[int] = []
        tokens: list[np.ndarray] = []
        for batch in batches:
            for doc_id, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py() or ""
                words = text.encode().split()  # at ASCII white space only, unlike str.split
                number = known.setdefault
                numbers += [number(w, len(known)) for w in words]
                tokens.append(np.array(model.encode(text), dtype=np.int64))
                chars = len(text) - sum(map(text.count, SPACES))
                band = lang if lang in bands else main_script(text)
                rows.append((doc_id, band, len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text)))
                if len(numbers) >= FLUSH_WORDS:
                    yield _flush(rows, numbers, tokens, model, bands)
                    rows, numbers, tokens = [], [], []
                    if len(known) > KNOWN_WORDS:
                        known.clear()  # numbers only have to agree within a text
        if rows:
            yield _flush(rows, numbers, tokens, model, bands)

    return run


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    bands: dict[str, dict[str, tuple[float, float]]] | None = None,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Base counts, tokeniser measures and the verdict for every row, in the row's own task.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEATED_PERCENT`` of them in
    repeated windows. ``kept``: not that, and inside all bands of the text's language or script.
    Null and empty texts fail; repeated rows give repeated results; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(_measure(bands or BANDS, vocabulary), SCHEMA)


def _keep(bands: dict, vocabulary: str, at: tuple[int, int]):
    measure = _measure(bands, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows), pa.int64()), batch.column(at[0]).cast(pa.string()), batch.column(at[1]).cast(pa.string())],
                names=["doc_id", "lang", "text"],
            )
            kept = pa.concat_arrays([b.column("kept") for b in measure(iter([numbered]))])
            yield batch.filter(kept)

    return run


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    at = (docs.columns.index(lang_col), docs.columns.index(text_col))
    return docs.mapInArrow(_keep(BANDS, VOCABULARY, at), docs.schema)
