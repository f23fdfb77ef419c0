"""Toxicity by a weighted lexicon.

Texts are folded (case, marks, look-alike letters, digits and signs read as letters) and searched
with an Aho-Corasick automaton. Hits inside an exception phrase do not count. The weights of the
hits, taken by themselves and per length, give the score.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import worker_state
from adtide.llm.mixing import uniform
from adtide.sources.files import stage

#: The classifier is fitted on at most so many labelled texts, picked by a hash of their ids.
LABELLED = 40_000
LEXICON = 2_000
#: Letters of a piece of a word; whole words count at any length.
LONGEST = 10
#: A longer word is a run of text without blanks: its pieces' surroundings are the letters after them.
RUN = 40
#: Candidates and words that a task holds before it passes them on.
PART = 500_000
MIN_DOCS = 6
MIN_CONTEXTS = 5
MIN_WEIGHT = 3.0
EXCEPTION_DOCS = 5

# Letters of other alphabets, digits and signs that look like Latin letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "ß": "ss",
}
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l",
}
_WITHIN = {ord(k): v for k, v in SUBSTITUTES.items()}


class _Fold(dict):
    """Translation table filled as characters turn up: marks dropped, look-alikes replaced."""

    def __missing__(self, code: int) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)).lower() if not unicodedata.combining(c))
        plain = "".join(LOOK_ALIKES.get(c, c) for c in plain)
        self[code] = plain
        return plain


def fold(text: str, table: dict | None = None) -> list[str]:
    """Folded words: signs at the edges go, digits and signs between letters become letters."""
    words = text.lower().translate(_Fold() if table is None else table).split()
    out = []
    for w in words:
        if not w.isalpha():
            w = w.strip(".,;:!?\"'()[]{}<>*#%&~_-=+/\\|")
            if any(map(str.isalpha, w)) and not w.isalpha():
                w = w.translate(_WITHIN)
        if w:
            out.append(w)
    return out


def _table() -> dict:
    return worker_state().setdefault("fold", _Fold())


def word_grams(word: str) -> set[str]:
    """Candidates that a word holds: itself, and its pieces of up to LONGEST letters at every place.

    A blank at an end of a candidate is the word's edge.
    """
    edged = f" {word} "
    size = len(edged)
    grams = {edged}
    for at in range(size - 1):
        lead = at == 0
        for k in range(1 + lead, min(LONGEST + lead, size - 1 - at) + 1):
            grams.add(edged[at : at + k])
    for k in range(1, min(LONGEST, len(word)) + 1):
        grams.add(edged[-k - 1 :])
    return grams


def candidate_counts(texts: Iterator[str]) -> Iterator[tuple[Counter, dict[str, set[int]]]]:
    """Texts for each candidate, and (some of) its different surroundings, in parts of bounded size.

    Copies of one text repeat its words in the same surroundings, so different ones tell a marker
    from a copied passage. They are the word after, and in a long run without blanks the letters after.
    """
    docs: Counter = Counter()
    around: dict[str, set[int]] = defaultdict(set)
    table = _table()

    def note(gram: str, mark: int) -> None:
        marks = around[gram]
        if len(marks) < MIN_CONTEXTS:
            marks.add(mark)

    for text in texts:
        words = fold(text, table)
        after: dict[str, set[int]] = defaultdict(set)
        for w, follower in zip(words, [*words[1:], ""], strict=True):
            if len(after[w]) < MIN_CONTEXTS:
                after[w].add(zlib.crc32(follower.encode("utf-8", "surrogatepass")))
        seen: set[str] = set()
        for w, marks in after.items():
            grams = word_grams(w)
            seen |= grams
            if len(w) <= RUN:
                for gram in grams:
                    for mark in marks:
                        note(gram, mark)
                continue
            for at in range(len(w)):
                for k in range(1, min(LONGEST, len(w) - at) + 1):
                    note(w[at : at + k], zlib.crc32(w[at + k : at + k + 8].encode("utf-8", "surrogatepass")))
        docs.update(seen)
        if len(docs) > PART:
            yield docs, around
            docs, around = Counter(), defaultdict(set)
    yield docs, around


class Lexicon:
    """Weighted entries and exception phrases, and the logistic score over their hits."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]) -> None:
        self.weights, self.exceptions = weights, exceptions
        self.coefficients = np.zeros(4)

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (weight, len(entry.lstrip()), len(entry) - len(entry.rstrip())))
        for phrase in self.exceptions:
            machine.add_word(phrase, (None, len(phrase.lstrip()), len(phrase) - len(phrase.rstrip())))
        if len(machine):
            machine.make_automaton()
        return machine

    def features(self, text: str, machine, table: dict) -> tuple[float, float, float, int]:
        """Largest weight, log of the sum, log of the sum per hundred words, hits.

        Overlapping entries count once, with the largest weight; one inside an exception not at all.
        """
        words = fold(text, table)
        if not len(machine) or not words:
            return 0.0, 0.0, 0.0, 0
        hits, spared = [], []
        for end, (weight, length, edge) in machine.iter(" " + " ".join(words) + " "):  # spans without edges
            (hits if weight is not None else spared).append((end + 1 - length, end + 1 - edge, weight))
        kept: list[tuple[int, int, float]] = []
        for start, end, weight in sorted(hits):
            if any(a <= start and end <= b for a, b, _ in spared):
                continue
            if kept and start < kept[-1][1]:
                if weight > kept[-1][2]:
                    kept[-1] = (kept[-1][0], max(end, kept[-1][1]), weight)
                continue
            kept.append((start, end, weight))
        total = sum(w for *_, w in kept)
        return max((w for *_, w in kept), default=0.0), math.log1p(total), math.log1p(100 * total / len(words)), len(kept)

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.coefficients[0] + features[:, :3] @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Coefficients (intercept first) by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        gradient = design.T @ (y - p) - ridge * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(beta))
        move = np.linalg.solve(hessian, gradient)
        beta += move
        if np.abs(move).max() < 1e-6:
            break
    return beta


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = (t.as_py() or "" for b in batches for t in b.column(0))
    for docs, around in candidate_counts(texts):
        rows = [(g, n, sorted(around[g])) for g, n in docs.items()]
        g, n, f = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(g, pa.string()), pa.array(n, pa.int64()), pa.array(f, pa.list_(pa.int64()))], names=["gram", "n", "followers"]
        )


def _seen_in(grams: list[str], words: bool = True):
    """Per entry and word that holds it: texts of the batch with that word; with the empty word, of any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, table, counts = set(grams), _table(), Counter()
        known: dict[str, list[str]] = {}
        for b in batches:
            for t in b.column(0):
                any_word: set[str] = set()
                for w in set(fold(t.as_py() or "", table)):
                    held = known.get(w)
                    if held is None:
                        held = known[w] = list(word_grams(w) & wanted)
                    any_word.update(held)
                    if words:
                        counts.update((g, w) for g in held)
                counts.update((g, "") for g in any_word)
                if len(known) > PART:
                    known.clear()
        rows = [(g, w, n) for (g, w), n in counts.items()]
        g, w, n = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(w, pa.string()), pa.array(n, pa.int64())], names=["gram", "word", "n"])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """``text, toxic`` of at most ``most`` labelled rows, three quarters of that where there are more."""
    marks = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
    n = marks.count()
    marks = marks.where(uniform(F.col("_id"), 3) < min(1.0, 0.75 * most / max(n, 1))).limit(most)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(marks), "_id").select("text", "toxic")  # broadcast: at most `most` pairs of numbers


def fit_lexicon(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most: int = LABELLED,
) -> Lexicon:
    """Lexicon and score learned from labelled rows (``labels``: id and 0/1), a bounded number of them.

    Entries are words of any length and pieces of words, from every place, in at least ``MIN_DOCS``
    toxic texts and before different words, weighted by their log odds; a piece gives way to a longer
    one that is as frequent, and one from a word's inside to a beginning or word that holds it and
    weighs more. All such candidates are counted in the clean texts before the
    ``LEXICON`` best are kept. Exceptions are words that hold an entry but occur in clean texts only. Without labels of
    both kinds the score is one half or the only label's.
    """
    sample = stage(labelled_sample(docs, labels, id_col, text_col, label_col, most), "labelled")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    toxic, clean = (sample.where(F.col("toxic") == v).select("text") for v in (1, 0))
    counted = (
        toxic.mapInArrow(_count, "gram string, n bigint, followers array<bigint>").groupBy("gram")
        .agg(F.sum("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("followers"))).alias("f"))
        .where((F.col("n") >= MIN_DOCS) & (F.size("f") >= MIN_CONTEXTS))
        .select("gram", "n").collect()
    )
    in_toxic = {r["gram"]: r["n"] for r in counted}
    rows = clean.mapInArrow(_seen_in(list(in_toxic), words=False), "gram string, word string, n bigint").groupBy("gram").agg(
        F.sum(F.when(F.col("word") == "", F.col("n"))).alias("n")
    ).collect()
    in_clean = {r["gram"]: r["n"] for r in rows}
    weights = {
        g: math.log((n + 0.5) / (n_toxic + 1)) - math.log((in_clean.get(g, 0) + 0.5) / (n_clean + 1)) for g, n in in_toxic.items()
    }
    strong = {g: w for g, w in weights.items() if w >= MIN_WEIGHT}
    edged: dict[str, float] = {}  # the most weight of a strong entry from a word's start that holds a piece
    for g, w in strong.items():
        if g[0] == " ":
            for part in word_grams(g.strip()):
                edged[part] = max(edged.get(part, 0.0), w)
    strong = {g: w for g, w in strong.items() if g[0] == " " or w >= edged.get(g, 0.0)}
    longer = {part for g in strong for part in (g[:-1], g[1:]) if part in strong and in_toxic[g] == in_toxic[part]}
    ranked = sorted((g for g in strong if g not in longer), key=lambda g: (-strong[g] * math.log(in_toxic[g]), g))[:LEXICON]
    held = "gram string, word string, n bigint"
    seen = [
        part.mapInArrow(_seen_in(ranked), held).select("word", "gram", *[(F.col("n") * int(label == k)).alias(f"in_{k}") for k in (0, 1)])
        for label, part in ((0, clean), (1, toxic))
    ]
    spared = (
        seen[0].unionByName(seen[1]).where("word != ''").groupBy("gram", "word").agg(F.sum("in_0").alias("in_0"), F.sum("in_1").alias("in_1"))
        .where((F.col("in_0") >= EXCEPTION_DOCS) & (F.col("in_1") == 0)).select("word").distinct().collect()
    )
    exceptions = sorted(f" {r['word']} " for r in spared)
    lexicon = Lexicon({g: strong[g] for g in ranked}, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, table = lexicon.automaton(), _table()
        for b in batches:
            f = [lexicon.features(t.as_py() or "", machine, table)[:3] for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(f, pa.list_(pa.float64()))], names=["toxic", "f"])

    got = sample.mapInArrow(measure, "toxic int, f array<double>").collect()
    if got:
        lexicon.coefficients = fit_logistic(np.array([r["f"] for r in got]), np.array([r["toxic"] for r in got], dtype=float))
    return lexicon


def score_toxicity(
    docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None
) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``score``, ``predicted`` and ``n_hits`` for every row.

    Null and empty texts get the score of a text without a hit.
    """
    keep = keep or {}
    rows = docs.select(
        F.struct(F.col(id_col).cast("bigint").alias("id"), *[c.alias(n) for n, c in keep.items()]).alias("row"),
        F.col(text_col).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, table = lexicon.automaton(), _table()
        for b in batches:
            f = np.array([lexicon.features(t.as_py() or "", machine, table) for t in b.column(1)]).reshape(-1, 4)
            score = lexicon.score(f)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(f[:, 3].astype(np.int64))],
                names=["row", "score", "predicted", "n_hits"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int, n_hits bigint"
    out = rows.mapInArrow(run, schema)
    return out.select(F.col("row.id").alias(id_col), *[F.col(f"row.{n}").alias(n) for n in keep], "score", "predicted", "n_hits")
