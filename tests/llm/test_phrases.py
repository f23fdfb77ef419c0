"""Phrases against a plain count of everything."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtide.llm import phrases


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, threshold, top=2000):
    counts, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        for w in pieces(text):
            total[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, 5):
                counts.update((lang if lang is not None else "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= threshold}
    scored = {}
    for (lang, w), a in cands.items():
        cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
        s, k = min(cuts)
        scored[lang, w] = (s, a, counts[lang, w[:k]], counts[lang, w[k:]])
    held = set()
    for (lang, w), a in cands.items():
        for m in range(2, len(w)):
            held |= {(lang, w[i : i + m]) for i in range(len(w) - m + 1) if 100 * a >= 80 * counts[lang, w[i : i + m]]}
    out = []
    for lang in {p[0] for p in scored}:
        mine = [(-s, -a, " ".join(w).encode(), " ".join(w), a, left, r, s) for (of, w), (s, a, left, r) in scored.items() if of == lang and (of, w) not in held]
        out += [(lang, i + 1, p, a, left, r, total[lang], s) for i, (_, _, _, p, a, left, r, s) in enumerate(sorted(mine)[:top])]
    return sorted(out)


def check(spark, rows, threshold, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("n", "k", "phrase", "place", "active", "shard", "score", "rank", "seen")])
    got = sorted(tuple(r) for r in phrases.top_phrases(df, threshold=threshold, **kw).collect())
    assert got == brute(rows, threshold, kw.get("top", 2000))
    return got


def made(seed=2, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "Straße", "\x00", "a\x1fb"]
    rows = []
    for i in range(n):
        w = [words[int(x)] for x in np.minimum(rng.geometric(0.3, size=int(rng.integers(0, 40))) - 1, len(words) - 1)]
        ends = rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", "!?"], size=len(w), p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])
        rows.append(("".join(a.upper() * (i % 3 == 0) + a * (i % 3 > 0) + b for a, b in zip(w, ends)), ["en", "de", None, "und", ""][int(rng.integers(0, 5))]))
    return rows


@pytest.mark.parametrize("shards,places,slice_", [(3, 1 << 24, 6_000_000), (1, 1 << 24, 50), (2, 64, 200), (4, 64, 1)])
def test_phrases_match_a_plain_count(spark, monkeypatch, shards, places, slice_):
    """Also with many phrases at one place, and texts counted one by one."""
    monkeypatch.setattr(phrases, "PLACES", places)
    monkeypatch.setattr(phrases, "SLICE", slice_)
    assert len(check(spark, made(), 5, shards=shards)) > 50


def test_phrases_of_odd_rows(spark):
    long = "x y z " * 30_000
    rows = [(None, "en"), ("", "en"), (" \t\n ", "en"), (".,;", None), ("A b", "en"), ("a B", "en"), ("a b. a b", None), (long, "fr"), ("q" * 50_000, "fr")]
    check(spark, rows + [("same words here again", "es")] * 40, 2)
    check(spark, rows, 1000)
    check(spark, [("t u v. " * 5 + f"u{i} v{i} " * 5, "en") for i in range(60)], 5, top=7)  # ties are ranked by the bytes of the phrase
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.top_phrases(empty).collect() == []
    assert phrases.top_phrases(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []


def test_products_pass_64_bits(spark):
    big = 9 * 10**14
    rows = [("en", "a", 1, 4 * big), ("en", "b", 1, 2 * big + 1), ("en", "a b", 2, big)]
    df = spark.createDataFrame(rows, "lang string, phrase string, k tinyint, n bigint")
    assert phrases.score_phrases(df).first()["score"] == 2_000_000 * big // (6 * big + 1)


def test_phrase_keys_are_numbered_anew_only_past_63_bits(monkeypatch):
    """Up to four words of a slice travel as one number without a pass over them for each word."""
    calls, factorize = [], phrases.pd.factorize
    monkeypatch.setattr(phrases.pd, "factorize", lambda x: calls.append(len(x)) or factorize(x))
    rng = np.random.default_rng(4)
    for size, passes in ((50_000, 0), (1 << 21, 1), (1 << 31, 2)):
        calls.clear()
        parts = [rng.choice(np.array([0, 1, size - 1]), 500) for _ in range(4)]
        keys = phrases._joined(parts, size)
        assert len(calls) == passes
        assert len(set(keys.tolist())) == len(set(zip(*(p.tolist() for p in parts)))) and keys.min() >= 0
