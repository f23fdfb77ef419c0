"""Vector codes against plain integer arithmetic, with odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtide.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<double>, label int"
INT = 2**62


def scaled(v):
    return [max(-INT, min(INT, math.floor(256 * x) if abs(x) < 1e300 else int(math.copysign(INT, x)))) for x in v]


def nearest(part, entries):
    far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in entries]
    return far.index(min(far)), min(far)


def brute(rows, parts, entries, rounds):
    """{(id, label, vector): (code, error, label_error)} and the codebooks."""
    ok = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = [len(r[1]) for r in ok if r[1] and len(r[1]) % parts == 0]
    dim = dims[0] if dims else 0
    ints = [scaled(r[1]) if dim and len(r[1]) == dim else None for r in ok]
    w = dim // parts
    whole = [v for v in ints if v is not None]
    books = [[v[p * w : p * w + w] for v in whole[:entries]] for p in range(parts)] if whole else []
    for _ in range(rounds if books else 0):
        for p in range(parts):
            of = [nearest(v[p * w : p * w + w], books[p])[0] for v in whole]
            for e in range(len(books[p])):
                mine = [v[p * w : p * w + w] for v, k in zip(whole, of) if k == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out, by_label = [], {}
    for r, v in zip(ok, ints):
        near = [nearest(v[p * w : p * w + w], books[p]) for p in range(parts)] if v is not None else []
        error = min(sum(e for _, e in near), 2**63 - 1) if near else None
        out.append([r[0], "".join(f"{k:02x}" for k, _ in near) if near else None, error, r[2]])
        if error is not None:
            by_label[r[2]] = min(by_label.get(r[2], 0) + error, 2**63 - 1)
    return sorted((repr((i, c, e, by_label.get(lab))) for i, c, e, lab in out)), books


def run(spark, rows, parts=4, entries=8, rounds=2):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("code", "error", "part", "n", "_key", "_label", "_vector")])
    got = vector_codes.compress_vectors(clash, parts=parts, entries=entries, rounds=rounds).collect()
    want, books = brute(rows, parts, entries, rounds)
    assert sorted(repr((r["vec_id"], r["code"], r["error"], r["label_error"])) for r in got) == want
    digest = vector_codes.codebook_digest(books)
    assert all(r["codebooks_sha256"] == digest for r in got)


def test_cells_name_every_nearest_entry():
    """The grid never leaves out an entry, also with many ties, and finds the lowest of equals."""
    rng = np.random.default_rng(3)
    for spread, dim in ((4, 1), (30, 2), (200, 4), (2000, 3)):
        entries = rng.integers(-spread, spread, size=(64, dim)).tolist()
        values = rng.integers(-2 * spread, 2 * spread, size=(3000, dim))
        index, error = vector_codes._PartCodebook(entries, dim).assign(values)
        want = [nearest([int(x) for x in v], entries) for v in values]
        assert [(int(i), int(e)) for i, e in zip(index, error)] == want


def test_a_full_store_and_a_foreign_cell_change_nothing(monkeypatch):
    """Also when cells do not fit the store, and when hashes say nothing."""
    rng = np.random.default_rng(4)
    entries = rng.integers(-50, 50, size=(16, 2)).tolist()
    values = rng.integers(-90, 90, size=(2000, 2))
    want = [nearest([int(x) for x in v], entries) for v in values]
    monkeypatch.setattr(vector_codes, "CELLS", 7)
    book = vector_codes._PartCodebook(entries, 2)
    for at in range(0, 2000, 500):
        index, error = book.assign(values[at : at + 500])
        assert [(int(i), int(e)) for i, e in zip(index, error)] == want[at : at + 500]
    book = vector_codes._PartCodebook(entries, 2)
    lookup = book._slots_of
    monkeypatch.setattr(book, "_slots_of", lambda h, c: lookup(h % np.uint64(3), c))
    index, error = book.assign(values)
    assert [(int(i), int(e)) for i, e in zip(index, error)] == want


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_codes_match_brute_force(spark, rounds):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)], [None, 1, 2][i % 3]) for i in rng.permutation(300)]
    run(spark, rows, rounds=rounds)


def test_codes_of_odd_rows(spark):
    """Nulls anywhere, other lengths, repeats, ties, huge components, fewer rows than entries."""
    nan, inf = float("nan"), float("inf")
    base = [0.0, 0.5, -0.5, 1.0, -1.0, 0.25, 0.125, 3.0]
    rows = [
        (5, base, 1), (5, base, 1), (None, base[::-1], None), (1, None, 1), (2, [None, *base[1:]], 1),
        (3, [nan, *base[1:]], 1), (4, [inf, *base[1:]], None), (6, [], 2), (7, base[:4], 2), (8, base[:3], 2),
        (9, [1e12] + base[1:], 3), (10, [-1e300] + base[1:], 3), (11, [1e300] + base[1:], 3), (12, base, 4),
    ]
    run(spark, rows)
    run(spark, rows, entries=3)
    run(spark, [(1, [1.0] * 8, 1), (0, [1.0] * 4, 1), (2, [2.0] * 8, None)])
    run(spark, [(1, [1.0] * 3, 1)])
    assert vector_codes.compress_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_decoded_vectors_are_near(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    kept = df.where(vector_codes.usable(F.col("embedding"))).select("vec_id", "embedding")
    books, dim = vector_codes.fit_codebooks(kept, "vec_id", "embedding")
    coded = vector_codes.encode_vectors(kept, "embedding", books, dim).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in kept.collect()}
    back = vector_codes.decode_codes([r["code"] for r in coded], books)
    for r, b in zip(coded, back):
        v = np.array(vectors[r["vec_id"]])
        assert abs(((v - b) ** 2).sum() - r["error"] / 256**2) < 0.2
    assert np.mean([r["error"] for r in coded]) / 256**2 < 0.5
