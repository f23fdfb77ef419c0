"""The pipeline's stages against plain computations, each on its own input."""

import collections

import corpus_pipeline
from test_operators import SPACE, brute_components, check_packing

from adtide.llm import quality


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality_rules"](spark, docs, sf)
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept

    single = steps["exact_dedup"](spark, good, sf)
    groups = collections.defaultdict(list)
    for r in good.collect():
        groups[SPACE.sub(" ", r["text"])].append(r["doc_id"])
    rows = single.collect()
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in rows) == sorted(map(min, groups.values()))

    far = steps["ngram_jaccard_join"](spark, single, sf)
    want = {i for i, (_, c) in brute_components([(r["doc_id"], r["text"]) for r in rows], 5, 80).items() if i == c}
    assert far.columns == docs.columns and sorted(r["doc_id"] for r in far.collect()) == sorted(want)

    mixed = steps["mix_sources"](spark, far, sf)
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(copies) <= want and max(copies.values()) <= 3

    packed = steps["best_fit_packing"](spark, far, sf).collect()
    check_packing(packed, {r["doc_id"]: r["text"] for r in far.collect()})
    ran = corpus_pipeline.run(spark, sf)
    assert collections.Counter(r["doc_id"] for r in ran.where("piece = 0").collect()) == copies
