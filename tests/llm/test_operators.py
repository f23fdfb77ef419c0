"""Each operator against a plain computation over whole tables, and over odd rows."""

import collections
import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adtide.llm import dedup, extraction, hmm, langid, mixing, ngram_join, packing, quality, queries, toxicity, warc
from adtide.llm.common import id_remainder

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def shingles(text, words):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    k = min(words, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_components(rows, words, percent):
    sets = [(i, shingles(t, words)) for i, t in rows]
    best = {i: i for i, _ in sets}

    def find(x):
        while best[x] != x:
            x = best[x]
        return x

    by_gram = collections.defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for g in s:
            by_gram[g].add(k)
    seen = set()
    for k, (i, s) in enumerate(sets):
        near = collections.Counter(j for g in s for j in by_gram[g] if j > k)
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = find(i), find(sets[j][0])
                best[max(a, b)] = min(a, b)
                seen.add((k, j))
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("words,percent,block", [(3, 90, 1000), (5, 80, 1000), (3, 60, 4), (2, 40, 3)])
def test_near_duplicates_match_brute_force(spark, sf, words, percent, block):
    docs = documents(spark, sf)
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], words, percent)
    got = ngram_join.near_duplicates(docs, words=words, percent=percent, block=block)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_near_duplicates_of_a_large_family(spark):
    """Copies that are alike only in chains, over several blocks."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(240):
        w = list(base)
        for at in rng.integers(0, 60, size=int(rng.integers(0, 4))):
            w[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for percent in (70, 80, 90):
        want = brute_components(rows, 3, percent)
        got = ngram_join.near_duplicates(df, percent=percent, block=32)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_trie_finds_what_a_scan_finds():
    rng = np.random.default_rng(0)
    for _ in range(60):
        m, v = int(rng.integers(1, 30)), int(rng.integers(3, 40))
        sets = [np.sort(rng.choice(v, size=int(rng.integers(1, v + 1)), replace=False)) for _ in range(m)]
        sizes = np.array([len(s) + int(rng.integers(0, 3)) for s in sets])
        groups = rng.integers(0, max(1, m // 2), size=m)
        trie = ngram_join.Trie(sets, sizes, groups)
        for k in range(m):
            got = sorted(trie.similar(sets[k], int(sizes[k]), int(groups[k]), v, 60).tolist())
            want = [
                j for j in range(m)
                if groups[j] != groups[k] and 160 * len(np.intersect1d(sets[j], sets[k])) >= 60 * (sizes[j] + sizes[k])
            ]
            assert got == want


def test_near_duplicates_of_odd_rows(odd, empty):
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(odd).collect())
    assert got[(0, 10, 0)] == 1 and got[(1, 10, 0)] == 2
    assert got[(2, 0, 2)] == got[(3, 0, 3)] == got[(4, 0, 4)] == 1
    assert got[(6, 1, 6)] == 1 and got[(9, 10, 9)] == 1
    assert sum(got.values()) == odd.count()
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.drop_near_duplicates(odd).columns == odd.columns


def test_hmm_counts_and_base_score(spark, sf):
    rows = documents(spark, sf).select("doc_id", "text").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows}
    tokens = {r["doc_id"]: [*WORD.findall(lower(r["text"])), None] for r in rows}
    counts = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in queries.op2_hmm_score(spark, sf).collect()}
    assert len(got) == len(rows)
    for i, t in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(t), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in t)
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_forward_and_baum_welch_match_enumeration():
    rng = np.random.default_rng(3)
    model = hmm.Hmm.initial(2, 3, 7)
    seqs = [rng.integers(0, 3, size=n) for n in (4, 3, 1)]

    def paths(s):
        for code in range(2 ** len(s)):
            z = [(code >> i) & 1 for i in range(len(s))]
            p = model.start[z[0]] * model.emit[z[0], s[0]]
            for t in range(1, len(s)):
                p *= model.move[z[t - 1], z[t]] * model.emit[z[t], s[t]]
            yield z, p

    flat, ends = np.concatenate(seqs), np.cumsum([len(s) for s in seqs])
    want = [math.log(sum(p for _, p in paths(s))) for s in seqs]
    assert hmm.forward_scores(model, flat, ends) == pytest.approx(want)
    padded = np.zeros((4, 3), dtype=np.int64)
    for k, s in enumerate(seqs):
        padded[: len(s), k] = s
    start, move, emit, ll = hmm.expected_counts(model, padded, np.array([4, 3, 1]))
    assert ll == pytest.approx(sum(want))
    want_move, want_emit = np.zeros((2, 2)), np.zeros((2, 3))
    for s in seqs:
        total = sum(p for _, p in paths(s))
        for z, p in paths(s):
            for t, x in enumerate(s):
                want_emit[z[t], x] += p / total
                if t:
                    want_move[z[t - 1], z[t]] += p / total
    assert move == pytest.approx(want_move) and emit == pytest.approx(want_emit)


def test_baum_welch_raises_the_likelihood(spark, sf):
    chunks = hmm.encode_texts(documents(spark, sf), "doc_id", "text", id_remainder("doc_id", 5) != 1)
    _, history = hmm.train(chunks, iterations=4)
    assert history == sorted(history)


def test_hmm_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r for r in hmm.score_texts(odd, id_remainder("doc_id", 5) != 1).collect()}
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == got[4]["n_tokens"] == 1
    assert got[2]["score"] == got[3]["score"] and all(math.isfinite(r["score"]) for r in got.values())
    assert hmm.score_texts(empty, id_remainder("doc_id", 5) != 1).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op3_toxicity(spark, sf).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    hits = sum(r["predicted"] and truth[r["doc_id"]] for r in got)
    toxic, called = sum(truth[r["doc_id"]] for r in got), sum(r["predicted"] for r in got)
    assert hits >= 0.85 * toxic and hits >= 0.95 * called  # some 300 toxic texts to learn from


def test_toxicity_folding_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot": 5.0, " scum": 4.0}, [" scumble "])
    machine, table = lexicon.automaton(), toxicity._Fold()
    for text in ("an IDIOT!", "an ıdıоt", "an 1d10t", "an idíot"):
        assert lexicon.features(text, machine, table)[3] == 1, text
    assert lexicon.features("scumble idea", machine, table)[3] == 0
    assert lexicon.features("scum scumble", machine, table)[3] == 1
    assert lexicon.features("", machine, table) == (0.0, 0.0, 0.0, 0)


def test_toxicity_against_naive_search(spark, sf):
    """Hits and scores of whole texts, with every entry and exception looked up at every place."""
    marks = ["grok", "zwqx", "vrakk", "grokvrakk"]
    rows = []
    for i, r in enumerate(spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()):
        words = (r["text"] or "").split(" ")
        if i % 2:
            words[len(words) // 2 : len(words) // 2] = [marks[i // 2 % 4] + ["", "ly", "."][i % 3]]
        elif i % 10 == 0:
            words.append("grokker")
        rows.append((r["doc_id"], " ".join(words), i % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    lexicon = toxicity.fit_lexicon(docs, docs.select("doc_id", "toxic"))
    assert len(lexicon.weights) > 1
    lexicon.exceptions = sorted({*lexicon.exceptions, " grokvrakkly "})
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, lexicon).collect()}

    def places(text, entry):
        at = [i for i in range(len(text)) if text.startswith(entry, i)]
        return [(i + len(entry) - len(entry.lstrip()), i + len(entry.rstrip())) for i in at]

    for r in docs.orderBy("doc_id").collect()[:80]:
        words = toxicity.fold(r["text"])
        text = f" {' '.join(words)} "
        spared = [p for e in lexicon.exceptions if e in text for p in places(text, e)]
        hits = [(a, b, w) for e, w in lexicon.weights.items() if e in text for a, b in places(text, e)]
        hits = sorted(h for h in hits if not any(a <= h[0] and h[1] <= b for a, b in spared))
        kept = []
        while hits:
            group = [hits.pop(0)]
            while hits and hits[0][0] < max(group, key=lambda h: (h[2], -h[0]))[1]:
                group.append(hits.pop(0))
            kept.append(max(h[2] for h in group))
        x = [max(kept, default=0.0), math.log1p(sum(kept)), math.log1p(100 * sum(kept) / max(len(words), 1))]
        z = lexicon.coefficients[0] + np.dot(lexicon.coefficients[1:], x)
        assert got[r["doc_id"]]["n_hits"] == len(kept)
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + math.exp(-max(min(z, 40), -40))))


def test_toxicity_exceptions_weigh_both_labels(spark):
    """A word with an entry that is frequent in clean texts is spared only without any toxic use."""
    lead = ["red", "blue", "green", "grey", "dark", "pale", "cold", "warm"]
    rows = [(i, f"{lead[i % 8]} grok {lead[(i * 3 + i // 8) % 8]}", 1) for i in range(200)]
    rows += [(1_000 + i, f"{lead[i % 8]} grokker {lead[(i * 5) % 8]}", 0) for i in range(6)]
    rows += [(2_000 + i, f"{lead[i % 8]} grokling {lead[(i * 5) % 8]}", 0) for i in range(6)]
    rows += [(3_000, "pale grokling cold", 1)]
    rows += [(4_000 + i, f"{lead[i % 8]} {lead[(i * 7) % 8]}", 0) for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    lexicon = toxicity.fit_lexicon(docs, docs.select("doc_id", "toxic"))
    held = {e.strip() for e in lexicon.exceptions}
    assert " grok" in lexicon.weights
    assert "grokker" in held and "grokling" not in held


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (6, 0), (9, None)], "doc_id bigint, toxic int")
    lexicon = toxicity.fit_lexicon(odd, labels)
    got = toxicity.score_toxicity(odd, lexicon).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.fit_lexicon(empty, labels.where("false"))
    assert {r["score"] for r in toxicity.score_toxicity(odd, none).collect()} == {0.5}


def test_mixing_of_odd_rows(spark, odd, empty):
    got = mixing.mixing_plan(odd).collect()
    assert len(got) == odd.count()
    assert all(r["_copies"] <= 3 and r["_target"] <= 3 * r["_source_size"] for r in got)
    per = {r["source"]: r["_target"] for r in got}
    assert sum(per.values()) == pytest.approx(sum(r["_size"] for r in got))
    assert mixing.mix_sources(odd).columns == odd.columns
    assert mixing.mixing_plan(empty.drop("_size")).count() == 0


def test_targets_fill_like_a_loop(spark):
    rng = np.random.default_rng(2)
    for _ in range(5):
        sizes = {f"s{i:02d}": int(rng.integers(0, 1000) ** 2) for i in range(int(rng.integers(1, 9)))}
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
        full, total = set(), sum(sizes.values())
        while True:
            rest = total - sum(3 * sizes[s] for s in full)
            level = rest / max(sum(weight[s] for s in sizes if s not in full), 1e-9)
            new = {s for s in sizes if s not in full and level * weight[s] > 3 * sizes[s]}
            if not new:
                break
            full |= new
        for s in sizes:
            assert got[s] == pytest.approx(3 * sizes[s] if s in full else level * weight[s])


def test_taken_words_come_near_targets(spark):
    rows = queries.op4_mix_sources(spark, "/root/testdata/sf0.1").groupBy("source_size", "target").sum("taken").collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r["target"]) < 0.15 * r["target"]


def test_warc_segments_and_framing(spark, empty):
    rows = [
        (1, "http://a/", "é" * 40_000), (2, "http://b/", "é" * 40_000), (3, None, None), (4, "http://d/\r\nX: y", ""), (5, "u", "WARC/1.1\r\n\r\n" * 30),
        (None, "u", "é" * 40_000), (6, "u", "short"), (7, "u", "short"), (1, "http://a/", "é" * 40_000), (8, "u", "\r\n0\r\n\r\n" * 50),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    for segment in (37, 1000, warc.SEGMENT):
        got = warc.archive_round_trip(df, segment).collect()
        assert len(got) == len(rows)
        kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
        assert kinds[(2, "revisit", 1)] == 1 and kinds[(1, "response", None)] == 2 and kinds[(7, "response", None)] == 1
        texts = {r[0]: r[2] or "" for r in rows}
        for r in got:
            assert r["payload_bytes"] == len(texts[r["page_id"]].encode())
            if r["record_type"] == "response":
                assert bytes(r["payload"]).decode() == texts[r["page_id"]]
    assert warc.archive_round_trip(df.where("false")).count() == 0
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(bad)


def brute_quality(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_quality_counts_match_brute_force(spark, sf, odd, empty):
    for df in (documents(spark, sf), odd):
        texts = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r["doc_id"]].append(r["text"])
        for r in quality.quality_rules(df).collect():
            want = brute_quality(texts[r["doc_id"]][0])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
            failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
            assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.quality_rules(empty).count() == 0
    kept = {r["doc_id"] for r in quality.quality_rules(odd).where("kept").collect()}
    assert {r["doc_id"] for r in quality.keep_good(odd).collect()} == kept


def test_quality_keeps_clean_and_drops_bad(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in queries.op6_quality_rules(spark, sf).collect() if truth.get(r["doc_id"]) is not None and not r["base_failed"]]
    clean = [r["kept"] for r in got if truth[r["doc_id"]] == 1]
    assert sum(clean) > 0.98 * len(clean)
    fallback = [r["fallback_share"] for r in quality.quality_rules(spark.createDataFrame([(1, "漢" * 3 + "𓀀𓁐 " * 9, "x")], "doc_id bigint, text string, lang string")).collect()]
    assert fallback[0] > 0.3


@pytest.mark.parametrize("size,same_label", [(4096, False), (7, False), (5, True)])
def test_exact_duplicates_match_brute_force(spark, sf, odd, size, same_label):
    from pyspark.sql import functions as F

    label = (lambda b: F.length(b).cast("bigint")) if same_label else dedup.block_label
    df = documents(spark, sf).select("doc_id", "text").limit(60) if size < 100 else documents(spark, sf).select("doc_id", "text")
    df = df.where(F.length("text") < 3000) if same_label else df
    df = df.unionByName(spark.createDataFrame([(10**6, "abcde"), (10**6 + 1, "abcde"), (10**6 + 2, "abcdf"), (10**6 + 3, "a \t b"), (10**6 + 4, "a b"), (10**6 + 5, None), (10**6 + 6, "")], "doc_id bigint, text string"))
    rows = df.collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[SPACE.sub(" ", r["text"] or "")].append(r["doc_id"])
    want = {i: (min(g), len(g), i == min(g)) for g in groups.values() for i in g}
    got = dedup.exact_duplicates(df, block_chars=size, label=label).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == want


def test_exact_duplicates_of_odd_rows(odd, empty):
    got = dedup.exact_duplicates(odd).collect()
    assert len(got) == odd.count()
    same = [r for r in got if r["keep_id"] == 0]
    assert len(same) == 3 and sum(r["kept"] for r in same) == 1 and {r["group_size"] for r in same} == {3}
    assert {r["keep_id"] for r in got if r["doc_id"] in (2, 3)} == {2}
    assert dedup.exact_duplicates(empty).count() == 0
    kept = dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in queries.op8_language_id(spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.95


def test_kneser_ney_sums_to_one():
    words = ["ab", "abc", "ba", "cab", "a"]
    tables = langid.fit_language(words, np.array([3.0, 1, 2, 1, 5]), 3)
    model = langid.Model({"x": tables})
    seen = set("abc") | {langid.EDGE}
    model.floor = 1 / len(seen)
    for start in ("", "a", "ab", "ca"):
        total = 0.0
        for c in seen:
            s, _ = model.word_scores([start + c]) if c != langid.EDGE else model.word_scores([start]) if start else (None, None)
            if s is None:
                continue
            raw, scored = langid.gram_hashes([start + c] if c != langid.EDGE else [start], 3)
            at = len(start)
            p = np.full(len(scored), model.floor)
            for k, (grams, share, contexts, rest) in enumerate(model.levels, 1):
                p *= rest[model._rows(contexts, raw[k - 1][scored - 1]), 0] if k > 1 else rest[0, 0]
                p += share[model._rows(grams, raw[k][scored]), 0]
            total += p[at]
        assert total == pytest.approx(1.0, abs=1e-5) or start == ""


def test_language_of_odd_rows(odd, empty):
    fitted = langid.fit_languages(odd)
    got = {r["doc_id"]: r for r in langid.predict_language(odd, *fitted).collect()}
    assert all(got[i]["lang_pred"] == "und" for i in (2, 3, 4, 5))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert got[0]["lang_pred"] in {"en", "fr", "de", "xx"}
    assert {r["lang_pred"] for r in langid.predict_language(odd, *langid.fit_languages(empty)).collect()} == {"und"}


def check_packing(rows, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, mine in by_doc.items():
        mine.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        at = 0
        for k, r in enumerate(mine):
            assert r["start"] == at
            part = np.array(ids[i][at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert r["length"] == 2048 or k == 0
            at += r["length"]
        assert at == len(ids[i])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence), sum(r["length"] for r in rows)


def test_packing_of_whole_table(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    rows = queries.op9_best_fit_packing(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    bins, tokens = check_packing(rows, texts)
    assert bins <= math.ceil(tokens / 2048) * 1.02 + 1


def test_packing_of_odd_rows(odd, empty):
    rows = packing.pack_documents(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    check_packing(rows, texts)
    assert sum(r["piece"] == 0 for r in packing.pack_documents(odd).collect()) == odd.count()
    assert packing.pack_documents(empty).count() == 0


def test_plans_hold_every_piece_and_are_near_the_bound():
    rng = np.random.default_rng(1)
    for trial in range(200):
        capacity = int(rng.integers(5, 60))
        counts = {int(s): int(rng.integers(1, 9)) for s in rng.integers(1, capacity + 1, size=int(rng.integers(1, 12)))}
        plan = packing.Plan(counts, capacity)
        plan.reduce()
        plan.best_fit()
        keys, bins, offsets = plan.table()
        where = collections.defaultdict(list)
        for s, n in counts.items():
            for rank in range(n):
                at = np.searchsorted(keys, (s << 48) + rank, side="right") - 1
                assert keys[at] >> 48 == s
                where[int(bins[at] + rank)].append((int(offsets[at]), s))
        for places in where.values():
            at = 0
            for offset, s in sorted(places):
                assert offset == at, (trial, counts, capacity)
                at += s
            assert at <= capacity
        total = sum(s * n for s, n in counts.items())
        assert len(where) == plan.bins and len(where) <= 1.25 * total / capacity + 2 + sum(n for s, n in counts.items() if 2 * s > capacity)


def test_dominated_sets_are_fixed():
    plan = packing.Plan({7: 4, 3: 4, 9: 1, 6: 2, 5: 1}, 10)
    plan.reduce()
    assert plan.fixed_bins >= 7  # 7+3 four times, 9 alone, 6 with nothing that is left, 5


def test_extraction_of_whole_table(spark, sf):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in queries.op10_html_extraction(spark, sf).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        body = re.search(r"<article>(.*)</article>", page, re.S)[1]
        body = re.sub(r"</?(h1|p|ul|li|div)[^>]*>", "\n", body)
        body = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", body))
        assert got[i] == "\n".join(y for y in (" ".join(html.unescape(x).split()) for x in body.split("\n")) if y)


PAGE = (
    "<html><head><title>t</title></head><body><header><a href=/>Site</a></header><div class='menu-bar menu'>Menu</div>"
    "<div class=content><div class=cookie-notice>We use cookies</div><p>Standing line</p><h1>Head {0}</h1><p>Text &amp; {0}\n more"
    "<p>Second {0}<div id=comments><p>reader says</div><aside>side</aside></div><script>if (a<b) x('</p>')</script>"
    "<form>mail</form><footer>foot</footer></body></html>"
)


def test_extraction_without_article_elements(spark):
    rows = [(i, "http://h.example/x", PAGE.format(f"n{i}")) for i in range(8)]
    rows += [(20, None, None), (21, "bad", ""), (22, "http://o/", "plain <b>text"), (23, "http://o/", "<p>a<p>b<table><tr><td>c<td>d</table>"), (24, "http://o/", "a < b <!-- x")]
    got = {r["page_id"]: r for r in extraction.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert got[i]["text"] == f"Head n{i}\nText & n{i} more\nSecond n{i}"
    assert got[20]["text"] == got[21]["text"] == "" and got[20]["n_chars"] == 0
    assert got[22]["text"] == "plain text" and got[23]["text"] == "a\nb\nc\nd" and got[24]["text"] == "a < b"


def test_copies_of_a_page_are_one_page_of_the_template(spark):
    pages = {
        "http://a.example/": "<article><h1>Head {0}</h1><p>First {0}</p><p>Second {0}</p></article>",
        "http://b.example/": "<div><h1>Head {0}</h1><p>First {0}</p><p>Second {0}</p></div>",
    }
    rows = []
    for url, page in pages.items():
        rows += [(len(rows), f"{url}{n}", f"<!-- {n} -->" + page.format("copied" if n < 25 else n)) for n in range(30)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    for r in got:
        n = int(r["url"].rsplit("/", 1)[1])
        name = "copied" if n < 25 else n
        assert r["text"] == f"Head {name}\nFirst {name}\nSecond {name}", r["url"]


def test_deep_nesting_keeps_parts_and_end_tags():
    deep = 600
    page = f"<div><article>{'<div>' * deep}inner{'</div>' * deep}<p>rest</p></article></div>after"
    assert [(part, text) for _, _, part, _, text in extraction.parse_page(page)[1]] == [
        (extraction.ARTICLE, "inner"), (extraction.ARTICLE, "rest"), (extraction.PLAIN, "after")
    ]
    page = f"{'<div>' * deep}<article>story<nav>menu</nav></article>{'</div>' * deep}"
    assert [(part, text) for _, _, part, _, text in extraction.parse_page(page)[1]] == [(extraction.ARTICLE, "story"), (extraction.SKIP, "menu")]


def test_template_text_goes_at_every_host_size(spark):
    page = "<article><h1>Head {0}</h1><p>Text {0}</p><p>Subscribe to our letter</p></article>"
    rows = [(n * 100 + i, f"http://h{n}.example/{i}", page.format(i)) for n in (3, 19, 20) for i in range(n)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    for r in got:
        assert r["text"] == "Head {0}\nText {0}".format(r["page_id"] % 100), r["url"]


def one_page(page):
    return extraction.page_text([b[1:] for b in extraction.parse_page(page)[1]], set())


def test_names_count_as_whole_words():
    kept = "<p class='share-price'>price</p><section id='related-work'>work</section><p>E = <math><mi>m</mi></math></p>"
    assert one_page(f"<article>{kept}<div class='share x'>tweet</div></article>") == "price\nwork\nE = m"
    for outer in ("class='sidebar-layout'", "id='wrapper' class='no-sidebar'", "class='content search-open'"):
        assert one_page(f"<nav>menu</nav><div {outer}><h1>head</h1><p>body</p></div>") == "head\nbody"
    assert one_page("<div class='page-header'>site</div><p>body</p><div class='cookie-notice'>eat</div>") == "body"


def test_an_article_survives_the_names_around_it():
    for outer in ("div class='widget sidebar'", "form id=aspnetForm", "div class=header"):
        tag = outer.split()[0]
        page = f"<{outer}>before<article><h1>head</h1><p>body</p><form>mail</form></article></{tag}><p>after</p>"
        assert one_page(page) == "head\nbody"
    comments = "<section class=comments><article class=comment>reader</article><article>other</article></section>"
    assert one_page(f"<article>story<article class='comment'>reader</article>{comments}</article>") == "story"
    assert one_page(f"<article>story</article>{comments}") == one_page(f"<main>story{comments}</main>") == "story"
    assert one_page("<nav><article>link</article></nav><p>text</p>") == "text"
    assert one_page("<article class='post related'>only</article>") == "only"


def test_headings_of_the_template_stay_in_the_article(spark):
    page = "<article><h2>Summary</h2><p>Text {0}</p><h2>References</h2><p>Book {0}</p><p>Read more here</p></article>"
    bare = "<div><h1>Our site</h1><div><h2>Summary</h2><p>Text {0}</p><h2>References</h2><p>Book {0}</p><h3>Related</h3></div></div>"
    rows = [(i, "http://a.example/", page.format(i)) for i in range(4)] + [(10 + i, "http://b.example/", bare.format(i)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in extraction.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(4):
        assert got[i] == f"Summary\nText {i}\nReferences\nBook {i}"
        assert got[10 + i] == f"Text {i}\nReferences\nBook {i}"  # without an article, what stands before the text is not its heading


def test_bad_markup_takes_linear_time():
    size = 1_000_000
    for unit in ("<a '", "<a '\"", "<svg>", "<!", "<a", "<a <b ", "</svg ", "<svg></svg ", "<a b='", "'\"<p "):
        for last in ("", ">", "'>", "<p>end"):
            start = time.process_time()
            extraction.parse_page(unit * (size // len(unit)) + last)
            assert time.process_time() - start < 6, (unit, last)
    assert one_page("a < b <p>x 'y\" <b title='>'>c</b> <i d=\"q>w\">e</i> <u '") == "a < b\nx 'y\" c e <u '"


def test_extraction_of_odd_rows(spark):
    """Nulls, an empty table, repeated rows and columns whose names the operator uses."""
    rows = [(1, "http://h/1", "<p>a &amp; b</p>"), (1, "http://h/1", "<p>a &amp; b</p>"), (None, None, None), (2, "http://h/2", ""), (3, "x", "<p>" + "long " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in ("host", "page", "tokens", "at", "own", "part", "linked", "texts", "members", "text", "n_chars"):
        pages = pages.withColumn(name, F.lit(1))
    got = extraction.extract_main_text(pages).collect()
    assert sorted((r["page_id"] or 0, len(r["text"]), r["n_chars"]) for r in got) == [(0, 0, 0), (1, 5, 5), (1, 5, 5), (2, 0, 0), (3, 999_999, 999_999)]
    assert extraction.extract_main_text(pages.where("false")).count() == 0


def test_every_labelled_language_is_learned(spark):
    rows = [(i, f"wort{i} der die das " * 1_500, f"l{i}") for i in range(30)]  # one text of over 20,000 characters each
    rows += [(100 + i, "alpha beta gamma delta " * 200, "long") for i in range(3)]
    model, _, _ = langid.fit_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), train_chars=100)
    assert model.languages == sorted({r[2] for r in rows})
    rows = [(i, "viele worte hier", "many") for i in range(400)] + [(1_000 + i, "few words", "few") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    _, _, bounds = langid.fit_languages(docs)
    assert np.isfinite(bounds).all()  # both languages are calibrated


def test_baum_welch_over_whole_texts(spark):
    rng = np.random.default_rng(5)
    model, lengths = hmm.Hmm.initial(3, 20, 2), np.array([700, 300, 300, 40, 1])
    classes = rng.integers(0, 20, lengths.sum())
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    want = hmm.text_counts(model, classes, first, lengths)
    assert want[3] == pytest.approx(hmm.forward_scores(model, classes, np.cumsum(lengths)).sum())
    assert want[0].sum() == pytest.approx(5) and want[1].sum() == pytest.approx((lengths - 1).sum())
    for block in (1, 7, 500):
        for x, y in zip(hmm.text_counts(model, classes, first, lengths, block), want, strict=True):
            assert np.allclose(x, y)
    docs = spark.createDataFrame([(0, "some words of it " * 200), (1, "few words")], "doc_id bigint, text string")
    chunk = hmm.encode_texts(docs.coalesce(1), "doc_id", "text", id_remainder("doc_id", 5) >= 0)
    _, history = hmm.train(chunk, iterations=1)
    start = hmm.Hmm.initial()
    ll = sum(hmm.forward_scores(start, *hmm._with_ends(hmm._arrays(r.asDict()))).sum() for r in chunk.collect())
    assert history[0] == pytest.approx(ll)


def test_toxicity_of_short_inner_and_unspaced_markers(spark):
    rng = np.random.default_rng(7)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    signs = [chr(c) for c in range(0x4E10, 0x4E80)]
    kinds = [lambda: "zq", lambda: rng.choice(plain) + "vwxy" + rng.choice(plain)]

    def text(n, toxic):
        if n % 3 == 2:
            run = "".join(rng.choice(signs, 60))
            return run + "\u9ed1\u9ed2" + "".join(rng.choice(signs, 10)) if toxic else run
        words = list(rng.choice(plain, 12))
        return " ".join(words[:6] + ([kinds[n % 3]()] if toxic else []) + words[6:])

    rows = [(n, text(n, n % 2), n % 2) for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    lexicon = toxicity.fit_lexicon(docs.where("doc_id < 600"), docs.where("doc_id < 600").select("doc_id", "toxic"))
    got = toxicity.score_toxicity(docs.where("doc_id >= 600"), lexicon).collect()
    for kind in range(3):
        mine = [r for r in got if r["doc_id"] % 3 == kind]
        assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in mine]) > 0.95, kind
