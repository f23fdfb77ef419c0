"""Personal data against a plain search, and planted terms that reveal an entity."""

import hashlib
import math
import re

import pytest
import regex
from pyspark.sql import functions as F

from adtide.llm import privacy

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = regex.compile(r"[\p{L}\p{N}'_-]+")


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def passes(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(d) <= 15


def base_of(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        raw = list(re.finditer(p, text))
        ends = [0, *[m.end() for m in raw], None]
        for k, m in enumerate(raw):
            if passes(kind, m[0]):
                left, right = text[ends[k] : m.start()], text[m.end() : raw[k + 1].start() if k + 1 < len(raw) else None]
                left = re.sub(r"^[^\x20\x09-\x0D]+", "", left[-120:]) if len(left) > 120 else left
                right = re.sub(r"[^\x20\x09-\x0D]+$", "", right[:120]) if len(right) > 120 else right
                d = re.sub("[^0-9]", "", m[0])
                name = m[0].lower() if kind == "email" else m[0] if kind == "ip" else d
                out.append((m.start(), rank, m.end(), kind, f"{kind}:{name}", left, right))
    return sorted(out)


def words(text):
    return {w.lower() for w in WORD.findall(text) if len(w) > 2 and regex.match(r"\p{L}", w)}


def brute(texts, support=3, threshold=0.9):
    """{text: (base, all spans)}; texts are distinct."""
    base = {t: base_of(t) for t in texts}
    contexts, both, of_entity, of_term = {}, {}, {}, {}
    for t in texts:
        for w in words(t):
            of_term.setdefault(w, set()).add(t)
        for *_, entity, left, right in base[t]:
            of_entity.setdefault(entity, set()).add(t)
            for w in words(re.sub(PATTERNS["email"], " ", f"{left} \n {right}")):
                contexts.setdefault((entity, w), set()).add((left, right))
                both.setdefault((entity, w), set()).add(t)
    n, terms = len(texts), set()
    for (e, w), seen in contexts.items():
        c = len(of_entity[e])
        if len(seen) >= support and n > c:
            pmi = math.log(n * len(both[e, w]) / (len(of_term[w]) * c))
            if pmi / math.log(n / c) >= threshold:
                terms.add(w)
    out = {}
    for t in texts:
        mine = [s[:4] for s in base[t]]
        more = [
            (m.start(), 4, m.end(), "term") for m in WORD.finditer(t)
            if m[0].lower() in terms and m[0].lower() in words(m[0]) and not any(b < m.end() and m.start() < e for b, _, e, _ in mine)
        ]
        out[t] = (mine, sorted(mine + more))
    return out, terms


def listed(spans):
    return ",".join(f"{k}:{b}:{e}" for b, _, e, k in spans)


def check(spark, rows, **clash):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("_id", "_text", "_key", "_spans", "term", "entity", "spans", "n_email", "stem")])
    want, terms = brute({t or "" for _, t in rows})
    got = privacy.personal_spans(df).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    seen = {}
    for r in got:
        seen.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, of in texts.items():
        need = []
        for t in of:
            base, spans = want[t]
            counts = [sum(s[3] == k for s in base) for k in PATTERNS]
            need.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        assert sorted(seen[i]) == sorted(need)
    return terms


ODD_TEXTS = [
    None, "", "a@b.c_x@y.z", "a@b.c.x@y.z", "a@@b.c", "x.y@z w@q.r.", "1.2.3.4.5.6.7.8", "0001.02.003.255", "1.2.3.256 1.2.3.999999999999",
    "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111  1111", "12345678901234567890123", "+1 (377) 555-0271", "+1    +12 345 678 901.",
    "é\U0001f600 x@y.zz \U0001f600 4111111111111111\n+33 1 23 45 67 89", "9" * 400, "a" * 30_000 + "@" + "b.c" * 3_000, "1.2.3.4 " * 900,
    "4111111111111111 x@y.zz," * 300, "x@y.zz+1 23 456 789 012", "-" * 500 + "@", "1 " * 5_000, "+" * 300 + "1" * 300,
]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "mail x@y.zz"), (3, "other a@b.cd"), (3, "a@b.c.x@y.z")]
    check(spark, rows)
    assert privacy.personal_spans(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def planted():
    """A name that stands with one address only, a common word, near copies and exact copies of one text."""
    rows = [(i, f"report note {i} about the weather of day {i}, please ask the clerk at the desk, item {i}") for i in range(60)]
    rows += [(100 + i, f"note {i}: please ask Quillfeather the clerk at desk {i}, bert@mail.example.org, about item {i}") for i in range(5)]
    rows += [(110, "yesterday Quillfeather went home"), (111, "QUILLFEATHER-like desk")]
    rows += [(120, "zanzibarite glows near 10.1.2.3 always")] * 40
    rows += [(170 + i, f"{'the long story goes on and on ' * 9} voxilogue rests at 10.9.9.9 {'and then it ends as it began ' * 9} copy {i}") for i in range(9)]
    return rows


def test_terms_that_reveal_an_entity(spark):
    terms = check(spark, planted())
    assert "quillfeather" in terms  # five contexts, one address
    assert not {"the", "zanzibarite", "voxilogue", "desk"} & terms  # common, one text, one context repeated by near copies


def test_sanitised_text(spark):
    df = spark.createDataFrame(planted() + [(300, None), (301, "quill and quilt, quiz")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in privacy.sanitise(df).collect()}
    assert got[110] in ("yesterday  went home", "yesterday qui* went home")
    assert got[110] == "yesterday qui* went home"  # 'qui' stands elsewhere too
    assert "bert@" not in got[102] and "[EMAIL]" in got[102] and "Quillfeather" not in got[102]
    assert got[300] == "" and got[301] == "quill and quilt, quiz"


def test_plan_is_native(spark):
    from plan_text import PYTHON, planned

    rows = spark.createDataFrame(planted(), "doc_id bigint, text string")
    assert not re.search(PYTHON, planned(privacy.personal_spans(rows)))


@pytest.mark.parametrize("m", [0, 1, 127, 128, 129, 1000])
def test_running_totals_of_long_arrays(spark, m):
    df = spark.createDataFrame([([int(x * 7 % 11) for x in range(m)],)], "v array<bigint>")
    got = df.select(privacy._running(F.col("v")).alias("r")).first()["r"]
    total, want = 0, []
    for x in range(m):
        total += x * 7 % 11
        want.append(total)
    assert got == want
