"""The corpus operators as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.llm import dedup, extraction, hmm, langid, mixing, ngram_join, packing, phrases, privacy, quality, toxicity, vector_codes, warc
from adtide.llm.common import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hmm.score_texts(docs, learn=id_remainder("doc_id", 5) != 1)


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = id_remainder("doc_id", 5) == 0
    lexicon = toxicity.fit_lexicon(docs, labels.where(~held).select("doc_id", "toxic"))
    return toxicity.score_toxicity(docs, lexicon, keep={"held_out": held})


@query(
    """
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
    ), totals AS (
        SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM totals
    ), levels AS (
        SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
        FROM weighed
        WINDOW before AS (ORDER BY source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), targets AS (
        SELECT source, source_size, least(source_size * 3.0::DOUBLE, max(level) OVER () * w) AS target FROM levels
    ), rated AS (
        SELECT s.doc_id, s.size, t.source_size, t.target,
            least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END, 3.0) AS rate,
            ('0x' || substr(md5('0:' || coalesce(s.doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, round(target, 2) AS target,
        (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM rated
    """
)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.mixing_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.round("_target", 2).alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query(
    """
    WITH p AS (
        SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
    FROM f
    """
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query(
    """
    WITH n AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
    )
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM n WINDOW same AS (PARTITION BY t)
    """
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = id_remainder("doc_id", 3) == 1
    fitted = langid.fit_languages(docs.where(~held))
    return langid.predict_language(docs, *fitted, keep={"held_out": held})


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_main_text(table(spark, sf_dir, "pages"))

def _nearest(entries: str) -> str:
    far = " + ".join(f"(s[{i}] - c[{i}]) * (s[{i}] - c[{i}])" for i in range(1, 5))
    return f"SELECT vec_id, part, min(({far}) * 64 + entry) AS k FROM parts JOIN {entries} USING (part) GROUP BY ALL"


def _averaged(old: str, near: str) -> str:
    mean = ", ".join(f"floor(sum(s[{i}]) / count(*))::BIGINT" for i in range(1, 5))
    return (
        f"SELECT part, entry, coalesce(m, c) AS c FROM {old} LEFT JOIN (SELECT part, k % 64 AS entry, [{mean}] AS m "
        f"FROM {near} JOIN parts USING (vec_id, part) GROUP BY ALL) USING (part, entry)"
    )


@query(
    f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT vec_id, p AS part, v[p * 4 + 1 : p * 4 + 4] AS s FROM kept, range(16) t(p)
    ), first AS (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64
    ), c0 AS MATERIALIZED (SELECT part, entry, s AS c FROM parts JOIN first USING (vec_id)),
    a0 AS MATERIALIZED ({_nearest("c0")}), c1 AS MATERIALIZED ({_averaged("c0", "a0")}),
    a1 AS MATERIALIZED ({_nearest("c1")}), c2 AS MATERIALIZED ({_averaged("c1", "a1")}),
    a2 AS MATERIALIZED ({_nearest("c2")}),
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', (k % 64)::INTEGER), '' ORDER BY part) AS code, sum(k // 64)::BIGINT AS error
        FROM a2 GROUP BY vec_id
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
        (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY part, entry, i)) FROM c2, range(1, 5) t(i)) AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id)
    """
)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_PERSONAL = {
    "email": (_EMAIL, "true", "lower(v)"),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "len(list_filter(string_split(v, '.'), lambda x: len(ltrim(x, '0')) > 3 OR (len(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0",
        "v",
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        "len(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN d[len(d) - i + 1]::INT"
        " ELSE d[len(d) - i + 1]::INT * 2 - CASE WHEN d[len(d) - i + 1]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0",
        "d",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 9 AND 15", "d"),
}
_CUT = " UNION ALL ".join(
    f"SELECT text, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS hits, regexp_split_to_array(text, '{p}') AS gaps FROM texts"
    for rank, (kind, (p, _, _)) in enumerate(_PERSONAL.items())
)
_VALID = " OR ".join(f"(kind = '{k}' AND {test})" for k, (_, test, _) in _PERSONAL.items())
_ENTITY = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{k}:' || {form}" for k, (_, _, form) in _PERSONAL.items()) + " END"
_WORDS = (
    "list_filter(regexp_extract_all({}, '[\\p{{L}}\\p{{N}}''_-]+'), lambda x: len(x) > 2 AND regexp_matches(x, '^\\p{{L}}'))"
)


@query(
    rf"""
    WITH texts AS MATERIALIZED (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
    cut AS ({_CUT}),
    hit AS (
        SELECT text, rank, kind, hits[i] AS v, regexp_replace(hits[i], '[^0-9]+', '', 'g') AS d, gaps[i] AS g, gaps[i + 1] AS h,
            sum(len(gaps[i]) + len(hits[i])) OVER (PARTITION BY text, rank ORDER BY i) AS e
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut)
    ), base AS MATERIALIZED (
        SELECT text, rank, kind, (e - len(v))::BIGINT AS b, e::BIGINT AS e, {_ENTITY} AS entity,
            CASE WHEN len(g) > 120 THEN regexp_replace(right(g, 120), '^[^\x20\x09-\x0D]+', '') ELSE g END AS left_of,
            CASE WHEN len(h) > 120 THEN regexp_replace(left(h, 120), '[^\x20\x09-\x0D]+$', '') ELSE h END AS right_of
        FROM hit WHERE {_VALID}
    ), near AS MATERIALIZED (
        SELECT DISTINCT text, entity, left_of, right_of,
            lower(unnest({_WORDS.format(f"regexp_replace(left_of || chr(32) || chr(10) || chr(32) || right_of, '{_EMAIL}', ' ', 'g')")})) AS term
        FROM base
    ), wanted AS (
        SELECT entity, term FROM (SELECT DISTINCT entity, term, left_of, right_of FROM near) GROUP BY ALL HAVING count(*) >= 3
    ), pairs AS (SELECT entity, term, count(DISTINCT text) AS t_both FROM near JOIN wanted USING (entity, term) GROUP BY ALL),
    words AS MATERIALIZED (
        SELECT DISTINCT text, lower(word) AS term FROM (SELECT text, unnest({_WORDS.format("text")}) AS word FROM texts)
        WHERE lower(word) IN (SELECT term FROM pairs)
    ), of_term AS (SELECT term, count(*) AS of_term FROM words GROUP BY ALL),
    of_entity AS (SELECT entity, count(DISTINCT text) AS of_entity FROM base GROUP BY ALL),
    terms AS (
        SELECT DISTINCT term FROM pairs JOIN of_term USING (term) JOIN of_entity USING (entity), (SELECT count(*) AS n FROM texts)
        WHERE n > of_entity AND ln(n * t_both / (of_term * of_entity)) / ln(n / of_entity) >= 0.9
    ), token AS (
        SELECT text, hits[i] AS v, sum(len(gaps[i]) + len(hits[i])) OVER (PARTITION BY text ORDER BY i) AS e
        FROM (
            SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
                SELECT text, regexp_extract_all(text, '[\p{{L}}\p{{N}}''_-]+') AS hits, regexp_split_to_array(text, '[\p{{L}}\p{{N}}''_-]+') AS gaps
                FROM texts WHERE text IN (SELECT text FROM words JOIN terms USING (term))
            )
        )
    ), added AS (
        SELECT text, 4 AS rank, 'term' AS kind, (e - len(v))::BIGINT AS b, e::BIGINT AS e FROM token
        WHERE len(v) > 2 AND regexp_matches(v, '^\p{{L}}') AND lower(v) IN (SELECT term FROM terms)
            AND NOT EXISTS (SELECT 1 FROM base WHERE base.text = token.text AND base.b < token.e AND token.e - len(v) < base.e)
    ), spans AS (
        SELECT text, rank, kind, b, e FROM base UNION ALL SELECT text, rank, kind, b, e FROM added
    ), listed AS (
        SELECT text, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
            count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
            string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (kind <> 'term') AS base,
            string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans
        FROM spans GROUP BY text
    )
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
        coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed ON listed.text = coalesce(documents.text, '')
    """
)
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.personal_spans(table(spark, sf_dir, "documents"))


def _grams(k: int) -> str:
    words = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"SELECT lang, {k} AS k, {words} AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces WHERE len(w) >= {k})"


@query(
    rf"""
    WITH pieces AS MATERIALIZED (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
            SELECT coalesce(lang, 'und') AS lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        )
    ), f AS MATERIALIZED (
        SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM ({" UNION ALL ".join(_grams(k) for k in range(1, 5))}) GROUP BY ALL HAVING count(*) >= 30
    ), cuts AS (
        SELECT lang, phrase, k, a, cut, array_to_string(string_split(phrase, ' ')[: cut], ' ') AS head, array_to_string(string_split(phrase, ' ')[cut + 1 :], ' ') AS tail
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1)
    ), scored AS (
        SELECT c.lang, c.phrase, c.k, c.a, x.a AS l, y.a AS r, (2000000 * c.a) // (x.a + y.a) AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
    ), inner_ AS (
        SELECT lang, a, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))
    ), kept AS (
        SELECT s.* FROM scored s LEFT JOIN (SELECT lang, phrase, max(a) AS most FROM inner_ GROUP BY ALL) i ON i.lang = s.lang AND i.phrase = s.phrase
        WHERE most IS NULL OR 100 * most < 80 * s.a
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
    )
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM ranked JOIN (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY ALL) USING (lang) WHERE rank <= 2000
    """
)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents"))
