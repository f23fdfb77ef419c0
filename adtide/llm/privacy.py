"""Personal data in texts: patterns, and the terms that reveal who is meant.

The base finds emails, network addresses, card and phone numbers. Their distinct values are the
protected entities. What else reveals an entity is learned from the corpus: terms near its mentions
are candidates, and the disclosure of an entity c by a term t is their pointwise mutual information
over distinct texts as a share of the information of c,

    log(N * texts(t, c) / (texts(t) * texts(c))) / log(N / texts(c)),

which is 1 when t is never seen without c and at most 0 when they are independent. Terms that reach
the threshold become spans of their own wherever they stand. In sanitised text such a term is
generalised to its first letters where those disclose less than the threshold, otherwise removed.

Everything is a DataFrame expression: every pattern reads a text once, from left to right, without
going back, and positions come from running totals in blocks.

Cases without an ordinary result: a null text is empty; rows with equal texts count as one text in
every statistic, whatever their ids; a context that is repeated word for word counts once towards
the support of a candidate; an entity in every text has no information and is disclosed by nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.sources.files import stage

#: A run that could be a local part starts where no such run is under way, or where the last match
#: ended; so no start inside a run is tried again, and possessive repeats never give back.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: A whole chain of digits with single separators, of 12 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IN_TERM = r"[\p{L}\p{N}'_-]"
TERM = rf"(?<!{_IN_TERM})\p{{L}}{_IN_TERM}{{2,}}+"

#: Characters on either side of a mention whose terms are candidates.
CONTEXT = 120
#: Different contexts of an entity in which a candidate has to stand.
SUPPORT = 3
THRESHOLD = 0.9
#: Letters that a generalised term keeps.
STEM = 3
#: Elements that a running total adds up one by one.
BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body).getItem(0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _running(values: Column) -> Column:
    """Running totals of an array of bigint, with the totals of whole blocks added up first."""
    blocks = lambda v: F.transform(
        F.sequence(F.lit(0), F.floor(F.size(v) / BLOCK).cast("int")), lambda b: _total(F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
    )
    before = lambda v: _let(blocks(v), lambda sums: F.transform(sums, lambda _, b: _total(F.slice(sums, F.lit(1), b))))
    return _let(
        values,
        lambda v: _let(
            before(v),
            lambda earlier: F.transform(
                v, lambda _, i: F.get(earlier, F.floor(i / BLOCK).cast("int")) + _total(F.slice(v, i - i % BLOCK + 1, i % BLOCK + 1))
            ),
        ),
    )


def matches(text: Column, pattern: str, hits: Column) -> Column:
    """Array of (start, end, value, before, after) of ``hits``, all matches of ``pattern``.

    ``before`` and ``after`` are at most CONTEXT characters of what lies between the matches,
    without a word that the cut goes through.
    """

    def pieces(gaps: Column) -> Column:
        sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: (F.length(g) + F.length(h)).cast("bigint"))
        left = lambda g: F.when(F.length(g) > CONTEXT, F.regexp_replace(F.right(g, F.lit(CONTEXT)), r"^[^\x20\x09-\x0D]*+", "")).otherwise(g)
        right = lambda g: F.when(F.length(g) > CONTEXT, F.regexp_replace(F.left(g, F.lit(CONTEXT)), r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*+$", "")).otherwise(g)
        return F.transform(
            F.arrays_zip(hits.alias("value"), _running(sizes).alias("end")),
            lambda m, i: F.struct(
                (m["end"] - F.length(m["value"])).alias("start"), m["end"].alias("end"), m["value"].alias("value"),
                left(F.get(gaps, i)).alias("before"), right(F.get(gaps, i + 1)).alias("after"),
            ),
        )

    return F.when(F.size(hits) > 0, _let(F.split(text, pattern, -1), pieces))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _octets(value: Column) -> Column:
    """Whether every part is at most 255, whatever its leading zeros."""
    return F.forall(
        F.split(value, r"\."), lambda p: _let(F.ltrim(p, F.lit("0")), lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255")))
    )


def _luhn(value: Column) -> Column:
    def weighed(digits: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return _let(
        _digits(value),
        lambda digits: F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + weighed(digits, i)) % 10 == 0,
    )


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


#: Kind: pattern, what a text must have for it, test of a match, form that names the entity.
KINDS: dict[str, tuple[str, str | None, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "email": (EMAIL, "@", lambda v: F.lit(True), F.lower),
    "ip": (IP, None, _octets, lambda v: v),
    "card": (CARD, None, _luhn, _digits),
    "phone": (PHONE, "+", _phone, _digits),
}


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def base_spans(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _key, n_<kind>, _spans, _mentions) of each row, and ``_text``.

    ``_spans`` has (start, rank, end, kind) in order; ``_mentions`` has (entity, context, terms).
    """
    none = F.array().cast("array<string>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    text = F.col("_text")
    hits = {
        k: F.when(F.lit(True) if needs is None else F.contains(text, F.lit(needs)), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none)
        for k, (p, needs, _, _) in KINDS.items()
    }
    rows = rows.select("*", *[h.alias(f"_hits_{k}") for k, h in hits.items()])
    passing = lambda test: lambda m: test(m["value"])
    found = {k: F.filter(matches(text, p, F.col(f"_hits_{k}")), passing(test)) for k, (p, _, test, _) in KINDS.items()}
    rows = rows.select("_id", "_text", *[f.alias(f"_{k}") for k, f in found.items()])
    empty_spans = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    empty_mentions = F.array().cast("array<struct<entity:string,context:bigint,terms:array<string>>>")

    def spans(kind: str, rank: int) -> Column:
        made = F.transform(F.col(f"_{kind}"), lambda m: F.struct(m["start"], F.lit(rank).alias("rank"), m["end"], F.lit(kind).alias("kind")))
        return F.coalesce(made, empty_spans)

    def mentions(kind: str) -> Column:
        def mention(m: Column) -> Column:
            around = F.regexp_replace(F.concat(m["before"], F.lit(" \n "), m["after"]), EMAIL, " ")
            entity = F.concat(F.lit(f"{kind}:"), KINDS[kind][3](m["value"]))
            return F.struct(
                entity.alias("entity"), F.xxhash64(entity, m["before"], m["after"]).alias("context"), _terms(around).alias("terms")
            )

        return F.coalesce(F.transform(F.col(f"_{kind}"), mention), empty_mentions)

    return rows.select(
        "_id", "_text", _text_key(text).alias("_key"),
        *[F.coalesce(F.array_size(f"_{k}"), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.concat(*[spans(k, r) for r, k in enumerate(KINDS)])).alias("_spans"),
        F.concat(*[mentions(k) for k in KINDS]).alias("_mentions"),
    )


def _stem_key(term: Column) -> Column:
    """First letters of a term; the star is in no term."""
    return F.concat(F.left(term, F.lit(STEM)), F.lit("*"))


def disclosures(found: DataFrame, texts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(entity, term, disclosure, stem_disclosure) of every candidate.

    ``found`` is a stored result of ``base_spans`` and ``texts`` has (_key, _text), once for each
    text. Mentions are merged before they are counted, so an entity or a text with very many copies
    is one row for each of its terms by then. The words of the corpus are summed in the tasks that
    read them; sums meet the candidates.
    """
    near = found.select("_key", F.explode("_mentions").alias("m")).select(
        "_key", F.col("m.entity").alias("entity"), F.col("m.context").alias("context"), F.explode("m.terms").alias("term")
    )
    contexts = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count("*").alias("contexts"))
    wanted = contexts.where(F.col("contexts") >= support).select("entity", "term")
    keyed = near.select("entity", "term", "_key").distinct()
    both = stage(keyed.join(wanted, ["entity", "term"]).groupBy("entity", "term").agg(F.count("*").alias("t_both")), "pairs")
    stem = _stem_key(F.col("term"))
    stems_both = (
        keyed.select("entity", stem.alias("stem"), "_key").distinct()
        .join(both.select("entity", stem.alias("stem")).distinct(), ["entity", "stem"])
        .groupBy("entity", "stem").agg(F.count("*").alias("s_both"))
    )
    of_entity = (
        found.select("_key", F.explode("_mentions.entity").alias("entity")).distinct()
        .groupBy("entity").agg(F.count("*").alias("of_entity"))
    )
    both_ways = F.array_distinct(F.flatten(F.transform(_terms(F.col("_text")), lambda t: F.array(t, _stem_key(t)))))
    counts = texts.select(F.explode(both_ways).alias("word")).groupBy("word").agg(F.count("*").alias("of"))
    needed = both.select(F.explode(F.array(F.col("term"), stem)).alias("word")).distinct()
    counts = stage(counts.join(needed, "word", "left_semi"), "counts")
    of_term = counts.select(F.col("word").alias("term"), F.col("of").alias("of_term"))
    of_stem = counts.select(F.col("word").alias("stem"), F.col("of").alias("of_stem"))
    n_texts = texts.agg(F.count("*").alias("n_texts"))
    n = n_texts.scalar()
    rated = (
        both.withColumn("stem", stem).join(of_entity, "entity").join(of_term, "term").join(of_stem, "stem")
        .join(stems_both, ["entity", "stem"]).withColumn("n_texts", n)
    )
    known = F.log(F.col("n_texts") / F.col("of_entity"))
    share = lambda pair, alone: F.when(
        known > 0, F.log(F.col("n_texts") * F.col(pair) / (F.col(alone) * F.col("of_entity"))) / known
    ).otherwise(0.0)
    return rated.select("entity", "term", share("t_both", "of_term").alias("disclosure"), share("s_both", "of_stem").alias("stem_disclosure"))


def revealing_terms(rated: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(term, disclosure, general): terms at or over the threshold; ``general`` is the letters that
    may stay, null where those too disclose an entity."""
    worst = rated.groupBy("term").agg(F.max("disclosure").alias("disclosure"), F.max("stem_disclosure").alias("_stem"))
    general = F.when(F.col("_stem") < threshold, F.left(F.col("term"), F.lit(STEM)))
    return worst.where(F.col("disclosure") >= threshold).select("term", "disclosure", general.alias("general"))


def _marked(df: DataFrame, id_col: str, text_col: str, support: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Stored base spans of the rows, and (_key, _added) of the texts where revealing terms stand."""
    found = stage(base_spans(df, id_col, text_col).drop("_text"), "found")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = stage(df.select(_text_key(text).alias("_key"), text.alias("_text")).dropDuplicates(["_key"]), "texts")
    terms = stage(revealing_terms(disclosures(found, texts, support), threshold), "terms")
    standing = texts.select("_key", F.explode(_terms(F.col("_text"))).alias("term"))
    lists = stage(
        standing.join(terms, "term").groupBy("_key").agg(F.collect_list(F.struct("term", "general")).alias("_terms")), "revealed"
    )  # one text's own words
    named = texts.join(lists, "_key").select("_key", "_text", "_terms", F.regexp_extract_all("_text", F.lit(TERM), F.lit(0)).alias("_hits"))
    placed = F.transform(
        matches(F.col("_text"), TERM, F.col("_hits")),
        lambda m: F.struct(
            m["start"], F.lit(len(KINDS)).alias("rank"), m["end"], F.lit("term").alias("kind"),
            F.get(F.filter("_terms", lambda t: t["term"] == F.lower(m["value"])), F.lit(0))["general"].alias("general"),
            F.exists("_terms", lambda t: t["term"] == F.lower(m["value"])).alias("reveals"),
        ),
    )
    added = named.select("_key", F.filter(placed, lambda m: m["reveals"]).alias("_added"))
    return found, stage(added, "added")


def _all_spans(base: Column, added: Column) -> Column:
    """Base spans as they are, and added ones that touch none of them, in order."""
    apart = F.filter(added, lambda a: ~F.exists(base, lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    plain = lambda general: lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], general(s).alias("general"))
    base = F.transform(base, plain(lambda s: F.lit(None).cast("string")))
    return F.coalesce(F.array_sort(F.concat(base, F.transform(apart, plain(lambda s: s["general"])))), base)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row.

    Spans are kind:start:end in code points, end exclusive, by start, then kind in the order email,
    ip, card, phone, term.
    """
    found, added = _marked(df, id_col, text_col, support, threshold)
    return found.join(added, "_key", "left").select(
        F.col("_id").alias(id_col), *[f"n_{k}" for k in KINDS],
        F.sha2(_listed(F.col("_spans")), 256).alias("base_sha256"),
        _listed(_all_spans(F.col("_spans"), F.col("_added"))).alias("spans"),
    )


def sanitise(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD
) -> DataFrame:
    """(id, text): each span replaced by its kind in brackets, revealing terms by the letters that
    may stay or by nothing. Of overlapping spans the first stands for all."""
    _, added = _marked(df, id_col, text_col, support, threshold)
    rows = base_spans(df, id_col, text_col).join(added, "_key", "left")
    text = F.col("_text")
    put = lambda s: F.when(s["kind"] == "term", F.coalesce(F.concat(s["general"], F.lit("*")), F.lit(""))).otherwise(
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
    )
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), put(s))
        ).alias("out"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    clean = F.aggregate(_all_spans(F.col("_spans"), F.col("_added")), start, step, rest)
    return rows.select(F.col("_id").alias(id_col), clean.alias(text_col))
