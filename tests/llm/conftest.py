import os

import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")

#: Rows that every operator has to stand: nulls, empty and odd texts, repeats, clashing columns.
ODD = [
    (0, "a b c d e f g h i j k l", "en", "s1"),
    (1, "a b c d e f g h i j k l", "en", "s1"),
    (1, "a b c d e f g h i j k l", "en", "s1"),
    (2, None, "en", None),
    (3, "", None, "s2"),
    (4, " \t\n ", "fr", "s2"),
    (5, "!!! 123 ...", "fr", ""),
    (6, "word", "xx", "s3"),
    (7, "x" * 50_000, "en", "s3"),
    (8, "Ünïcödé тест 漢字 \U0001f600 \x1f \x85 <|endoftext|>", "de", "s1"),
    (9, "one two three four five six seven eight nine ten " * 3_000, "en", "s2"),
    (None, "a row without an id of its own here", "en", "s1"),
]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string")
    extra = {"n": 1, "name": 2, "row": 3, "size": 4, "id": 5, "label": 6, "kept": 7, "chunk": 8, "_size": 9, "score": 10, "node": 11, "_sha": 12, "_source": 13, "_id": 14, "doc": 15, "sha": 16, "copy": 17, "target": 18, "of": 19}
    return df.select("*", *[F.lit(v).alias(k) for k, v in extra.items()]).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
