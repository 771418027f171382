import re

import pytest

from caseloom.llm import registry

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(autouse=True)
def workers(spark):
    registry.reachable(spark)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# Nulls everywhere, empty and blank texts, one long text, repeated rows, one id with two texts, characters of all widths.
ODD = [
    (None, "a text without an id, long enough to have a few shingles of its own", "en", "s1", 1),
    (1, None, None, None, None),
    (2, "", "en", "s1", 0),
    (3, " \n\t\r\n ", "en", "s2", 6),
    (4, "x" * 30_000 + " end", "en", None, 30_004),
    (5, "the same text stands here twice under one and the same id", "en", "s1", 57),
    (5, "the same text stands here twice under one and the same id", "en", "s1", 57),
    (5, "another text under this id, as ids are not checked anywhere", "en", "s1", 59),
    (6, "Ünïcödé 中文 \U0001f600 don't it's x 123 !!", "de", "s2", 32),
    (7, "one", "en", "s2", 3),
    (8, "one", "en", "s3", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Odd rows, with extra columns named like ones the operators use inside."""
    frame = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    return frame.selectExpr("*", "1 AS part", "2 AS tag", "'r' AS rest", "3 AS size", "4 AS target", "true AS keep", "5 AS content", "6 AS n_tokens", "7 AS bucket")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def ratings(spark):
    rows = [(k, k % 2, k % 3 == 0) for k in range(1, 9)] + [(None, 1, False), (5, None, None), (6, None, True), (99, 1, False)]
    return spark.createDataFrame([(d, q, None if t is None else int(t)) for d, q, t in rows], "doc_id long, quality int, toxic int")
