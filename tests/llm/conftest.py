import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "amber birch cedar delta ember fjord grove haven islet jetty knoll lagoon maple north ocean pine quartz river".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def edge_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = prose(99, 20_000)
    return [
        (1, prose(1, 80), "en", "a", 1),
        (2, prose(1, 80), "en", "a", 1),                 # an exact copy
        (3, prose(1, 79) + " changed", "en", "b", None),   # a near copy
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "en", "c", 4),
        (7, "word", "en", "c", 4),
        (8, long_text, "en", "a", len(long_text)),
        (9, "naïve café ÀÉ 日本 mail x.y+z@mail.example.com and +1 (212) 555-0187 or 10.0.0.255", "fr", "b", 70),
        (9, "naïve café ÀÉ 日本 mail x.y+z@mail.example.com and +1 (212) 555-0187 or 10.0.0.255", "fr", "b", 70),
        (None, prose(5, 30), "en", "d", 3),
        (11, prose(6, 300), "en", None, 9),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    # extra columns whose names operators use themselves
    rows = [(*r, "x", 0.5, 1) for r in edge_documents()]
    return spark.createDataFrame(rows, SCHEMA + ", fingerprint string, score double, size int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample_docs(spark):
    from tests.conftest import SF001
    return spark.read.parquet(f"{SF001}/documents.parquet")
