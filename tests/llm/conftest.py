import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                        StructField("source", StringType()), StructField("n_chars", LongType())])


def prose(seed: int, words: int) -> str:
    import random
    r = random.Random(seed)
    syllables = "an the re on at er th in ing ou ea st nd or es ti ha".split()
    stops = "the of and to in is that with for as".split()
    out = [r.choice(stops) if r.random() < 0.3 else "".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(out)).capitalize()


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank and very long texts, ties, repeated rows and null ids."""
    a, b = prose(1, 200), prose(2, 150)
    return [(1, a, "en", "s", len(a)), (2, a, "en", "s", len(a)), (2, a, "en", "s", len(a)), (3, None, None, None, None),
            (4, "", "en", None, 0), (5, " \n\t ", "en", "s", 4), (6, b, "en", "s", len(b)), (7, prose(3, 30_000), "en", "s", 1),
            (None, b + " tail", "en", "s", 1), (None, None, None, None, None), (8, "x", "de", "s", 1),
            (9, "é 123 a.b@mail.example.com +1 (555) 555-1234", "fr", "s", 1), (None, "alone " + prose(4, 80), None, None, None)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, parts=3):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(parts)
    return make
