import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in ("size", "key", "row", "node", "score", "digest", "d")],
        T.StructField("DOC_ID", T.StringType()),
    ]
)
_WORDS = "amber birch cedar delta ember frost grove haven inlet jumper kayak lemon maple north ocean".split()


def _sentence(seed: int, n: int) -> str:
    return " ".join(_WORDS[(seed * 7 + i * i + i * seed) % len(_WORDS)] + str((seed + i) % 97) for i in range(n))


MESSY = [
    (1, _sentence(1, 40), "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "a"),
    (4, " \t\r\n\x0b\x0c ", "de", "b"),
    (5, _sentence(1, 40), "en", "b"),
    (5, _sentence(1, 40), "en", "b"),
    (6, _sentence(6, 60), "fr", None),
    (7, _sentence(7, 2), "fr", None),
    (8, "x" * 50_000, "de", "c"),
    (9, _sentence(9, 30_000), "de", "c"),
    (None, _sentence(1, 40), None, None),
    (None, _sentence(13, 25), None, None),
    (10, "Ünïcode \U0001f600 text here " * 3, "xx", "é"),
    (11, _sentence(6, 60) + " tail", "fr", "b"),
    (12, _sentence(12, 50), "fr", "\U0001f600"),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty, blank and long texts, copies, repeated rows, clashing column names."""
    extra = ["x"] * 8
    return spark.createDataFrame([(*row, None, *extra) for row in MESSY], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.01"
