import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), with columns whose names operators use inside."""

    def build(rows, extra=True):
        full = [(r + (None, None))[:4] for r in rows]
        df = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], SCHEMA)
        if extra:
            for name in ("size", "key", "bits", "kept", "blob", "part", "start", "copies", "target", "id", "pattern", "edited"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return build


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\r\n\x0b\x0c "),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (6, "Ünï – 漢字 \U0001f600 é \x00 \x85\xa0  end"),
    (7, "word " * 40_000),
    (8, "1" * 30_000),
    (None, "no id"),
    (None, None),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES


@pytest.fixture(scope="session")
def sample():
    """Documents of the smallest tables; None where they aren't here."""
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the tables aren't here")
    return path
