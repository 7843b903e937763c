import pytest
from pyspark.sql import functions as F

from farebox.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def odd(spark):
    """Documents with nulls everywhere, empty and long texts, repeats, and clashing names."""
    long = " ".join(f"word{n}" for n in range(30_000))
    values = [
        (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
        (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, " \t\r\n\v\f ", "en", None),
        (None, "one two three four five six seven eight nine ten eleven twelve", None, "a"),
        (None, None, None, None),
        (5, long, "de", "b"),
        (6, "x", "en", "c"),
    ]
    frame = spark.createDataFrame(values, "doc_id long, text string, lang string, source string")
    clash = {
        name: F.lit(7)
        for name in ("size", "fingerprint", "row_hash", "kept", "n_words", "h1", "copies", "id")
    }
    return frame.withColumns(clash | {"a.b": F.lit("dot"), "n_chars": F.length("text")})


@pytest.fixture
def empty(odd):
    return odd.limit(0)
