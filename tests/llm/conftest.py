import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names
    operators might use themselves."""
    def make(rows, source=None, lang=None):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else source, lang) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        for name in ("id", "n", "size", "block", "kind", "class", "row", "part", "score", "ids", "label", "start", "list"):
            df = df.withColumn(name, F.lit(-1))
        return df
    return make


ODD_TEXTS = ["", " ", None, "a", "a  b\t\nc ", "éè 日本 \U0001f600 x\x00y", "word " * 30_000, "x" * 200_000,
             "<|endoftext|> a<|endoftext|>"]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    return rows + [rows[3], rows[4], (None, "null id"), (None, None)]
