import pytest
from pyspark.sql import types as T

from pulsegrid.llm.queries import on_workers

#: Documents with extra columns that clash with the operators' own names.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *(T.StructField(c, T.StringType()) for c in ("key", "row", "shard", "block", "score", "class", "matches", "ids")),
])


@pytest.fixture(scope="session")
def session(spark):
    on_workers(spark)
    return spark


@pytest.fixture(scope="session")
def make(session):
    def documents(rows):
        """Rows are (doc_id, text) or (doc_id, text, lang, source)."""
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), *("x",) * 8) for r in rows]
        return session.createDataFrame(full, SCHEMA)

    return documents
