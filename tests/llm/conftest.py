import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 3)[0])

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def make(spark):
    """Small document tables with nulls, ties and columns whose names clash with internal ones."""
    def build(texts, source=None, extra=True):
        data = [(i, t, None, source[i] if source else "s", None) for i, t in texts] if source else [(i, t, "en", "s", 0) for i, t in texts]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for c in ("n", "h", "t", "fp", "key", "run", "size", "score", "__words"):
                df = df.selectExpr("*", f"'x' as `{c}`")
        return df
    return build
