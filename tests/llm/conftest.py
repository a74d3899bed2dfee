import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark, sf_dir):
    """Rows of the smallest documents table as ``(doc_id, text)``."""
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text)`` pairs, with extra columns whose names clash with ours."""
    def make(*pairs):
        clash = ", text_crc32 string, bands string, matches string, score string, size string, key string"
        rows = [(i, t, None, "src", None if t is None else len(t), *["x"] * 6) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENT + clash)
    return make


EDGE_TEXTS = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (6, "é ñ 漢字 😀 ok"),
              (7, "long word " * 20000), (8, "x" * 50000), (9, "a,b;c.d"), (None, "no id here"),
              (10, "same row twice in here ok"), (10, "same row twice in here ok")]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(*EDGE_TEXTS)
