import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, columns with clashing names."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "Ha ha.\nSo so", "en", "a", 3, 1), (1, "Ha ha.\nSo so", "en", "a", 3, 1), (2, None, None, None, None, None),
            (3, "", "en", "a", 0, 2), (4, " \t\n\x0b\x0c\r ", "en", "a", 7, 3), (None, "a null id", "en", "a", 9, 4),
            (5, long_text, "en", None, 10, 5), (6, long_text, "en", "a", 10, 6), (7, "x" * 300, "en", "a", 300, 7),
            (8, "é\u2003ü \U0001f600 naïve\xa0text \x1c \x85 end", "fr", "b", 1, 8), (9, "Ha ha.\nSo so", "en", "b", 3, 9)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long").repartition(3)
