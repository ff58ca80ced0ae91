import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, id string, hash string, lists string"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, and columns whose names operators might use inside."""
    long = "the thing of her and that edition. " * 6000
    rows = [
        (1, "the thing of her and that. Another line is here.\nA third one follows it now.", "en", "a"),
        (1, "the thing of her and that. Another line is here.\nA third one follows it now.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, "   \n\t ", "fr", "b"),
        (5, long, "en", "a"),
        (None, "der die das und nicht ein", "de", "a"),
        (None, None, None, None),
        (6, "12345 6789", "en", "b"),
        (7, "le la les des et une", "fr", None),
        (8, "x", "en", "c"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 0, "i", "h", "l") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
