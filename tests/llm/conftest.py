import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, copies, repeated rows and columns with names that operators use themselves."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, None, "x"), (2, "", None), (3, "  \n\t ", "en"), (4, "one", "en"), (5, "One", "en"), (6, "alpha beta gamma delta", "en"),
        (7, "ALPHA beta  gamma\ndelta", "en"), (8, long, "en"), (9, long + " tail", "en"), (10, "...!?", "en"), (11, "4111 1111 1111 1111 +1 (988) 555-2485 a@b.co 1.2.3.4", "de"),
        (12, "nul\x00byte ▁ café \U0001f600 İ", "fr"), (12, "nul\x00byte ▁ café \U0001f600 İ", "fr"),
    ]
    return spark.createDataFrame([(i, t, x, i, 1, "k", 0) for i, t, x in rows], "doc_id long, text string, lang string, n long, a long, band string, word int")
