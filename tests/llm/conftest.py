import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward rows: nulls, empty, repeated, clashing extra columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today", 0), (2, None, 1), (3, "", 2), (None, "no id here", 3), (4, " \n\t ", 4),
        (5, "The quick brown fox jumps over the lazy dog near the river bank today", 5), (5, "The quick brown fox jumps over the lazy dog near the river bank today", 5),
        (6, "ünïcode — 日本語 🎉 don't stop  \n\n now!!", 6), (7, "a" * 5000, 7), (8, "THE QUICK brown fox jumps over the lazy dog near the river bank tonight", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score int").selectExpr("*", "score AS n", "score AS kind", "score AS x", "score AS hits")
