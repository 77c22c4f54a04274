import pytest

pytest.importorskip("ledgerlake.llm")
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents with null, empty and very long texts, ties, repeated rows, null ids and columns with clashing names."""
    long = " ".join(f"word{k % 977} the" for k in range(20_000))
    base = "A quite ordinary text with some fifty words in it so that nothing is missing from it at all "
    rows = [
        (1, "Hello world, it's fine. We'll see!  Twice  \n\n", "en", "a", 1), (2, None, None, None, 2), (3, "", "en", "a", 3), (4, long, "en", None, 4), (5, base * 4, "en", "a", 5), (6, base * 4, "en", "b", 6),
        (6, base * 4, "en", "b", 6), (None, base * 3 + "other end", "de", "a", 7), (8, "   \t\n", "de", "b", 8), (9, "été Straße 中文 😀 123", None, "a", 9), (10, base * 4 + "and more", "en", "a", 10),
    ]
    return spark.createDataFrame([(*r, 0, "x", 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id string, score double")


