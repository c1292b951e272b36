import pytest

pytest.importorskip("bidtide.llm")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Awkward documents: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog and then it runs away\nunder the MIT License!", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog and then it runs away\nunder the MIT License!", "en", "a"),
        (2, None, None, None), (3, "", "en", "a"), (None, "no id here", "en", None), (4, "word", None, "b"),
        (5, "  spaced \n\n out\t text  with   gaps ", "en", "a"), (6, "é" * 3000 + " x" * 4000, "fr", "a"),
        (7, "1." * 5000 + "a@" + "b." * 5000 + " 1 2 3" * 5000, "de", "a"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extras = ("component_id", "kept", "start", "n", "ids", "queue", "shard", "n_words", "row", "key", "n_chars", "score")
    return frame.selectExpr("*", *[f"7L as {c}" for c in extras])


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
