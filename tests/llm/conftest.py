import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def messy(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, names that clash."""
    story = "The quick brown fox jumps over the lazy dog while twelve small birds sing in the old garden near the river bank"
    rows = [
        (1, story, "en", "a"), (1, story, "en", "a"), (2, story + " again", None, "a"), (None, story, "en", None),
        (None, None, None, None), (3, None, "en", "a"), (4, "", "en", "a"), (5, " \n\n\t ", "de", "a"),
        (6, "word " * 30000, "en", "b"), (7, "\n".join([story] * 4), "en", "b"), (8, "### ***", "en", "b"),
        (9, "Ünï çødé ßtraße 😀 日本語\n" + story, "de", "b"), (10, "x" * 50000, "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = "_id _h _row node line gone fp key token start end label w n_words kept words spans t item window".split()
    from pyspark.sql import functions as F

    return df.select("*", F.char_length("text").cast("long").alias("n_chars"), *[F.lit(f"extra {n}").alias(n) for n in names]).cache()


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")
