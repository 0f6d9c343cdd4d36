import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta " * 60_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ties, one hot source, and columns whose names clash with operators' own."""
    rows = [
        (1, "the cat sat on the mat and looked around", "en", "a", 1),
        (2, "the cat sat on the mat and looked around", "en", "a", 1),
        (2, "the cat sat on the mat and looked around", "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", None, "b", 0),
        (5, " \t\n", "de", None, 3),
        (None, "a row without an id", "en", "a", 1),
        (None, "a row without an id", "en", "a", 1),
        (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)),
        (7, "x" * 30_000, "en", "a", 30_000),
        (8, "Ünïcödé 🙂 \x85 \x1c text\x0bmore <|endoftext|> [INST] </s>", "fr", "b", 9),
        *[(100 + i, f"document number {i} tells of {i * 7} things, and {i % 5} more", "en", "a" if i % 3 else f"s{i % 4}", 1) for i in range(60)],
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("component_id", "rate", "copy", "n_copies", "shuffle_key", "shard", "slot", "p_text", "p_good", "ids", "fingerprint", "media", "TEXT_HASH", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
