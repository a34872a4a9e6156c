import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    return made


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and columns whose names may clash."""
    long = " ".join(f"word{k % 997} été{k % 13}" for k in range(30000))
    texts = [None, "", " \n\t ", "one", "one two", "a b c d e f g", "a b c d e f g", "A B C d e f g", long, long, "Ünïcode 🙂 " * 30, "x" * 5000, "line\nline\n\nline\n", "<|endoftext|> and <|startoftext|>", "password = hunter2hunter2"]
    rows = [(k, t, None if k % 4 == 0 else "en", None if k % 3 == 0 else f"src{k % 2}", None if k % 5 == 0 else 1, k, "x", 0, "y") for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "a b c d e f g", "en", "src1", 3, 1, "x", 0, "y"), (None, None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id long, label string, fingerprint long, span string"
    return spark.createDataFrame(rows, schema)
