import pytest
from pyspark.sql import functions as F

from lendframe.llm.common import ship, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node string, size string, place string, group string, `__row` string"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty, blank, short, very long and odd texts, equal texts, repeated rows and repeated ids."""
    line = "the quick brown fox jumps over the lazy dog while seventeen grey geese watch from the bank of the river "
    texts = [
        None, "", " \t\n", "a", "One two", "one TWO", "don't stop", "Été straße ǅ İ", "x" * 3000, line * 3, line * 3, line.upper() * 3,
        "before " + line * 2 + "after", "other " + line * 2 + "end", "ab" * 5000, "<|endoftext|> tail", "é ́a \x1c b c", "日本語のテキスト", "word " * 40_000,
        " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" if i != 200 else "changed" for i in range(400)), "".join(chr(33 + i % 90) for i in range(700)),
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["b", "a", None, "é", "Z"][i % 5], i, "k", None, "s", "p", "g", "r") for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (9, "same id, other text", "en", "b", None, *"kkspgr"), (None, "no id", None, None, None, *"kkspgr"), (None, "no id", None, None, None, *"kkspgr")]
    rows += [(-5, None, None, None, None, None, None, None, None, None, None)]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    ship(spark)
    return spark.createDataFrame(messy_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where(F.lit(False))


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
