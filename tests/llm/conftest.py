import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators also use inside
    T.StructField("score", T.StringType()), T.StructField("stats", T.IntegerType()), T.StructField("fp", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("row", T.StringType()), T.StructField("_score", T.StringType()),
    T.StructField("block", T.StringType()), T.StructField("length", T.StringType())])

LONG = "one two three four five six seven eight nine ten " * 4000
TEXTS = [None, "", " \t\n", "word", "two words", "Near Copy of a text with many words that nobody else has written here",
         "near copy OF a text with many words that nobody else has written here", LONG, "!!! ??? ...", "éàü ß 日本語   x"]


def rows():
    out = [(i, t, "en", f"s{i}", None, "x", 1, "f", "l", "r", "s", "b", "n") for i, t in enumerate(TEXTS)]
    out += [out[5], out[5], (None, "near copy of a text with many words that nobody else has written here", None, None, None, *[None] * 8),
            (None, None, *[None] * 11)]
    return out


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Nulls, empty, long and repeated rows, clashing column names; a stored table."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows(), DOCS).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def got(df):
    """Rows as sorted tuples; nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
