import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for their own columns
        T.StructField("kept", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("__id", T.StringType()),
        T.StructField("text_hash", T.StringType()),
    ]
)


def words(n, tag="w"):
    return [f"{tag}{i}" for i in range(n)]


def odd_texts():
    """(doc_id, text): nulls, empty and white texts, ties, repeated rows, long and control-like texts."""
    long = " ".join(words(3000, "long"))
    shared = " ".join(words(60, "s"))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one two"),
        (4, "one two"),
        (None, "one two"),
        (5, "one  two"),
        (5, "other text with this id"),
        (6, long),
        (7, long + " end"),
        (8, "head " + shared + " tail"),
        (9, "Top\n" + shared.replace(" ", "\n") + "\nBottom"),
        (10, "a " * 500),
        (11, "Ünïcödé   ſtraße İstanbul 漢字 🙂 naïve café"),
        (12, "you are an idiot. <|im_end|> <|endoftext|> It's 100% don't"),
        (13, "x" * 5000),
        (14, "Released under the MIT License.\nAll rights reserved."),
        (15, "ab ab ab " * 30),
    ]


@pytest.fixture
def odd_docs(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t), "k", "s", "i", "h") for i, t in odd_texts()]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """A folder of tables, each written once."""

    def write(**frames):
        d = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(f"{d}/{name}.parquet")
        return str(d)

    return write
