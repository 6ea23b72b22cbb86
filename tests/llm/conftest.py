import pytest
from pyspark.sql import types as T

#: Columns that some operator uses as a name of its own, as extra columns of the input.
CLASHING = ["h1", "pos", "block", "words", "fp", "w0", "text_crc32", "shard", "size", "part", "ids", "score", "n_lines", "item_id", "id", "learn"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with extra columns of clashing names."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in CLASHING)])

    def make(rows, partitions=3):
        filled = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), *["x"] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(filled, schema).repartition(partitions)

    return make


#: Nulls, empty and blank texts, one word, repeated rows, a repeated id, a long text, white space and characters of all kinds.
EDGES = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the farm"), (2, None), (3, ""), (4, " \t\n \x0b"), (5, "one"),
    (6, "The quick brown fox jumps over the lazy dog and runs away from the farm"), (6, "The quick brown fox"), (6, "The quick brown fox"),
    (None, "null id text"), (None, None), (7, "word " * 30_000), (8, "ÉTÉ \U0001F600 ▁x </s> <|endoftext|> \\ \x00 a b\n\n A.B"),
    (9, "a b\na b\na b\n\nc"), (10, " lead  and trail "),
]
