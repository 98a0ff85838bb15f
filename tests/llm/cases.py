"""Small inputs with the awkward cases: nulls, empties, repeats, clashing names, long texts."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("row", T.StringType()), ("key", T.StringType()))])


def frame(spark, pairs, source="s"):
    rows = [(i, t, "en", source if not callable(source) else source(i), len(t or ""), "x", "y") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [
    (1, "Hello  world\nhello world\n"), (2, None), (3, ""), (4, "Hello world\thello world"), (5, " \n\t "), (6, "é" * 50 + " ẞ x # * <|>"),
    (7, "word " * 30000), (8, "x" * 20000), (9, "Hello world hello world"), (10, None), (11, "\n\n a \n a \nb"), (12, "a b c d e f g h i a b c d e f g h i"),
]
