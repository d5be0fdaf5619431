"""Rows that operators must take: nulls, empty and long texts, repeats, and clashing column names."""

from pyspark.sql import types as T

COPY = "The same words stand here once more and then again,\nline by line, so that it is long enough to count."
ROWS = [
    (0, COPY),
    (1, COPY),
    (1, COPY),
    (2, COPY + " And a little more."),
    (3, None),
    (4, ""),
    (5, " \n\t\r\x0b\x0c "),
    (6, "word"),
    (6, "another"),
    (None, "word"),
    (None, None),
    (None, COPY),
    (7, "Grüße, été \U0001f600 b@c.de, +1 (487) 555-7209, 10.0.0.255 and 4111 1111 1111 1111"),
    (8, "x" * 200_000),
    (9, "1 " * 60_000),
    (10, "\n".join(f"line {i % 7} of many" for i in range(5_000))),
    (11, "b@c.d " * 3_000),
    (12, "a b c\u0085d\x1ce f"),
]
CLASHING = ("id", "row", "node", "n", "key", "keys", "part", "num", "score", "kept", "size", "shard", "epoch", "n_tokens", "domain", "value", "label")


def edge_documents(spark):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    fields += [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(name, T.StringType()) for name in CLASHING]
    rows = []
    for i, (doc_id, text) in enumerate(ROWS):
        lang, source = (None, None) if i % 5 == 4 else ("en", f"src{i % 3}")
        rows.append((doc_id, text, lang, source, None if text is None else len(text), *["clash"] * len(CLASHING)))
    return spark.createDataFrame(rows, T.StructType(fields))


def documents(spark, rows, **columns):
    """doc_id and text, and more columns with one value each."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(name, T.StringType()) for name in columns]
    return spark.createDataFrame([(*row, *columns.values()) for row in rows], T.StructType(fields))
