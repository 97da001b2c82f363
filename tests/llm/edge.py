"""Rows that operators must handle: nulls, blanks, a long text, repeats, clashing column names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, None, None, None, None), (2, "", "en", "src0", 0), (3, " \n\t ", "en", "src0", 4), (4, "one", "en", "src1", 3),
    (5, "One two\nthree", None, "src1", 13), (6, LONG, "en", None, len(LONG)), (7, "one two three", "en", "src1", 13),
    (7, "one two three", "en", "src1", 13), (8, LONG, "en", "other", len(LONG)), (9, "é" * 5000, "fr", "src2", 5000),
    (None, "a text without an id", "en", "src0", 20), (None, None, None, None, None),
]
CLASHES = ["id", "print", "score", "spans", "doc", "h", "order0", "bucket", "mix_slot", "mix_position", "component", "label", "host", "of", "in", "before", "ahead", "kept_id", "best", "node", "text_"]


def edge_docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(df):
    """df with more columns, named as operators name theirs."""
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
