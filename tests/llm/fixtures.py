"""Small tables with everything that may go wrong in a column."""

import re

LONG = "erst the onth and of " * 4000 + "mail a.b@c.example.org now"
ROWS = [
    (1, "The first text of the table, with some words in it.", "en", "src0"),
    (2, "The first text of the table, with some words in it.", "en", "src0"),
    (2, "The first text of the table, with some words in it.", "en", "src0"),
    (3, None, "en", "src0"),
    (4, "", None, "src1"),
    (5, "one", "fr", None),
    (6, " \n\t ", "xx", "src1"),
    (7, LONG, "en", "src2"),
    (8, "Der MIT License Text, für den Rest: MIT license! 12.13.14.15 und +49 (30) 1234-5678", "de", "src2"),
    (9, "é́ \U0001f600 中文 <|endoftext|> 'll x y", "zz", "src2"),
    (10, "4111 1111 1111 1111 4111-1111-1111-1112 999.1.1.1 a@b c@d.e", "en", "src2"),
    (None, "A row without an id has a text.", "en", "src2"),
]
#: Names that operators use inside.
CLASHES = ["id", "hash", "group", "fp", "spans", "label", "words", "bucket", "packet", "scores", "n", "h", "row", "text_lang"]


def edge_docs(spark, rows=ROWS):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({name: F.when(F.col("doc_id") % 2 == 0, F.lit(name)) for name in CLASHES})


def no_docs(spark):
    return edge_docs(spark).where("doc_id < 0")


def table_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def word_runs(text):
    """Runs of digits, letters and all beyond ASCII; A-Z lower-cased."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
